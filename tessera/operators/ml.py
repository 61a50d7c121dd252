"""pyspark.ml stages for the encoder steps, so they compose in a
``pyspark.ml.Pipeline`` like the reference's estimator pipeline."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.param.shared import HasInputCol, HasOutputCol, Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions import vectors as vx


class HashingSentenceEncoder(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Text column -> md5 feature-hashing vector (array<float>), optionally
    L2-normalised."""

    numFeatures = Param(Params._dummy(), "numFeatures", "vector length", typeConverter=TypeConverters.toInt)
    normalize = Param(Params._dummy(), "normalize", "L2-normalise the vector", typeConverter=TypeConverters.toBoolean)

    @keyword_only
    def __init__(self, inputCol: str = "sentence", outputCol: str = "embedding", numFeatures: int = 64,
                 normalize: bool = False):
        super().__init__()
        self._setDefault(inputCol="sentence", outputCol="embedding", numFeatures=64, normalize=False)
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        out = self.getOutputCol()
        df = df.withColumn(out, vx.hash_vector(F.col(self.getInputCol()), self.getOrDefault(self.numFeatures)))
        if self.getOrDefault(self.normalize):
            # a second projection: the (non-deterministic) UDF result is not
            # inlined into the lambda of the normalisation
            df = df.withColumn(out, vx.to_float_array(vx.l2_normalize(F.col(out))))
        return df
