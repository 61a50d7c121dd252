"""What a task's Python or a shuffle holds at a time."""

import numpy as np
import pandas as pd

from tessera.operators import cells, distinct_text
from tessera.sources import landing


def test_visits_leave_in_bounded_frames():
    pdf = pd.DataFrame({"id": range(50), "vec": [np.full(3, float(i)) for i in range(50)]})
    near = np.random.default_rng(0).random((50, 40)) < 0.5
    frames = list(cells.copies(pdf, near, 64))
    assert max(len(f) for f in frames) == 64
    all_ = pd.concat(frames)
    assert list(zip(all_["id"], all_["cell"])) == [(i, c) for i, c in zip(*np.nonzero(near))]
    assert all(v[0] == i for i, v in zip(all_["id"], all_["vec"]))
    assert [len(f) for f in cells.copies(pdf, near & False)] == [0]


def test_extraction_goes_through_slices(spark):
    n = 3 * landing.EXTRACT_ROWS + 5
    df = spark.range(n).selectExpr("id", "if(id % 7 = 3, null, concat('t', id)) AS body").coalesce(1)
    out = landing.extract_with(df, "body", lambda x: x.upper() if x != "t8" else None, keep=("id",))
    assert any("MapInArrow" in x for x in [out._jdf.queryExecution().optimizedPlan().toString()])
    got = {r.id: (r.doc_text, r.error) for r in out.collect()}
    assert len(got) == n and got[8] == (None, None) and got[n - 1] == (f"T{n - 1}", None)
    assert got[3][0] is None and got[3][1].startswith("Error: ")


def test_sentences_of_a_document_are_dealt_once(spark):
    rows = [(1, 0, 5, 2), (1, 0, 6, 1), (1, 1, 5, 2), (1, 1, 6, 1), (1, 2, 9, 4), (2, 0, 1, 1), (None, 0, 1, 1)]
    sparse = spark.createDataFrame(rows, "doc_id long, sentence_index long, bucket long, cnt long").repartition("doc_id")
    out = distinct_text.distinctive_sentences(sparse)
    assert out._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    got = {r.doc_id: (r.sentence_index, r.similarity) for r in out.collect()}
    mean = {5: 4, 6: 2, 9: 4}
    assert got == {1: (2, round(4 * 4 / (4 * sum(x * x for x in mean.values()) ** 0.5), 6)), 2: (0, 1.0)}
