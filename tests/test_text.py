"""Hand-made cases for the cleaner (FIXTURES.md section 3) and sentences."""

import pytest
from pyspark.sql import functions as F

from tessera.functions import text as tx
from tessera.operators import silver


def _clean(spark, values, mode):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
    rows = df.select("i", tx.clean_text(F.col("t"), mode).alias("c")).orderBy("i").collect()
    return [r.c for r in rows]


@pytest.mark.parametrize("raw, function_mode, pipeline_mode", [
    ("the end\nNext", "the endNext", '"the end Next"'),
    ("queded x", "", '" "'),
    ("LD 1234 is 1.5", "LD  is .", '"LD  is ."'),
    ("so...ok", "so..ok", '"so..ok"'),
    ("don’t", "don'", '"dont"'),
    ("fünd", "fünd", '" "'),
])
def test_clean_cases(spark, raw, function_mode, pipeline_mode):
    assert _clean(spark, [raw], "function") == [function_mode]
    assert _clean(spark, [raw], "pipeline") == [pipeline_mode]


def test_clean_quirks(spark):
    out = _clean(spark, ["a\tb c", "x \\x41y", "“quoted” — dash", "smile \U0001F600n ok"], "function")
    assert out[0] == "ab"                     # tab deleted, words fuse; isolated c removed
    assert out[1] == ""                       # literal \x41 removed, then isolated x and y
    assert out[2] == '"quoted" -- dash'
    assert out[3] == "smile  ok"              # emoji dropped by T9, isolated n removed, no re-collapse
    pipe = _clean(spark, ["smile \U0001F600n ok", "tab\there"], "pipeline")
    assert pipe[0] == '"smile  ok"'           # astral char -> two backslashes; the second + n -> space
    assert pipe[1] == '"tabthere"'            # \t escape leaves a stray t


def test_nfkc_only_where_needed(spark):
    out = _clean(spark, ["ﬁne café … ok", "plain text here"], "function")
    assert out[0] == "fine café.. ok"     # ligature and ellipsis by NFKC, then T11
    assert out[1] == "plain text here"


def test_sentence_gaps(spark):
    df = spark.createDataFrame([(1, "Hi. This is long enough. No. Another long one.")], "doc_id long, doc_text string")
    rows = silver.sentences(df).orderBy("sentence_index").collect()
    assert [r.sentence_index for r in rows] == [1, 3]
    assert rows[0].sentence == "This is long enough."


def test_usable_text_filter(spark):
    from tessera.operators.filters import usable_text

    df = spark.createDataFrame([(1, "null"), (2, "short"), (3, "Error: bad file"), (4, None)],
                               "doc_id long, doc_text string")
    assert [r.doc_id for r in usable_text(df).collect()] == [3]


class _ToyModel:
    """Stands in for a sentence model: character-class counts."""

    loads = 0

    def __init__(self):
        _ToyModel.loads += 1

    def encode(self, texts):
        import numpy as np

        return np.array([[sum(c.isalpha() for c in t), sum(c.isdigit() for c in t), len(t)] for t in texts])


def test_model_encoder_plugin(spark):
    df = spark.createDataFrame([(1, 0, "ab 12"), (1, 1, "xyz")], "doc_id long, sentence_index long, sentence string")
    v = silver.sentence_vectors(df, silver.model_encoder(_ToyModel, 3), model_name="toy")
    rows = {r.sentence_index: (list(r.embedding), r.embedding_dimension, r.model_name) for r in v.collect()}
    assert rows[0] == ([2.0, 2.0, 5.0], 3, "toy")
    assert rows[1] == ([3.0, 0.0, 3.0], 3, "toy")


def test_scanned_characters(spark):
    from pyspark.sql import functions as F

    from tessera.functions import text as tx
    from tessera.plans.extras import OCR_DIGITS

    cases = {"h0use c0mm0n": "house common", "H0USE B1LL": "HOUSE BILL", "1O0 2l3 4S6 9I9": "100 213 456 919", "wor1d 5ection": "world 5ection",
             "x0y0z": "xoyoz", "a00b H.R.10 A1 1a": "a00b H.R.10 A1 1a", "": "", "clo5e": "close", "Bi1l": "Bill"}
    df = spark.createDataFrame([(k,) for k in cases], "s string")
    got = {r["s"]: r["f"] for r in df.select("s", tx.fix_scanned(F.col("s"), OCR_DIGITS).alias("f")).collect()}
    assert got == cases


def test_ascii_steps_equal_the_general_ones(spark):
    """The pipeline cleaner's last steps see only ASCII and take cheaper patterns."""
    import random

    rng = random.Random(5)
    letters = list("ab1 2u0f\\nx-_.,!?;:'\"()#$%&*+/<=>@[]^`{|}~ ") + ["\\n", "  ", " . "]
    rows = [("".join(rng.choice(letters) for _ in range(rng.randint(0, 40))),) for _ in range(3000)] + [(None,), ("",)]
    c = F.col("t")
    got = spark.createDataFrame(rows, "t string").select("t", tx._post_whitespace_ascii(c).alias("new"), tx._post_whitespace(c).alias("old"))
    assert [tuple(r) for r in got.where("not new <=> old").collect()] == []


def test_hash_counts_of_documents_need_no_shuffle(spark):
    """Entries are counted in the sentence's row; only null and repeated ids are grouped."""
    from tessera.operators import silver

    text = "The first long sentence has words. Words words and some other words follow."
    once = spark.createDataFrame([(1, text), (2, text + " More words stand here today.")], "doc_id long, doc_text string")
    counts = silver.document_hash_counts(once)
    assert "Exchange" not in counts._jdf.queryExecution().executedPlan().toString()
    twice = once.unionByName(spark.createDataFrame([(2, text), (None, text), (None, text), (3, "")], "doc_id long, doc_text string"))
    for docs in (once, twice):
        want = silver.sparse_hash_counts(silver.sentences(docs))
        assert sorted(map(str, silver.document_hash_counts(docs).collect())) == sorted(map(str, want.collect()))
    tokens = sum(r["cnt"] for r in silver.document_hash_counts(twice.where("doc_id is null")).collect())
    assert tokens == 2 * len(text.replace(".", "").split())
