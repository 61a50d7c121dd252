"""What the verification of candidate lines sends and leaves behind."""

import os
import random

from pyspark.sql import functions as F

from tessera.llm import lines
from tessera.session import materialize


def test_texts_are_sent_per_cell_and_not_per_pair(spark):
    n = 150
    pairs = spark.range(n).selectExpr("id AS a").crossJoin(spark.range(n).selectExpr("id AS b")).where("a < b")
    pairs = pairs.unionByName(spark.createDataFrame([(1000, 1001), (1001, 1002)], "a long, b long")).withColumn("by_word", F.lit(True))
    got = materialize(lines.celled(pairs), "t-cells")
    assert got.count() == n * (n - 1) // 2 + 2
    sent = got.select("cell", F.explode(F.array("a", "b")).alias("id")).distinct().count()
    assert sent <= n * 4 + 4 < got.count() / 15


def test_a_cell_is_dealt_once(spark):
    pairs = materialize(spark.createDataFrame([(1, 2, 7), (1, 3, 7), (4, 5, 8)], "a long, b long, cell long"), "t-pairs")
    texts = materialize(spark.createDataFrame([(k, -k, f"text {k}", f"c{k}") for k in range(1, 6)], "id long, id2 long, line string, code string"), "t-texts")
    names = materialize(spark.createDataFrame([(k, -k, 10 * k) for k in range(1, 6)], "id long, id2 long, pos long"), "t-names")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = lines.with_texts(pairs, texts, names)
        plan = lines.beside(lambda: got._jdf.queryExecution().executedPlan().toString(), spark)
        rows = lines.beside(lambda: lines.with_texts(pairs, texts, names).collect(), spark)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(32 * 1024 * 1024))
    assert spark.conf.get(lines.CO_PARTITION) == "true"
    assert not any("Exchange" in x and "b#" in x.split("Exchange")[1] for x in plan.splitlines())  # not dealt again by the second line
    assert sorted((r["src"], r["dst"], r["x"], r["y"], r["code_x"], r["code_y"]) for r in rows) == [
        (10, 20, "text 1", "text 2", "c1", "c2"), (10, 30, "text 1", "text 3", "c1", "c3"), (40, 50, "text 4", "text 5", "c4", "c5")]


def test_key_tables_are_deleted(spark, monkeypatch):
    written = {}
    saved = lines.saved

    def noted(df, tag):
        out = saved(df, tag)
        written[tag] = out.written.removeprefix("file:")
        return out

    monkeypatch.setattr(lines, "saved", noted)
    rnd = random.Random(1)
    vocab = [f"word{k}" for k in range(60)]
    base = [rnd.choice(vocab) for _ in range(30)]
    texts = [" ".join([*base[:k], "changed", *base[k + 1:]]) for k in range(5)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = lines.line_classes(df, per_edit=12).collect()
    assert [r["n_links"] for r in got] == [4] * 5 and {r["class_id"] for r in got} == {min(r["line_id"] for r in got)}
    assert not os.path.exists(written["lines-keyed"]) and not os.path.exists(written["lines-words"])
    assert os.path.exists(written["lines-distinct"])
