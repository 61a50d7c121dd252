"""Cases that the test tables do not contain by themselves."""

import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tessera import session
from tessera.operators import aggs, joins, neighbours
from tessera.session import scratch_dir
from tessera.sources import landing, sinks
from tessera.streaming.silver_stream import read_silver, run_silver_stream

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_paper_number_in_two_sessions(spark):
    bills = spark.createDataFrame([(130, 1), (131, 1), (131, 1)], "legislature int, paperNumber int")
    th = spark.createDataFrame([(130, 1, "a"), (131, 1, "b"), (131, 1, "c")], "legislature int, paperNumber int, Id string")
    got = joins.parent_child(bills, th, ["legislature", "paperNumber"]).groupBy("legislature").count().collect()
    assert {r["legislature"]: r["count"] for r in got} == {130: 1, 131: 2}


def test_document_landed_twice_is_once_in_silver(spark):
    text = "This is the first long sentence of the text. Here is a second long sentence."
    schema = StructType([StructField("doc_id", LongType()), StructField("doc_text", StringType())])
    bronze, silver, ckpt = (scratch_dir(spark, f"s-{x}") for x in ("bronze", "silver", "ckpt"))
    assert read_silver(spark, silver).count() == 0
    spark.createDataFrame([(1, text), (2, text), (2, text)], schema).coalesce(1).write.parquet(f"{bronze}/drop=1")
    run_silver_stream(spark, f"{bronze}/*", schema, silver, ckpt)
    spark.createDataFrame([(1, text + " One more long sentence here."), (3, text)], schema).coalesce(1).write.parquet(f"{bronze}/drop=2")
    run_silver_stream(spark, f"{bronze}/*", schema, silver, ckpt)
    rows = read_silver(spark, silver)
    assert {r["doc_id"] for r in rows.collect()} == {1, 2, 3}
    assert rows.groupBy("doc_id", "sentence_index").count().where("count > 1").count() == 0


def test_torn_page_is_reported(spark, tmp_path):
    (tmp_path / "good.json").write_text('{"hits":{"total":{"value":1},"hits":[{"_source":{"a":7}}]}}\n')
    (tmp_path / "bad.json").write_text('{"hits":{"total":{"value":1},"hits":[{"_source":{"a":')
    source = StructType([StructField("a", LongType())])
    assert [r["a"] for r in landing.read_hits(spark, f"file://{tmp_path}", source).collect()] == [7]
    bad = landing.read_bad_pages(spark, f"file://{tmp_path}", source).collect()
    assert len(bad) == 1 and bad[0]["file"].endswith("bad.json")


def test_landing_manifest_is_repeatable(spark):
    root = scratch_dir(spark, "t-land")
    df = spark.createDataFrame([(1, "en", "a"), (2, "de", "b")], "doc_id long, session string, html string")
    first = landing.land_new(df, root, "doc_id", "session", "html")
    assert first.count() == 2 and first.count() == 2
    more = df.unionByName(spark.createDataFrame([(3, "de", "c")], df.schema))
    second = landing.land_new(more, root, "doc_id", "session", "html")
    assert [r["doc_id"] for r in second.collect()] == [3] and second.count() == 1
    assert landing.read_doc_blobs(spark, root).count() == 3


def test_entities_are_decoded_once(spark):
    df = spark.createDataFrame([("<p>&amp;lt;b&amp;gt; &lt;i&gt; &amp;</p>",)], "h string")
    assert df.select(landing.html_to_text(F.col("h"))).first()[0] == "&lt;b&gt; <i> &"


def test_topk_of_equal_vectors_is_bounded(spark):
    df = spark.createDataFrame([(i, [1.0, 0.0]) for i in range(60)], "id long, v array<float>")
    got = neighbours.topk_neighbours(df, "id", "v", 5, chunk_rows=20).collect()
    assert len(got) == 300
    for i in (0, 3, 59):
        want = [j for j in range(60) if j != i][:5]
        assert sorted(r["nb"] for r in got if r["id"] == i) == want


def test_merge_does_not_depend_on_row_order(spark):
    rows = [(1, 2, "x"), (1, 2, "y"), (2, 1, "n"), (2, 2, "m")]
    for order in (rows, rows[::-1]):
        target = scratch_dir(spark, "t-target")
        sinks.merge_upsert(spark, target, spark.createDataFrame([(1, 1, "old"), (9, 1, "kept")], "k long, version long, v string"), ["k"])
        batch = spark.createDataFrame(order, "k long, version long, v string")
        got = sinks.merge_upsert(spark, target, batch, ["k"], order_col="version")
        assert sorted(map(tuple, got.collect())) == [(1, 2, "y"), (2, 2, "m"), (9, 1, "kept")]


def test_merge_touches_only_partitions_of_its_keys(spark):
    import glob
    import os

    path = scratch_dir(spark, "t-keyed").removeprefix("file:")
    sinks.replace_keys(spark, path, spark.range(200).selectExpr("id AS k", "'old' AS v"), ["k"], buckets=8)
    files = lambda: {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/bucket=*/*.parquet")}
    before = files()
    sinks.replace_keys(spark, path, spark.createDataFrame([(3, "new"), (3, "more")], "k long, v string"), ["k"], buckets=8)
    after = files()
    assert len({os.path.dirname(f) for f in before}) == 8
    assert len({os.path.dirname(f) for f in before.keys() ^ after.keys()}) == 1
    assert all(after[f] == before[f] for f in before.keys() & after.keys())
    rows = sinks.read_keyed(spark, path)
    assert rows.count() == 201 and sorted(r["v"] for r in rows.where("k = 3").collect()) == ["more", "new"]


def test_merge_empties_a_partition(spark):
    path = scratch_dir(spark, "t-keyed")
    one = spark.createDataFrame([(1, "a"), (None, "n")], "k long, v string")
    sinks.replace_keys(spark, path, one, ["k"], buckets=8)
    got = sinks.replace_keys(spark, path, one.limit(0), ["k"], buckets=8, keys_of=one.where("k = 1"))
    assert [tuple(r) for r in got.collect()] == [(None, "n")]


def test_changed_document_replaces_its_sentences(spark):
    schema = StructType([StructField("doc_id", LongType()), StructField("doc_text", StringType())])
    bronze, silver, ckpt = (scratch_dir(spark, f"c-{x}") for x in ("bronze", "silver", "ckpt"))
    old, new = "This is the first long sentence of the text. Here is a second long sentence.", "Only one quite different sentence is left here."
    spark.createDataFrame([(1, old), (2, old), (4, old)], schema).write.parquet(f"{bronze}/drop=1")
    run_silver_stream(spark, f"{bronze}/*", schema, silver, ckpt)
    spark.createDataFrame([(1, new), (3, old), (4, "")], schema).write.parquet(f"{bronze}/drop=2")
    run_silver_stream(spark, f"{bronze}/*", schema, silver, ckpt)
    found = {}
    for r in read_silver(spark, silver).collect():
        found.setdefault(r["doc_id"], []).append(r["sentence"])
    assert len(found[2]) == len(found[3]) == 2 and len(found[1]) == 1 and "different" in found[1][0] and 4 not in found


def test_copy_takes_its_list_from_the_catalog(spark):
    root = scratch_dir(spark, "t-db")
    for db in ("from_db", "to_db"):
        spark.sql(f"CREATE DATABASE {db} LOCATION '{root}/{db}'")
    spark.range(3).write.saveAsTable("from_db.three")
    spark.range(5).write.saveAsTable("from_db.five")
    spark.range(7).createOrReplaceTempView("a_view")
    assert sorted(map(tuple, sinks.catalog_copy(spark, "from_db", "to_db").collect())) == [("five", 5), ("three", 3)]
    assert sorted(t.name for t in spark.catalog.listTables("to_db") if not t.isTemporary) == ["five", "three"]
    from tessera.operators import silver

    assert silver.silver_table_or_none(spark, "to_db.none") is None and silver.silver_table_or_none(spark, "nowhere.x") is None
    assert silver.silver_table_or_none(spark, "to_db.five").count() == 5
    for db in ("from_db", "to_db"):
        spark.sql(f"DROP DATABASE {db} CASCADE")


def test_repeat_by_weight_in_blocks(spark):
    df = spark.createDataFrame([("a", 2500), ("b", 1), ("c", 0), ("d", None)], "n string, w int")
    got = {r["n"]: r["count"] for r in aggs.repeat_by_weight(df, "w").groupBy("n").count().collect()}
    assert got == {"a": 2500, "b": 1}


def test_machine_local_checkpoint_is_refused_on_a_cluster():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(RuntimeError, match=r"spark\.checkpoint\.dir"):
        session.ensure_checkpoint_dir(Session())


def test_udf_query_from_another_folder(tmp_path):
    code = (f"import sys; sys.path.insert(0, {ROOT!r})\n"
            "from tessera.session import get_spark\nfrom tessera.plans import QUERIES\n"
            "print('rows', QUERIES['join_fuzzy_pairs'](get_spark('local[2]', 2), '/root/testdata/sf0.001').count())\n")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    run = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=200)
    assert "rows " in run.stdout, run.stderr[-2000:]


def test_merge_of_new_keys_rewrites_nothing(spark):
    """Rows of keys that the table does not hold are added; its files stay."""
    import glob

    path = scratch_dir(spark, "t-keyed").removeprefix("file:")
    batch = lambda low, v: spark.range(low, low + 100).selectExpr("id AS k", f"'{v}' AS v")
    sinks.replace_keys(spark, path, batch(0, "old"), ["k"], buckets=8)
    before = set(glob.glob(f"{path}/bucket=*/*.parquet"))
    for _ in range(2):  # applied again, the same batch gives the same table
        rows = sinks.replace_keys(spark, path, batch(1000, "new"), ["k"], buckets=8)
        assert rows.count() == 200 and rows.where("v = 'new'").count() == 100
        if _ == 0:
            assert before <= set(glob.glob(f"{path}/bucket=*/*.parquet"))
