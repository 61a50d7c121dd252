"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed in full through the ``noop`` sink (nothing is
collected to the driver).  Prints one JSON line:
{"metric": "total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}
Set BENCH_QUERIES=all (or a comma list) to choose the set.

The given tables are one file of one row group each, which only one task can
read.  They are landed once, untimed, as files of a bounded number of rows, the
layout a table of any size has; the queries read those.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "silver_documents", "txt_clean", "txt_clean_pipeline", "txt_sentences", "vec_hash_encode",
    "agg_stance_counts", "join_anti_unprocessed", "win_org_count", "win_first_seen",
    "agg_trend_names", "agg_policy_breadth", "join_bill_testimony", "agg_cluster_summary",
    "join_fuzzy_pairs", "clu_greedy_anchor", "vec_cosine_topk", "vec_knn_graph",
    "clu_dbscan", "srch_dbscan_grid", "doc_affinity", "doc_tfidf",
]


# main input table of each headline query (for rows/s)
MAIN_TABLE = {
    "silver_documents": "documents", "txt_clean": "documents", "txt_clean_pipeline": "documents",
    "txt_sentences": "documents", "vec_hash_encode": "documents", "agg_stance_counts": "documents",
    "join_anti_unprocessed": "documents", "win_org_count": "lineitem", "win_first_seen": "lineitem",
    "agg_trend_names": "lineitem", "agg_policy_breadth": "lineitem", "join_bill_testimony": "lineitem",
    "agg_cluster_summary": "embeddings", "join_fuzzy_pairs": "lineitem", "clu_greedy_anchor": "lineitem",
    "vec_cosine_topk": "embeddings", "vec_knn_graph": "embeddings", "clu_dbscan": "embeddings",
    "srch_dbscan_grid": "embeddings", "doc_affinity": "lineitem", "doc_tfidf": "documents",
}


def table_rows(sf_dir: str, table: str) -> int:
    import pyarrow.parquet as pq

    return pq.ParquetFile(f"{sf_dir}/{table}.parquet").metadata.num_rows


def landed(spark, sf_dir: str, files: int) -> str:
    """The tables of ``sf_dir`` as about ``files`` files each."""
    from tessera.sources.tables import TABLE_NAMES

    out = tempfile.mkdtemp(prefix="tessera-bench-")
    for t in TABLE_NAMES:
        rows = -(-max(1, table_rows(sf_dir, t)) // files)
        spark.read.parquet(f"{sf_dir}/{t}.parquet").write.option("maxRecordsPerFile", rows).parquet(f"{out}/{t}.parquet")
    return out


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    from tessera.plans import QUERIES
    from tessera.session import get_spark

    spark = get_spark(f"local[{cpus}]", shuffle_partitions=max(cpus, 8), app="tessera-bench")
    sel = os.environ.get("BENCH_QUERIES", "")
    if sel == "all":
        names = sorted(QUERIES)
    elif sel:
        names = [n for n in sel.split(",") if n in QUERIES]
    else:
        names = [n for n in HEADLINE if n in QUERIES]
    # warm-up: JVM code paths, and one Arrow Python worker per core
    QUERIES["agg_org_counts"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    spark.range(0, cpus * 4, 1, cpus * 4).mapInPandas(lambda it: it, "id long") \
        .write.format("noop").mode("overwrite").save()
    # JIT warm-up of the regex / higher-order-function paths on the tiny tables
    # (a different dataset: nothing measured below is cached by this)
    warm_dir = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm_dir):
        for w in ("silver_documents", "vec_hash_encode"):
            QUERIES[w](spark, warm_dir).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    data = landed(spark, sf_dir, 2 * cpus)
    for n in names:
        t0 = time.perf_counter()
        try:
            QUERIES[n](spark, data).write.format("noop").mode("overwrite").save()
            times[n] = round(time.perf_counter() - t0, 3)
        except Exception as e:  # keep benchmarking the rest
            print(f"# {n} failed: {type(e).__name__}: {str(e)[:200]}", file=sys.stderr)
    rows_per_sec = {}
    for n, sec in times.items():
        if n in MAIN_TABLE and sec > 0:
            rows_per_sec[n] = round(table_rows(sf_dir, MAIN_TABLE[n]) / sec)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "total_sec",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "rows_per_sec": rows_per_sec,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
