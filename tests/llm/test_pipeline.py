"""The pipeline's stages against brute-force versions on whole test tables."""

from collections import Counter, defaultdict

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tessera.llm import quality

from tests.llm.test_decontam import brute as brute_hits
from tests.llm.test_mixing import brute_targets
from tests.llm.test_quality import WORD, brute as brute_quality
from tests.llm.test_simhash import brute_components, brute_fingerprint

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out, seen = docs, [docs.collect()]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, out, SF)
        rows = out.collect()
        seen.append(rows)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns
            out = spark.createDataFrame(rows, docs.schema)
    return seen


def ids(rows):
    return sorted(r["doc_id"] for r in rows)


def test_stage_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "simhash_near_dedup", "benchmark_decontamination", "source_mixing", "token_ids"]


def test_quality(spark, stages):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rules = quality.learn_rules(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    judged = {r["doc_id"]: r["rule"] for r in quality.judge(docs, rules, keep=["doc_id"]).collect()}
    assert ids(stages[1]) == sorted(r["doc_id"] for r in stages[0] if not brute_quality(r["text"])[5] and judged[r["doc_id"]] is None)


def test_simhash(stages):
    rows = sorted(stages[1], key=lambda r: r["doc_id"])
    comp = brute_components([r["doc_id"] for r in rows], [brute_fingerprint(r["text"]) for r in rows], 4)
    assert ids(stages[2]) == sorted(set(comp))


def test_decontamination(spark, stages):
    bench = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    found = brute_hits([(r["doc_id"], r["text"]) for r in stages[2]], bench)
    assert ids(stages[3]) == sorted(f[0] for f in found if not f[2])


def test_mixing(stages):
    size, taken = defaultdict(int), defaultdict(int)
    words = {r["doc_id"]: len(WORD.findall(r["text"] or "")) for r in stages[3]}
    for r in stages[3]:
        size[r["source"]] += words[r["doc_id"]]
    for r in stages[4]:
        taken[r["source"]] += words[r["doc_id"]]
    for s, want in brute_targets(size).items():
        assert abs(taken[s] - want) <= max(words.values())
    assert max(Counter(r["doc_id"] for r in stages[4]).values()) <= 3


def test_tokens(stages):
    whole = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rows = sorted(stages[4], key=lambda r: r["doc_id"])
    want, at = [], 0
    for r in rows:
        n = len(whole.encode(r["text"] or "", add_special_tokens=False).ids) + 1
        want.append((r["doc_id"], at, n))
        at += n
    assert sorted((r["doc_id"], r["start"], r["n_tokens"]) for r in stages[5]) == want


def test_run_equals_stages(spark, stages):
    got = corpus_pipeline.run(spark, SF)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, stages[5]))
