import re
from collections import Counter

import numpy as np
import pytest

from tessera.llm import audit

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
SCHEMA = "doc_id long, text string, lang string, source string, n long, term string, value string, block string"


def brute(rows, min_docs, top):
    docs = [(lang or "", source or "", TERM.findall("".join(c.lower() if c.isascii() else c for c in text or "")))
            for _, text, lang, source in rows]
    out = []
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        held = Counter(t for _, _, w in own for t in set(w))
        kept = {t for t, k in held.items() if k >= min_docs}
        count = {}
        for _, source, w in own:
            count.setdefault(source, Counter()).update(t for t in w if t in kept)
        whole = sum(count.values(), Counter())

        def chance(c):
            return {t: 1 + 10**9 * (c[t] + 1) // (sum(c.values()) + len(kept)) for t in kept}

        q_all, p_of = chance(whole), {s: chance(c) for s, c in count.items()}
        for s, p in p_of.items():
            pairs = [(-sum((p[t] - q[t]) ** 2 // q[t] for t in kept), o.encode()) for o, q in p_of.items() if o != s]
            terms = [(-((p[t] - q_all[t]) ** 2 // q_all[t]), t.encode()) for t in kept if count[s][t] and p[t] > q_all[t]]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
                out += [(lang, s, part, item.decode(), -v, k) for k, (v, item) in enumerate(found, 1)]
    return sorted(out)


def corpus():
    rng = np.random.default_rng(8)
    words = [f"w{chr(97 + k // 26)}{chr(97 + k % 26)}" for k in range(90)] + ["Éa", "éa", "日本", "x"]
    weight = 1 / np.arange(1, len(words) + 1)
    rows = []
    for k in range(160):
        source = "hot" if k % 3 == 0 else f"s{int(rng.integers(11))}"
        text = " ".join(rng.choice(words, int(rng.integers(0, 60)), p=weight / weight.sum()))
        rows.append((k % 50, text.upper() if k % 7 == 0 else text, ["en", "de", "en"][k % 3 if k % 5 else 1], source))
    rows += [(None, None, "en", "nulls"), (1, "wa wb", None, None), (1, "wa wb", None, "a"), (1, "wa,wb", "", "a"), (2, "", "fr", "only"),
             (3, "12 _ 34", "it", "x"), (3, "zz", "it", "y"), (4, "Wa1wa\x00waé\U0001f600", "en", "hot"), (5, "waa " * 60_000, "en", "hot")]
    return rows


@pytest.mark.parametrize("block, cells, top", [(64, 2_000_000, 200), (2, 40, 3)])
def test_against_brute_force(spark, monkeypatch, block, cells, top):
    monkeypatch.setattr(audit, "BLOCK", block)
    monkeypatch.setattr(audit, "TASK_CELLS", cells)
    rows = corpus()
    docs = spark.createDataFrame([(*r, 7, "t", "v", "b") for r in rows], SCHEMA)
    got = sorted((r["lang"], r["source"], r["part"], r["item"], r["value"], r["rank"])
                 for r in audit.audit(docs, top=top).collect())
    assert got == brute(rows, audit.MIN_DOCS, top)


def test_empty_table(spark):
    assert audit.audit(spark.createDataFrame([], SCHEMA)).collect() == []


def test_joint_tables_in_small_chunks(monkeypatch):
    """Chunks of a few columns give the sums that each term alone gives."""
    monkeypatch.setattr(audit, "CHUNK_COLUMNS", 9)
    rng = np.random.default_rng(2)
    count = np.where(rng.random((40, 5)) < 0.5, rng.integers(1, 30, (40, 5)), 0)
    base = count.sum(axis=0) + 40
    term, source = np.nonzero(count)
    left = np.array([True, True, False, False, True])
    names = np.array(list("abcde"))
    total, seen = audit.joint_prices(names, base, left, ~left, np.unique(term, return_inverse=True)[1], source, count[term, source])
    p = 1 + audit.ONE * (count + 1) // base
    held = count.any(axis=1)
    for i in range(5):
        for j in range(5):
            if left[i] != left[j]:
                f = (p[:, i] - p[:, j]) ** 2 // p[:, j]
                assert (total[i, j], seen[i, j]) == (f[held].sum(), held.sum())


def test_partial_counts_are_handed_on(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(audit, "HELD_TERMS", 3)
    rows = [("en", "a", "aa bb cc"), ("en", "b", "aa aa"), ("en", "a", "dd aa")]
    batch = pa.RecordBatch.from_arrays([pa.array(list(c)) for c in zip(*rows)], names=["lang", "source", "text"])
    found = [r for b in audit._partial_counts(iter([batch])) for r in b.to_pylist()]
    sums = Counter()
    for r in found:
        sums[r["source"], r["term"]] += 100 * r["n"] + r["n_docs"]
    assert len(found) > len(sums) - 1 and sums == {("a", "aa"): 202, ("a", "bb"): 101, ("a", "cc"): 101, ("a", "dd"): 101, ("b", "aa"): 201}
