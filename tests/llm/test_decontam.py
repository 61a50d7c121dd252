import hashlib
import re

import numpy as np

from tessera.llm import decontam

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))


def brute(docs, bench, size=10):
    out = []
    for doc_id, text in docs:
        w, hit, items = words(text), set(), set()
        for item, t in bench:
            b = words(t)
            n = min(size, len(b))
            for i in range(len(b) - n + 1 if n else 0):
                for j in range(len(w) - n + 1):
                    if w[j:j + n] == b[i:i + n]:
                        hit |= set(range(j, j + n))
                        if item is not None:
                            items.add(str(item))
        out.append((doc_id, len(w), len(hit), sorted(items)))
    return out


BENCH = [(1, "One two three four five six seven eight nine ten eleven twelve"), (2, "Ünï short"), (10, "alpha, beta; gamma"),
         (3, None), (4, "--- !!"), (None, "null item words"), (2, "ünï short"), (11, "two three four five six seven eight nine ten eleven")]
DOCS = [(0, "zero ONE two three four five six seven eight nine ten eleven twelve thirteen"), (1, None), (2, ""), (3, "ünï-short ünï short"),
        (4, "Ünï SHORT"), (5, "alpha beta gamma alpha beta gamma delta"), (6, "null item words"), (7, "two three four five"),
        (None, "x alpha beta gamma"), (8, "alpha beta"), (8, "beta gamma"), (9, "pad " * 30_000 + "alpha beta gamma")]


def digest(rows):
    key = lambda r: (r[0] is None, r[0] or 0, r[1:])
    return sorted(((r["doc_id"], r["n_words"], sum(s["b"] - s["a"] + 1 for s in r["spans"]), list(r["items"])) for r in rows), key=key)


def test_hits_equal_brute_force(spark):
    docs = spark.createDataFrame([(*d, "u", "v") for d in DOCS], "doc_id long, text string, spans string, rid string")
    bench = spark.createDataFrame(BENCH, "item_id long, text string")
    want = sorted(brute(DOCS, BENCH), key=lambda r: (r[0] is None, r[0] or 0, r[1:]))
    assert digest(decontam.find_hits(docs, bench).collect()) == want
    # blocks of a few bytes: every item scans alone, the result is the same
    assert digest(decontam.find_hits(docs, bench, block_bytes=60).collect()) == want
    assert decontam.find_hits(docs, bench.limit(0)).where("size(spans) > 0").count() == 0
    assert decontam.find_hits(docs.limit(0), bench).count() == 0


def test_drop_and_cut(spark):
    docs = spark.createDataFrame([(*d, "u") for d in DOCS], "doc_id long, text string, spans string")
    bench = spark.createDataFrame(BENCH, "item_id long, text string")
    hit = {r[0] for r in brute(DOCS, BENCH) if r[2]}
    for block in (1 << 20, 60):
        left = [r["doc_id"] for r in decontam.decontaminate(docs, bench, block_bytes=block).collect()]
        assert sorted(left, key=str) == sorted((d[0] for d in DOCS if d[0] not in hit), key=str)
    cut = {r["doc_id"]: r["text"] for r in decontam.decontaminate(docs, bench, "cut").collect()}
    assert cut[0] == "zero  thirteen" and cut[5] == " delta" and cut[7] == "two three four five" and cut[1] is None


def test_query_against_brute_force(spark):
    from tessera.llm.queries import QUERIES
    sf = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    bench = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    grams = {}
    for item, t in bench:
        w = words(t)
        n = min(10, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            grams.setdefault(tuple(w[i:i + n]), set()).add(str(item))
    want = {}
    for doc_id, text in docs:
        w, hit, items = words(text), set(), set()
        for n in {len(g) for g in grams}:
            for j in range(len(w) - n + 1):
                if (g := tuple(w[j:j + n])) in grams:
                    hit |= set(range(j, j + n))
                    items |= grams[g]
        want[doc_id] = (len(w), len(hit), len(items), hashlib.sha256(",".join(sorted(items)).encode()).hexdigest(), bool(hit))
    got = {r[0]: tuple(r[1:]) for r in QUERIES["op3_benchmark_decontamination"](spark, sf).collect()}
    assert got == want and any(v[4] for v in want.values())


def test_cut_does_not_depend_on_blocks(spark):
    words = [f"w{k}" for k in range(40)]
    # overlapping items, and one that only a cut would bring together
    bench = spark.createDataFrame([("a", " ".join(words[5:15])), ("b", " ".join(words[10:20])), ("c", " ".join(words[12:24])),
                                   ("d", " ".join(words[:5] + words[24:29]))], "item_id string, text string")
    docs = spark.createDataFrame([(1, " ".join(words), "x"), (2, "clean text", "y"), (3, None, "z")], "doc_id long, text string, s string")
    want = [(1, " ".join(words[:5]) + "  " + " ".join(words[24:]), "x"), (2, "clean text", "y"), (3, None, "z")]
    for block_bytes in (1 << 20, 60):
        got = decontam.decontaminate(docs, bench, "cut", block_bytes=block_bytes)
        assert got.columns == docs.columns
        assert sorted(map(tuple, got.collect())) == want


def test_windows_stay_small():
    """8 MB of benchmark text: a few bytes per byte, also when pickled."""
    import pickle
    import random

    rnd = random.Random(1)
    vocab = [f"w{k}x" for k in range(20_000)]
    items = [(f"i{k}", " ".join(rnd.choices(vocab, k=400))) for k in range(500)] + [("short", "one two"), ("none", None)]
    items += [("twin", items[0][1])]
    n_bytes = sum(len(t or "") for _, t in items)
    win = decontam.Windows(items, 10)
    assert len(pickle.dumps(win)) < 6 * n_bytes
    ids = np.array([win.vocab[w] for w in decontam.words_of(items[0][1])], np.int64)
    found = list(win.scan(ids))
    assert len(found) == 391 and all(sorted(o) == ["i0", "twin"] for _, _, o in found)


def test_windows_of_one_hash(monkeypatch):
    """All hashes equal: windows are still told apart by their words."""
    monkeypatch.setattr(decontam.Windows, "hash_at", lambda self, ids, at, n: np.zeros(len(at), np.uint64))
    win = decontam.Windows([("a", "x y z x y"), ("b", "y z x"), ("c", "q")], 3)
    ids = np.array([win.vocab.get(w, 0) for w in b"x y z x o q".split()], np.int64)
    assert sorted((i, n, o) for i, n, o in win.scan(ids)) == [(0, 3, ["a"]), (1, 3, ["a", "b"]), (5, 1, ["c"])]


def test_parts_of_a_batch(monkeypatch):
    win = decontam.Windows([("a", "x y z")], 2)
    texts = ["x y z", None, "", "q x y", "z", "y z " * 5]
    whole = decontam._scan_batch(texts, win)
    monkeypatch.setattr(decontam, "PART_CHARS", 4)
    assert decontam._scan_batch(texts, win) == whole and len(whole[0]) == len(texts)
    assert decontam._scan_batch([], win) == ([], [], [])
