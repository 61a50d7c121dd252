import numpy as np
import pytest
import xxhash

from tessera.llm import simhash


def brute_fingerprint(text):
    words = [w for w in "".join(c.lower() if c.isascii() else c for c in text or "")
             .replace("\t", " ").replace("\n", " ").replace("\r", " ").replace("\x0b", " ").replace("\x0c", " ").split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i:i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(ids, fps, radius):
    label = list(range(len(ids)))
    changed = True
    while changed:
        changed = False
        for i in range(len(ids)):
            for j in range(i):
                if label[i] != label[j] and bin(fps[i] ^ fps[j]).count("1") <= radius:
                    label[i] = label[j] = min(label[i], label[j])
                    changed = True
    out = []
    for i in range(len(ids)):
        own = [ids[j] for j in range(len(ids)) if label[j] == label[i] and ids[j] is not None]
        out.append(min(own, default=None))
    return out


def test_fingerprint_matches_definition():
    for text in (None, "", " \n\t ", "One", "one TWO three", "a b c d e a b c d e", "Ä Ö\x85x y z " * 50, "w " * 9000):
        assert simhash.fingerprint(text) == brute_fingerprint(text), text


@pytest.mark.parametrize("radius", [0, 1, 3, 4, 6])
def test_sliced_links_equal_popcount(radius):
    rng = np.random.default_rng(radius)
    base = rng.integers(0, 2**63, 6, dtype=np.uint64)
    fps = np.unique(np.array([int(base[rng.integers(6)]) ^ sum(1 << int(b) for b in rng.integers(0, 64, rng.integers(0, 6)))
                              for _ in range(300)], np.uint64))
    group = np.sort(rng.integers(0, 4, len(fps)))
    a, b = simhash.sliced_links(group, fps, radius)
    def comps(pairs, n):
        lab = list(range(n))
        for i, j in pairs:
            x, y = lab[i], lab[j]
            lab = [min(x, y) if v in (x, y) else v for v in lab]
        return lab
    at = {int(v): k for k, v in enumerate(fps)}
    got = comps([(at[int(x)], at[int(y)]) for x, y in zip(a, b)], len(fps))
    want = comps([(i, j) for i in range(len(fps)) for j in range(i) if group[i] == group[j]
                  and bin(int(fps[i]) ^ int(fps[j])).count("1") <= radius], len(fps))
    assert got == want and len(a) < len(fps)


def test_near_duplicates_against_brute_force(spark):
    rng = np.random.default_rng(5)
    vocab = [f"w{k}" for k in range(400)]
    texts = [" ".join(vocab[k] for k in rng.integers(0, 400, 150)) for _ in range(12)]
    rows = []
    for k in range(120):
        words = texts[int(rng.integers(12))].split()
        for _ in range(int(rng.integers(0, 3))):
            words[int(rng.integers(len(words)))] = "changed"
        rows.append((k if k % 17 else None, " ".join(words), f"x{k}"))
    rows += [(500, None, "n"), (501, "", "e"), (502, " \n", "b"), (3, rows[3][1], "again"), (3, "other words here now", "tie")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["fp"], r["component_id"])
                 for r in simhash.near_duplicates(docs).collect())
    fps = [brute_fingerprint(r[1]) for r in rows]
    comp = brute_components([r[0] for r in rows], fps, 4)
    want = sorted((r[0] is None, r[0] or 0, f - 2**64 if f >> 63 else f, c) for r, f, c in zip(rows, fps, comp))
    assert got == want
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    fp_of = {r[1]: f for r, f in zip(rows, fps)}
    root = fingerprint_roots(fps, 4)
    stayed = kept.collect()
    assert len(stayed) == len(set(root.values())) == len({root[fp_of[r["text"]]] for r in stayed})
    smallest = {}
    for r, f in zip(rows, fps):
        smallest[root[f]] = min(smallest.get(root[f], (True, 0)), (r[0] is None, r[0] or 0))
    assert all((r["doc_id"] is None, r["doc_id"] or 0) == smallest[root[fp_of[r["text"]]]] for r in stayed)
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def fingerprint_roots(fps, radius):
    lab = {f: f for f in fps}
    for a in lab:
        for b in lab:
            if bin(a ^ b).count("1") <= radius and lab[a] != lab[b]:
                x, y = lab[a], lab[b]
                lab = {k: min(x, y) if v in (x, y) else v for k, v in lab.items()}
    return lab


A, B = "one text about some quite common things in the house", "another thing with words that are found nowhere else at all"


@pytest.mark.parametrize("rows, want", [
    ([(1, A), (3, A), (3, B)], [(1, A), (3, B)]),            # the copy of A goes although B has its id
    ([(1, A), (1, B)], [(1, A), (1, B)]),                    # unrelated texts of one id both stay
    ([(None, A), (None, A), (2, A), (None, B), (None, B)], [(2, A), (None, B)]),
    ([(1, A), (1, A), (None, None), (None, None)], [(1, A), (None, None)]),
])
def test_keep_one_by_row(spark, rows, want):
    schema = "doc_id long, text string, key1 string, _key1 long, _rows long, fp long, root string"
    docs = spark.createDataFrame([(*r, "x", 1, 2, 3, "r") for r in rows], schema)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(map(str, ((r["doc_id"], r["text"]) for r in kept.collect()))) == sorted(map(str, want))


def test_hot_bucket_is_dealt_in_chunks(spark):
    rng = np.random.default_rng(1)
    fps = sorted({int((1 << 40) ^ sum(1 << int(b) for b in rng.integers(0, 20, 3))) for _ in range(150)})
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    one = {tuple(sorted(r)) for r in simhash.links(df, 2, bucket_rows=10).collect()}
    two = {tuple(sorted(r)) for r in simhash.links(df, 2).collect()}
    def comps(edges):
        lab = {f: f for f in fps}
        for a, b in edges:
            x, y = lab[a], lab[b]
            lab = {k: min(x, y) if v in (x, y) else v for k, v in lab.items()}
        return lab
    assert comps(one) == comps(two)
