import random

import pytest
from pyspark.sql import functions as F

from tessera.llm import lines


def lev(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def edited(rnd, s, n, alphabet):
    for _ in range(n):
        k, kind = rnd.randrange(len(s) + 1), rnd.randrange(3)
        s = s[:k] + (rnd.choice(alphabet) if kind else "") + s[k + (kind != 1):]
    return s


@pytest.mark.parametrize("edits", [1, 2, 3])
def test_banded_distance(spark, edits):
    rnd = random.Random(edits)
    rows = [("", ""), ("a", ""), ("ab", "ba"), ("abc", "abc")]
    for _ in range(400):
        s = "".join(rnd.choice("abé") for _ in range(rnd.randrange(14)))
        rows.append((s, edited(rnd, s, rnd.randrange(edits + 3), "abé") if s else "b"))
    got = {(r["x"], r["y"]): r["distance"] for r in lines.distance(spark.createDataFrame(rows, "x string, y string"), edits).collect()}
    assert got == {(x, y): lev(x, y) for x, y in rows if lev(x, y) <= edits}


@pytest.mark.parametrize("edits", [1, 2])
def test_classes_against_brute_force(spark, edits):
    rnd = random.Random(3)
    base = ["".join(rnd.choice("abcd efg") for _ in range(rnd.randrange(20, 60))).strip() + "xyzé" for _ in range(25)]
    pool = [edited(rnd, rnd.choice(base), rnd.randrange(4), "abc é") for _ in range(160)] + base + ["tiny", "tinz"]
    docs = [(k, "\n".join(rnd.choice(pool) + rnd.choice(["", " ", "\t"]) for _ in range(6)), "x") for k in range(60)]
    docs += [(100, None, "n"), (101, "", "n"), (102, "\n \n\t", "n"), (5, docs[5][1], "x"), (None, docs[7][1], "n")]
    df = spark.createDataFrame(docs, "doc_id long, text string, line string")
    seen = {}
    for doc_id, text, _ in docs:
        for line in (text or "").split("\n"):
            if line := line.strip():
                ids, _ = seen.setdefault(line, ([], 0))
                ids.append(doc_id)
    names = list(seen)
    near = {a: {b for b in names if b != a and min(len(a), len(b)) >= 20 and abs(len(a) - len(b)) <= edits and lev(a, b) <= edits} for a in names}
    got = lines.line_classes(df, edits=edits).collect()
    assert len(got) == len(names)
    want = sorted((min(i for i in ids if i is not None), len(ids), len(a), len(near[a])) for a, (ids, _) in seen.items())
    assert sorted((r["first_doc"], r["copies"], r["n_chars"], r["n_links"]) for r in got) == want
    assert any(near.values())
    group = {a: a for a in names}
    for a in names:
        for b in near[a]:
            x, y = group[a], group[b]
            group = {k: x if v == y else v for k, v in group.items()}
    sizes = {}
    for v in group.values():
        sizes[v] = sizes.get(v, 0) + 1
    of_class = {}
    for r in got:
        of_class[r["class_id"]] = of_class.get(r["class_id"], 0) + 1
    assert sorted(sizes.values()) == sorted(of_class.values())


def test_empty(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert lines.line_classes(none).count() == 0


def test_changed_words_in_long_lines(spark):
    rnd = random.Random(8)
    vocab = ["".join(rnd.choice("abcdefghijklmnop") for _ in range(rnd.randrange(2, 10))) for _ in range(300)]
    common = [rnd.choice(vocab) for _ in range(9)]  # a passage of many lines
    pool = []
    for n in [8, 11, 12, 13, 22, 23, 24, 25, 26, 36, 59, 60, 61, 100, 130] * 2:
        base = [rnd.choice(vocab) for _ in range(n)]
        if n > 20:
            base[5:14] = common
        pool.append(base)
        for changes in (1, 2, 3, n // 12, n // 12 + 1):
            words = list(base)
            for _ in range(changes):
                k, kind = rnd.randrange(len(words)), rnd.randrange(3)
                words[k:k + (kind != 0)] = [rnd.choice(vocab)] * (kind != 1)
            pool.append(words)
    names = sorted({" ".join(w) for w in pool})
    near = {a: 0 for a in names}
    for i, a in enumerate(names):
        for b in names[:i]:
            x, y = a.split(), b.split()
            k = max(len(x), len(y)) // 12
            if abs(len(x) - len(y)) <= k and lev(x, y) <= k or abs(len(a) - len(b)) <= 1 and min(len(a), len(b)) >= 20 and lev(a, b) <= 1:
                near[a] += 1
                near[b] += 1
    docs = spark.createDataFrame(list(enumerate(names)) + [(900 + k, a) for k, a in enumerate(names[::3])], "doc_id long, text string")
    got = {r["first_doc"]: r["n_links"] for r in lines.line_classes(docs, per_edit=lines.PER_EDIT).collect()}
    assert got == {k: near[a] for k, a in enumerate(names)}
    assert sum(map(bool, near.values())) > 100


def test_repeated_lines_are_removed(spark):
    vocab = [f"word{k}" for k in range(40)]
    long = " ".join(vocab[:30])
    near = " ".join([*vocab[:12], "changed", *vocab[13:30]])
    other = " ".join(vocab[25:40])
    docs = [(3, f"{near}\n\n tiny\nown line of three"), (1, f"{long} \n{other}\n{long}"), (2, f"{other}\nrest\n\t{near}"), (7, None), (8, "rest"),
            (2, f"again\n{long}"), (None, "tiny\nof no document")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = [tuple(r) for r in lines.remove_lines(df).collect()]
    assert sorted(got, key=str) == sorted([
        (None, "tiny\nof no document", 0), (1, f"{long} \n{other}", 1), (3, "\nown line of three", 2), (7, None, 0), (8, "", 1),
        (2, "rest", 2), (2, "again", 1)], key=str)
    members = lines.line_members(df).collect()
    assert len(members) == 14
    assert sorted((r["doc_id"], r["line_no"]) for r in members if r["copies"] > 1 and r["n_chars"] == len(other)) == [(1, 1), (2, 0)]
    of = {r["class_id"] for r in members if r["n_links"]}
    assert len(of) == 1 and sum(r["class_id"] in of for r in members) == 5
    assert [(r["doc_id"], r["line_no"]) for r in members if r["class_id"] in of and r["kept"]] == [(1, 0)]
    assert lines.remove_lines(df.limit(0)).count() == 0


def test_keys_of_one_line_do_not_reach_the_join(spark):
    rnd = random.Random(4)
    vocab = ["".join(rnd.choice("abcdefghijklmnop") for _ in range(8)) for _ in range(3000)]
    texts = [" ".join(rnd.choice(vocab) for _ in range(30)) for _ in range(200)]
    words = texts[7].split()
    texts += [" ".join([*words[:15], "changed", *words[16:]]), texts[9][:40] + "#" + texts[9][41:]]
    rows = lines.word_rows(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), 12).cache()
    keys = rows.select("id", F.explode("keys").alias("key")).cache()
    left = lines.that_meet(keys, lines.met_keys(rows, F.col("keys"), "test")).groupBy("key").count().collect()
    want = {r["key"] for r in keys.groupBy("key").count().where("count > 1").collect()}
    assert want and want <= {r["key"] for r in left}
    assert sum(r["count"] for r in left) < keys.count() / 10
    near = lines.word_pairs(rows, 12).collect()
    assert len(near) == 2


def test_winnowed_hashes(spark):
    hashes = [[(k * k * 7919 + 13 * k * s) % 10007 for k in range(n)] for s, n in ((1, 11), (2, 30), (3, 4), (5, 5))]
    df = spark.createDataFrame([(h,) for h in hashes], "w array<long>")
    each = F.transform(F.sequence(F.lit(0), F.size("w") - 4), lambda i: F.xxhash64(F.lit(9), *[F.get("w", i + k) for k in range(4)]))
    for r in df.select(each.alias("all"), lines.winnowed(F.col("w"), 4, 3, 9).alias("got")).collect():
        assert set(r["got"]) == {min(r["all"][j:j + 3]) for j in range(max(1, len(r["all"]) - 2))}
        assert len(set(r["got"])) == len(r["got"])


def test_common_ends_are_cut_before_words_are_compared(spark):
    rnd = random.Random(6)
    rows = [("a b", "a  b"), ("a", "a a"), ("a b a b", "a b"), ("x", "y")]
    for _ in range(150):
        s = [rnd.choice("abcd") for _ in range(rnd.randrange(1, 40))]
        t = list(s)
        for _ in range(rnd.randrange(4)):
            k = rnd.randrange(len(t) + 1)
            t[k:k + rnd.randrange(2)] = [rnd.choice("abcd")] * rnd.randrange(2)
        rows.append((" ".join(s), " ".join(t) or "a"))
    df = spark.createDataFrame(rows, "x string, y string")
    words = lambda c: F.array_compact(F.split(c, " +"))
    for r in df.withColumn("e", lines.without_common_ends(words("x"), words("y"))).collect():
        a, b = r["x"].split(), r["y"].split()
        while a and b and a[0] == b[0]:
            a, b = a[1:], b[1:]
        while a and b and a[-1] == b[-1]:
            a, b = a[:-1], b[:-1]
        assert (r["e"]["x"], r["e"]["y"]) == (a, b)
    far = {(x, y): lev(x.split(), y.split()) for x, y in rows}
    got = {(r["x"], r["y"]): r["distance"] for r in lines.word_distance(df, 4).collect()}
    assert got == {(x, y): d for (x, y), d in far.items() if d <= max(len(x.split()), len(y.split())) // 4}


@pytest.mark.parametrize("codes", [3, 1 << 20])
def test_words_that_share_a_character_are_told_apart(spark, monkeypatch, codes):
    monkeypatch.setattr(lines, "CODES", codes)
    rnd = random.Random(codes)
    vocab = [f"w{k}" for k in range(9)]
    rows = []
    for _ in range(150):
        s = [rnd.choice(vocab) for _ in range(rnd.randrange(3, 40))]
        t = list(s)
        for _ in range(rnd.randrange(5)):
            t[rnd.randrange(len(t))] = rnd.choice(vocab)
        rows.append((" ".join(s), "  ".join(t)))
    df = spark.createDataFrame(rows, "x string, y string")
    want = {(x, y): lev(x.split(), y.split()) for x, y in rows}
    got = {(r["x"], r["y"]): r["distance"] for r in lines.word_distance(df, 4).collect()}
    assert got == {(x, y): d for (x, y), d in want.items() if d <= max(len(x.split()), len(y.split())) // 4}
    codes_of = df.select(lines.words_of(F.col("x")).alias("w"), lines.coded(lines.words_of(F.col("x"))).alias("c")).collect()
    assert all(len(r["c"]) == len(r["w"]) for r in codes_of)


def test_codes_made_before_are_used(spark):
    # a code that says far apart drops the pair before its texts are compared
    df = spark.createDataFrame([("a b c d", "a b c x", "1234", "5678"), ("a b c d", "a b c y", "1234", "123y")],
                               "x string, y string, code_x string, code_y string")
    got = lines.word_distance(df, 4)
    assert got.columns == ["x", "y", "distance"]
    assert [tuple(r) for r in got.collect()] == [("a b c d", "a b c y", 1)]
