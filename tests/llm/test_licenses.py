import re

from tessera.llm import licenses

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))


def brute_base(text):
    w = words(text)
    at = sorted((i, label) for phrase, label in licenses.PHRASES for p in [phrase.split()]
                for i in range(len(w)) if w[i:i + len(p)] == p)
    return (len(w), len(at), at[0][0] if at else None, at[-1][0] if at else None, ",".join(sorted({x for _, x in at})))


MIT = dict((a, b) for a, b in licenses.TEXTS)["mit"]
ROWS = [
    (0, "GNU General-Public  License, and the MIT license; CC BY cc by"), (1, None), (2, "..."), (3, "the apache"), (4, "Apache\nLicense"),
    (5, "intro words " + MIT.upper().replace(" ", ", ") + " tail"),
    (6, MIT.replace("free of charge", "entirely free of any charge") + " mit license"),
    (7, "permission is hereby granted to you"), (8, "gnu general public gnu general public license license"),
    (9, "K cc by"), (9, "K cc by"), (None, "mit license"), (10, "word " * 40_000 + "MIT license"), (11, "cc bÿ cc-by-sa ccby"),
]


def test_places_and_labels(spark):
    docs = spark.createDataFrame([(*r, "x", "y") for r in ROWS], "doc_id long, text string, label string, words string")
    got = licenses.scan(docs).collect()
    key = lambda r: (str(r[0]), r[1:3])
    want = sorted(((i, *brute_base(t)) for i, t in ROWS), key=key)
    assert sorted(((r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) for r in got), key=key) == want
    by = {r["doc_id"]: r for r in got}
    assert by[5]["labels"] == "mit" and by[5]["base_labels"] == "" and by[5]["score"] == 1.0
    assert by[6]["labels"] == "mit" and by[6]["base_labels"] == "mit"
    assert by[7]["labels"] == "" and by[7]["score"] == 0.0 and by[0]["labels"] == "cc-by,gpl,mit"
    assert licenses.scan(docs.limit(0)).count() == 0


def test_drifted_copy_is_one_span(spark):
    docs = spark.createDataFrame([(1, MIT.replace("a copy", "one more copy").replace("and", "and also"))], "doc_id long, text string")
    got = licenses.spans(licenses.hits(docs, licenses.templates(spark))).where("tid >= 0").collect()
    assert [r["label"] for r in got] == ["mit"] and 0.4 <= got[0]["cover"] < 1
