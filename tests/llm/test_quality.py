import re

from pyspark.sql import functions as F

from tessera.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    t = text or ""
    w = WORD.findall(t)
    lines, dup, seen = t.split("\n"), 0, set()
    for line in lines:
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    grams = {}
    for i in range(len(w) - 7):
        grams.setdefault(tuple(w[i:i + 8]), []).append(i)
    hit = {j for at in grams.values() if len(at) > 1 for i in at for j in range(i, i + 8)}
    n = len(w)
    return (n, sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(hit), n < 20 or 100 * len(hit) > 30 * n)


TEXTS = [None, "", " \n\t ", "a b c d e f g h " * 2, "a b c d e f g h i", "x " * 25, "one two\none two\n\n \n one two\none two", "é ü ñ #* $ | < >",
         " ".join(f"w{k}" for k in range(40)), " ".join(f"w{k % 11}" for k in range(60)), "word " + "long" * 50_000,
         " ".join(f"v{k}" for k in range(30_000)) + " tail " + " ".join(f"v{k}" for k in range(9)), "p\x0bq\x0cr s"]


def test_measures_equal_brute_force(spark):
    docs = spark.createDataFrame([(k, t, "c") for k, t in enumerate(TEXTS)] + [(3, TEXTS[3], "c")], "doc_id long, text string, n_words string")
    got = quality.judge(docs, [], keep=["doc_id"]).collect()
    want = sorted([(k, *brute(t)) for k, t in enumerate(TEXTS)] + [(3, *brute(TEXTS[3]))])
    cols = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    assert sorted(tuple(r[c] for c in cols) for r in got) == want
    assert all(r["kept"] != r["base_failed"] for r in got)
    assert quality.judge(docs.limit(0), [], keep=["doc_id"]).count() == 0


def corpus(spark):
    rows, labels = [], []
    for k in range(600):
        words = [f"w{(k * 31 + j * 7) % 997}" for j in range(60)]
        bad = k % 5 == 0
        if bad:
            words = [x if j % 3 else "|" for j, x in enumerate(words)] if k % 10 else [x.upper() + "!!" for x in words]
        rows.append((k, " ".join(words)))
        labels += [(k, 0 if bad else 1, 0)] if k % 2 == 0 or bad else []
    labels += [(0, 1, 0), (None, 0, 0), (99999, 0, 0), (7, None, None)]
    return (spark.createDataFrame(rows, "doc_id long, text string"),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def test_learned_list_rejects_bad_and_keeps_clean(spark):
    docs, labels = corpus(spark)
    rules = quality.learn_rules(docs, labels)
    assert 1 <= len(rules) <= 8
    got = quality.judge(docs, rules, keep=["doc_id"]).collect()
    assert all(r["kept"] for r in got if r["doc_id"] % 5)  # clean documents stay, labelled or not
    assert sum(not r["kept"] for r in got if r["doc_id"] % 5 == 0) >= 0.9 * 120
    again = quality.learn_rules(docs.repartition(5), labels.repartition(3))
    assert again == rules


def test_no_labels_keeps_everything(spark):
    docs, labels = corpus(spark)
    assert quality.learn_rules(docs, labels.limit(0)) == []
    assert quality.learn_rules(docs, labels.where("quality = 1")) == []
    assert quality.learn_rules(docs.limit(0), labels) == []


def test_filter_on_kept_does_not_recompute(spark):
    docs, _ = corpus(spark)
    out = quality.judge(docs.withColumn("_q", F.lit(1)), []).where("kept")
    assert out.count() == 600


def test_held_out_precision(spark):
    """On the labelled test table, rules learned from half of the labels."""
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    half = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0
    rules = quality.learn_rules(docs, labels.where(half))
    rest = quality.judge(docs, rules, keep=["doc_id"]).join(labels.where(~half), "doc_id").collect()
    by_rule = [r for r in rest if r["rule"] is not None and not r["base_failed"]]
    assert len(by_rule) >= 5 and sum(r["quality"] == 0 for r in by_rule) >= 0.9 * len(by_rule)
