"""Line dedup by a segment-partition edit join, in DataFrame functions only.

1. Lines are cut out of the texts, trimmed and reduced to distinct lines (two
   64-bit hashes) by one partially combined aggregate that carries each
   line's keys, not its text.
2. A line of n characters is cut into edits + 1 segments; a line within the
   threshold contains at least one of them unchanged.  Index rows hold the
   hash of (length, segment number, segment).  Probe rows hold, for every
   partner length n - edits .. n, the hashes of the few substrings that the
   multi-match rule allows (Li et al., Pass-Join).
3. Index and probe rows also carry eight one-byte hashes of equal pieces.
   Each edit spoils at most one piece, so a pair with more than ``edits``
   unmatched pieces is dropped inside the join.  This loses no pair.
   Keys of a single line are dropped before the join: halves of the keys are
   counted, and a bitmap of those counted twice lets the rest through.
4. Surviving pairs fetch their texts and are verified by Hyyroe's banded
   bit-parallel edit distance on what common prefix and suffix leave over.
5. Longer lines also link when few of their words changed: one word edit
   (insert, delete, replace) per ``PER_EDIT`` words of the longer line.  k edits
   leave a run of (n - k) / (k + 1) equal words, so for every length class of
   ``CLASSES`` the two lines share a window of ``q + w - 1`` words, and in it the
   smallest of ``w`` hashes of ``q`` words (winnowing).  Lines meet on these
   hashes, linear in their words; a 64-bit parity bitmap of the words drops
   pairs beyond the threshold inside the join.  This loses no pair.  Survivors
   are verified by the edit distance of their word sequences, written as one
   character per word, made once per line; the few pairs in which two words
   share a character get characters of their own.
   Candidate pairs are dealt by pairs of blocks of lines, and a line's text is sent
   to a pair of blocks once: the pairs of a class grow with its square, the texts
   sent with it by a sixty-fourth of that.
6. Links between distinct lines give classes (connected components).
7. ``membership`` names every line of every text with its class; the first
   line of a class, by doc_id and line number, is kept.  ``remove_lines``
   gives the texts without the others.

Lines of fewer than ``PER_EDIT`` words keep the one-character threshold: there
one changed word ("Page 1", "Page 2") is a different line.

Edge cases: null texts and blank lines have no lines; lines shorter than
``min_chars`` are only matched exactly; repeated rows add copies; an empty
table gives no rows.  In ``membership`` a null doc_id sorts first and rows that
repeat a doc_id are separate texts (see ``suffix.numbered``).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import maybe_in, pinned, saved
from tessera.llm.suffix import numbered
from tessera.operators.graph import components
from tessera.operators.ordering import with_position
from tessera.session import discard

EDITS = 1
MIN_CHARS = 20
PIECES = 8
PER_EDIT = 12
CODES = 1 << 20  # characters that stand for words
BLOCK = 64  # lines whose candidate pairs are compared together
CO_PARTITION = "spark.sql.requireAllClusterKeysForCoPartition"
# (words of the longer line from, q, w); q + w - 1 is at most the shortest
# possible longest common run of the class
CLASSES = [(12, 4, 3), (24, 5, 4), (60, 5, 6)]


def lines_of(docs: DataFrame) -> DataFrame:
    """(doc_id, line, id, id2) of every line that is not blank."""
    line = F.explode(F.split("text", "\n", -1)).alias("line")
    df = docs.select("doc_id", "text").select("doc_id", line)
    df = df.select("doc_id", F.btrim("line", F.lit(" \t\n\x0b\f\r")).alias("line"))
    return df.where("line != ''").select(
        "doc_id", "line", F.xxhash64("line").alias("id"), F.xxhash64(F.lit("second"), "line").alias("id2"))


def segment(n: Column, k: int, parts: int) -> tuple[Column, Column]:
    """(start from 0, length) of segment k of a line of n characters: equal
    lengths, the last segments one longer where n does not divide."""
    base, longer = F.floor(n / parts).cast("int"), F.pmod(n, F.lit(parts)).cast("int")
    extra = F.greatest(F.lit(0), F.lit(k - parts) + longer)  # longer segments before k
    return base * k + extra, base + (F.lit(parts - k) <= longer).cast("int")


def shifts(k: int, parts: int, gap: int, edits: int) -> range:
    """Start shifts of segment k in a line that is ``gap`` longer: edits left
    of the segment and right of it cannot both exceed what pigeonhole allows."""
    low = max(-k, gap - (edits - k), -((edits - gap) // 2))
    high = min(k, gap + (edits - k), gap + (edits - gap) // 2)
    return range(low, high + 1)


def part_hash(start: Column, length: Column) -> Column:
    return F.xxhash64(F.substring(F.col("line"), start + 1, length))


def signature(n: Column, shift: int) -> Column:
    """Eight byte hashes of the pieces of a partner of n characters, read at
    ``shift``; pieces that would start before the line hash as empty."""
    size = F.floor(n / PIECES).cast("int")
    out = []
    for j in range(PIECES):
        start = size * j + shift
        value = F.pmod(F.xxhash64(F.substring(F.col("line"), start + 1, F.when(start >= 0, size).otherwise(0))), F.lit(256))
        out.append(F.shiftleft(value, 8 * j))
    return reduce(lambda a, b: a.bitwiseOR(b), out)


def keyed(docs: DataFrame, edits: int, min_chars: int) -> DataFrame:
    """Distinct lines: id, id2, first_doc, copies, n_chars, index rows and
    probe rows (null below ``min_chars``)."""
    n = F.col("n_chars")
    parts = edits + 1
    index, probe, sigs = [], [], {}
    for k in range(parts):
        index.append(F.xxhash64(n, F.lit(k), part_hash(*segment(n, k, parts))))
    for gap in range(edits + 1):
        slack = (edits - gap) // 2
        sigs[gap] = [signature(n - gap, s) for s in range(-slack, gap + slack + 1)]
        for k in range(parts):
            start, length = segment(n - gap, k, parts)
            for s in shifts(k, parts, gap, edits):
                probe.append((gap, F.xxhash64(n - gap, F.lit(k), part_hash(start + s, length))))
    df = lines_of(docs).withColumn("n_chars", F.char_length("line").cast("int"))
    long = F.col("n_chars") >= max(min_chars, parts, PIECES)
    cols = [F.when(long, c) for c in [*index, *[c for _, c in probe], *[c for g in sigs for c in sigs[g]]]]
    names = [f"v{k}" for k in range(len(cols))]
    df = df.select("doc_id", "id", "id2", "n_chars", *[c.alias(v) for c, v in zip(cols, names)])
    df = df.groupBy("id", "id2").agg(
        F.min("doc_id").alias("first_doc"), F.count("*").alias("copies"), F.max("n_chars").alias("n_chars"),
        *[F.max(v).alias(v) for v in names])  # equal lines have equal values
    at, by_gap = len(index) + len(probe), {}
    for g in sigs:
        by_gap[g] = [F.col(names[at + j]) for j in range(len(sigs[g]))]
        at += len(sigs[g])
    width = 2 * edits + 1
    own = by_gap[0][edits // 2]  # shift 0 of the own length
    pad = lambda xs: [*xs, *[xs[-1]] * (width - len(xs))]
    probes = [F.struct(F.col(names[len(index) + j]).alias("key"), *[c.alias(f"s{i}") for i, c in enumerate(pad(by_gap[g]))])
              for j, (g, _) in enumerate(probe)]
    return df.select("id", "id2", "first_doc", "copies", "n_chars", F.array(*[F.col(v) for v in names[:len(index)]]).alias("index"),
                     own.alias("sig"), F.array(*probes).alias("probes"), (F.col("n_chars") >= max(min_chars, parts, PIECES)).alias("long"))


def met_keys(rows: DataFrame, keys: Column, tag: str) -> DataFrame:
    """(short): upper halves of the keys that at least two of ``rows`` hold;
    ``keys`` are distinct within a row.  Most keys have one line, and four
    bytes of them are far less to shuffle than their join rows."""
    short = rows.select(F.explode(keys).alias("key")).select(short_key("key").alias("short"))
    return saved(short.groupBy("short").agg(F.count("*").alias("n")).where("n > 1").select("short"), tag)


def short_key(key: str) -> Column:
    return F.shiftright(key, 32).cast("int")


def that_meet(rows: DataFrame, shared: DataFrame) -> DataFrame:
    """``rows`` without those whose ``key`` no other line has."""
    return maybe_in(rows.withColumn("short", short_key("key")), "short", shared).where("_maybe").drop("short", "_maybe")


def candidate_pairs(lines: DataFrame, edits: int) -> DataFrame:
    """Distinct (a, b) ids that share a segment and enough pieces."""
    lines = lines.where("long")
    shared = met_keys(lines, F.array_distinct(F.concat("index", F.col("probes.key"))), "lines-char-keys")
    left = that_meet(lines.select(F.col("id").alias("a"), F.col("sig"), F.explode("index").alias("key")), shared)
    right = that_meet(lines.select(F.col("id").alias("b"), F.explode("probes").alias("p")).select("b", "p.*"), shared)
    width = 2 * edits + 1
    spoiled = F.lit(0)
    for j in range(PIECES):
        byte = F.lit(255 << (8 * j) if j < 7 else -(1 << 56))
        hit = reduce(lambda x, y: x | y, [F.col("sig").bitwiseXOR(F.col(f"s{i}")).bitwiseAND(byte) == 0 for i in range(width)])
        spoiled = spoiled + F.when(hit, 0).otherwise(1)
    met = left.join(right, (left["key"] == right["key"]) & (F.col("a") != F.col("b")) & (spoiled <= edits))
    return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def common_prefix(a: Column, b: Column) -> Column:
    """Length of the common prefix, by doubling steps from the largest power
    of two down."""
    top = F.least(F.char_length(a), F.char_length(b))
    steps = F.transform(F.sequence(F.lit(0), F.ceil(F.log2(top + 1)).cast("int")), lambda k: F.call_function("shiftleft", F.lit(1), k))
    return F.aggregate(F.reverse(steps), F.lit(0), lambda done, s: F.when(
        (done + s <= top) & (F.substring(a, done + 1, s) == F.substring(b, done + 1, s)), done + s).otherwise(done))


def banded_distance(a: Column, b: Column, edits: int) -> Column:
    """Edit distance of two arrays of characters if at most ``edits``, else
    some larger number.  ``a`` must not be shorter than ``b``.

    Bit k of a vector stands for row j - edits + k of column j; vp / vn are
    the vertical differences, and the distance is followed down the lowest
    diagonal of the band and then along the last row."""
    top, mask = 2 * edits, (1 << (2 * edits + 1)) - 1
    n, m = F.size(a), F.size(b)

    def bit(x: Column, at: Column | int) -> Column:
        return F.shiftright(x, at).bitwiseAND(1) if isinstance(at, int) else F.call_function("shiftright", x, at).bitwiseAND(1)

    def column(s: Column, j: Column) -> Column:
        c = F.get(b, j - 1)
        match = reduce(lambda x, y: x + y, [
            F.when(F.get(a, j + (k - edits - 1)) == c, 1 << k).otherwise(0) for k in range(top + 1)])
        state = F.struct(match.alias("x"), s["vp"].alias("vp"), s["vn"].alias("vn"), s["d"].alias("d"))

        def step(t: Column) -> Column:  # names the intermediate vectors once
            x, vp, vn = t["x"], t["vp"], t["vn"]
            d0 = ((x.bitwiseAND(vp) + vp).bitwiseAND(mask).bitwiseXOR(vp)).bitwiseOR(x).bitwiseOR(vn)
            return F.struct(d0.alias("d0"), vp.alias("vp"), vn.alias("vn"), t["d"].alias("d"))

        def score(t: Column) -> Column:
            hp = t["vn"].bitwiseOR(t["d0"].bitwiseOR(t["vp"]).bitwiseXOR(mask))
            hn = t["d0"].bitwiseAND(t["vp"])
            row = F.lit(top) - (j + edits - n)
            d = F.when(j <= n - edits, t["d"] + 1 - bit(t["d0"], top)).when(
                row >= 0, t["d"] + bit(hp, row) - bit(hn, row)).otherwise(t["d"] + 1)
            down = F.shiftright(t["d0"], 1)
            return F.struct(hn.bitwiseOR(down.bitwiseOR(hp).bitwiseXOR(mask)).alias("vp"),
                            down.bitwiseAND(hp).alias("vn"), d.alias("d"))

        once = lambda value, fn: F.get(F.transform(F.array(value), fn), F.lit(0))
        return once(once(state, step), score)

    start = F.struct(F.lit(mask & ~((1 << edits) - 1)).alias("vp"), F.lit(0).alias("vn"),
                     F.least(F.lit(edits), n).alias("d"))
    columns = F.when(m > 0, F.sequence(F.lit(1), m)).otherwise(F.array().cast("array<int>"))
    return F.aggregate(columns, start, column, lambda s: s["d"])


def distance(pairs: DataFrame, edits: int) -> DataFrame:
    """Adds ``distance`` to rows with strings x and y; rows beyond ``edits``
    are dropped."""
    cx, cy = F.char_length("x"), F.char_length("y")
    df = pairs.where(F.abs(cx - cy) <= edits)
    swap = cx < cy
    df = df.withColumns({"_x": F.when(swap, F.col("y")).otherwise(F.col("x")), "_y": F.when(swap, F.col("x")).otherwise(F.col("y"))})
    df = df.withColumn("_pre", pinned(common_prefix(F.col("_x"), F.col("_y"))))
    rest = lambda c: F.substring(F.col(c), F.col("_pre") + 1, F.char_length(c))
    df = df.withColumns({"_x": rest("_x"), "_y": rest("_y")}).drop("_pre")
    df = df.withColumn("_suf", pinned(common_prefix(F.reverse("_x"), F.reverse("_y"))))
    rest = lambda c: F.substring(F.col(c), F.lit(1), F.char_length(c) - F.col("_suf"))
    chars = lambda c: F.when(c == "", F.array().cast("array<string>")).otherwise(F.split(c, ""))
    df = df.withColumns({"_x": pinned(chars(rest("_x"))), "_y": pinned(chars(rest("_y")))}).drop("_suf")
    df = df.withColumn("distance", pinned(banded_distance(F.col("_x"), F.col("_y"), edits)))
    return df.where(F.col("distance") <= edits).drop("_x", "_y")


def words_of(line: Column) -> Column:
    return F.array_remove(F.split(line, r"[\x20\x09-\x0D]+", -1), "")


def word_edits(n: Column, per_edit: int) -> Column:
    return F.floor(n / per_edit).cast("int")


def winnowed(words: Column, q: int, w: int, seed: int) -> Column:
    """Hashes of ``q`` words, given by their hashes, that are the smallest of
    ``w`` neighbours; hashes of different seeds never meet."""
    n = F.size(words) - q + 1  # of shingles
    shingles = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.xxhash64(F.lit(seed), *[F.get(words, i + k) for k in range(q)]))
    once = lambda value, fn: F.get(F.transform(F.array(value), fn), F.lit(0))
    smallest = lambda a: F.transform(F.sequence(F.lit(0), F.greatest(n - w, F.lit(0))), lambda j: F.least(
        *[F.get(a, j + k) for k in range(w)]))  # ``least`` skips the nulls behind the end
    return F.array_distinct(once(shingles, smallest))


def word_rows(docs: DataFrame, per_edit: int) -> DataFrame:
    """Distinct lines that may link by words: id, n_words, sig (parity of the
    words per hash bucket) and keys (class, hash)."""
    hashed = F.transform(words_of(F.col("line")), lambda w: F.xxhash64(w))
    df = lines_of(docs).select("id", pinned(hashed).alias("words")).withColumn("n_words", F.size("words"))
    first = CLASSES[0][0]
    df = df.where(F.col("n_words") >= first - first // per_edit)
    bit = lambda w: F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(w, F.lit(64)).cast("int"))
    keys = []
    for k, (low, q, w) in enumerate(CLASSES):
        top = CLASSES[k + 1][0] if k + 1 < len(CLASSES) else None
        inside = F.col("n_words") >= low - low // per_edit
        if top:
            inside = inside & (F.col("n_words") < top)
        keys.append(F.when(inside, winnowed(F.col("words"), q, w, k)).otherwise(F.array().cast("array<long>")))
    df = df.select("id", "n_words", F.aggregate("words", F.lit(0).cast("long"), lambda a, w: a.bitwiseXOR(bit(w))).alias("sig"),
                   F.concat(*keys).alias("keys"))
    return df.groupBy("id").agg(*[F.first(c).alias(c) for c in ("n_words", "sig", "keys")])  # equal lines have equal values


def word_pairs(rows: DataFrame, per_edit: int) -> DataFrame:
    """Distinct (a, b) ids that share a hash and could be within the word
    threshold."""
    shared = met_keys(rows, F.col("keys"), "lines-word-keys")
    side = lambda name: that_meet(rows.select(F.col("id").alias(name), F.col("n_words").alias(f"n_{name}"), F.col("sig").alias(f"s_{name}"),
                                              F.explode("keys").alias("key")), shared)
    left, right = side("a"), side("b")
    k = word_edits(F.greatest("n_a", "n_b"), per_edit)
    met = left.join(right, (left["key"] == right["key"]) & (F.col("a") < F.col("b")) & (F.abs(F.col("n_a") - F.col("n_b")) <= k)
                    & (F.bit_count(F.col("s_a").bitwiseXOR(F.col("s_b"))) <= 2 * k))
    return met.select("a", "b").distinct()


def without_common_ends(x: Column, y: Column) -> Column:
    """(x, y) of two arrays without the items they begin or end with in common."""

    def common(a: Column, b: Column) -> Column:  # doubling steps, as ``common_prefix``
        top = F.least(F.size(a), F.size(b))
        steps = F.transform(F.sequence(F.lit(0), F.ceil(F.log2(top + 1)).cast("int")), lambda k: F.call_function("shiftleft", F.lit(1), k))
        return F.aggregate(F.reverse(steps), F.lit(0), lambda done, s: F.when(
            (done + s <= top) & (F.slice(a, done + 1, s) == F.slice(b, done + 1, s)), done + s).otherwise(done))

    once = lambda value, fn: F.get(F.transform(F.array(value), fn), F.lit(0))
    both = lambda a, b: F.struct(a.alias("x"), b.alias("y"))
    tail = lambda a, n: F.slice(a, n + 1, F.size(a) - n)
    step = lambda p: once(common(p["x"], p["y"]), lambda n: both(F.reverse(tail(p["x"], n)), F.reverse(tail(p["y"], n))))
    return once(once(both(x, y), step), step)  # the second step turns them round again


def coded(words: Column) -> Column:
    """One character per word, a hash of it: equal words have equal ones."""
    at = F.transform(words, lambda w: F.lpad(F.hex(F.pmod(F.xxhash64(w), F.lit(CODES)) + 0x10000), 8, "0"))
    return F.decode(F.unhex(F.array_join(at, "")), "UTF-32")


def word_distance(pairs: DataFrame, per_edit: int) -> DataFrame:
    """Adds ``distance``, the edit distance of the word sequences of x and y;
    rows beyond the threshold are dropped.  ``code_x`` and ``code_y`` may give
    the ``coded`` words, so that they are made once per line, not per pair."""
    df = pairs
    for side in ("x", "y"):
        if f"code_{side}" not in df.columns:
            df = df.withColumn(f"code_{side}", pinned(coded(words_of(F.col(side)))))
    df = df.withColumn("_k", word_edits(F.greatest(F.char_length("code_x"), F.char_length("code_y")), per_edit))
    # words that share a character only bring the lines nearer
    df = df.withColumn("_near", pinned(F.call_function("levenshtein", F.col("code_x"), F.col("code_y"), F.col("_k")))).where("_near >= 0")
    df = df.withColumns({"_x": pinned(words_of(F.col("x"))), "_y": pinned(words_of(F.col("y")))})
    kinds = lambda a: F.size(F.array_distinct(a))
    df = df.withColumn("_apart", pinned(kinds(F.concat("_x", "_y")) == kinds(F.split(F.concat("code_x", "code_y"), ""))))
    mixed = lambda value: F.when(~F.col("_apart"), value)  # noqa: E731  what follows is for the few pairs whose words share one
    # numbering the words below is quadratic in what differs, not in the lines
    df = df.withColumn("_ends", pinned(mixed(without_common_ends(F.col("_x"), F.col("_y")))))
    df = df.withColumns({"_x": F.col("_ends.x"), "_y": F.col("_ends.y")}).drop("_ends")
    df = df.withColumn("_all", pinned(mixed(F.array_distinct(F.concat("_x", "_y")))))

    def letters(words: str) -> Column:
        """One character per word, the same for equal words of the pair."""
        at = F.transform(words, lambda w: F.array_position("_all", w))
        code = F.transform(at, lambda p: F.lpad(F.hex(F.when(p < 0xD800, p).otherwise(p + 0x800)), 8, "0"))  # no surrogates
        return F.decode(F.unhex(F.array_join(code, "")), "UTF-32")

    df = df.withColumns({"_x": pinned(mixed(letters("_x"))), "_y": pinned(mixed(letters("_y")))})
    df = df.withColumn("distance", pinned(F.when(F.col("_apart"), F.col("_near")).otherwise(
        F.call_function("levenshtein", F.col("_x"), F.col("_y"), F.col("_k")))))
    return df.where(F.col("distance") >= 0).drop("_x", "_y", "_all", "_k", "_near", "_apart", "code_x", "code_y")


def line_name(id_: str, id2: str) -> Column:
    return F.lower(F.concat(F.lpad(F.hex(id_), 16, "0"), F.lpad(F.hex(id2), 16, "0")))


def line_classes(docs: DataFrame, edits: int = EDITS, min_chars: int = MIN_CHARS, per_edit: int | None = None) -> DataFrame:
    """One row per distinct line: line_id, first_doc (smallest doc_id with
    it), copies, n_chars, n_links (distinct lines within ``edits`` characters
    or, with ``per_edit``, one word edit per so many words) and class_id
    (smallest line_id of its component)."""
    lines = saved(keyed(docs, edits, min_chars), "lines-keyed")
    pairs = saved(candidate_pairs(lines, edits), "lines-char-pairs").withColumn("by_word", F.lit(False))
    rows = saved(lines.select(line_name("id", "id2").alias("line_id"), "first_doc", "copies", "n_chars"), "lines-distinct")
    discard(lines)  # its keys are most of it
    if per_edit:
        words = saved(word_rows(docs, per_edit), "lines-words")
        pairs = pairs.unionByName(saved(word_pairs(words, per_edit), "lines-word-pairs").withColumn("by_word", F.lit(True)))
        discard(words)
    pairs = saved(celled(pairs), "lines-pairs")
    ids = saved(pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct(), "lines-ids")
    # few lines have a candidate; their texts are fetched, the others are not
    near = maybe_in(lines_of(docs), "id", ids).where("_maybe").drop("_maybe")
    texts = near.join(ids, "id", "left_semi").groupBy("id", "id2").agg(F.first("line").alias("line"))
    texts = saved(texts.withColumn("code", coded(words_of(F.col("line"))) if per_edit else F.lit(None).cast("string")), "lines-texts")
    # lines are numbered in the order of their names: links are many, and a number is short
    names = saved(with_position(texts.select(line_name("id", "id2").alias("line_id"), "id", "id2"), ["line_id"]), "lines-names")
    links = distance(with_texts(pairs.where("not by_word"), texts.drop("code"), names), edits).select("src", "dst")
    if per_edit:
        links = links.unionByName(word_distance(with_texts(pairs.where("by_word"), texts, names), per_edit).select("src", "dst"))
    links = beside(lambda: saved(links.distinct(), "lines-links"), rows.sparkSession)
    ends = links.select(F.col("src").alias("pos")).union(links.select("dst"))
    count = saved(ends.groupBy("pos").agg(F.count("*").alias("n_links")), "lines-count")
    label = components(count.withColumnRenamed("pos", "id"), links).select(F.col("id").alias("pos"), F.col("comp").alias("first"))
    first = names.select(F.col("pos").alias("first"), F.col("line_id").alias("class_id"))
    of_line = names.select("pos", "line_id").join(count, "pos").join(label, "pos").join(first, "first").select("line_id", "n_links", "class_id")
    return (rows.join(of_line, "line_id", "left")
            .withColumns({"n_links": F.coalesce("n_links", F.lit(0)).cast("long"), "class_id": F.coalesce("class_id", "line_id")}))


def celled(pairs: DataFrame) -> DataFrame:
    """``pairs`` with ``cell``, a pair of blocks of lines.  Lines with the same
    smallest candidate, as the lines of a class mostly have, are in blocks of about ``BLOCK`` lines."""
    ends = pairs.select(F.col("a").alias("id"), F.col("b").alias("other")).union(pairs.select("b", "a"))
    lines = saved(ends.groupBy("id").agg(F.min("other").alias("other")).select("id", F.least("id", "other").alias("label")), "lines-labels")
    sizes = lines.groupBy("label").agg(F.ceil(F.count("*") / BLOCK).alias("k"))
    blocks = lines.join(sizes, "label").select("id", F.xxhash64("label", F.pmod(F.xxhash64("id"), F.col("k"))).alias("block"))
    blocks = saved(blocks, "lines-blocks")
    of = lambda c: blocks.select(F.col("id").alias(c), F.col("block").alias(f"block_{c}"))
    cell = F.xxhash64(F.least("block_a", "block_b"), F.greatest("block_a", "block_b"))
    return pairs.join(of("a"), "a").join(of("b"), "b").select("a", "b", "by_word", cell.alias("cell"))


def with_texts(pairs: DataFrame, texts: DataFrame, names: DataFrame) -> DataFrame:
    """(src, dst, x, y, code_x, code_y) of the pairs.  The texts of a cell are sent
    to it once, not once per pair; planned ``beside`` the pairs of
    the cell, both joins stay there."""
    used = pairs.select("cell", F.explode(F.array("a", "b")).alias("id")).distinct()
    rows = used.join(names.select("id", "id2", "pos").join(texts, ["id", "id2"]), "id").repartition("cell")

    def side(key: str, text: str, end: str) -> DataFrame:
        code = [F.col("code").alias(f"code_{text}")] if "code" in texts.columns else []
        return rows.select("cell", F.col("id").alias(key), F.col("pos").alias(end), F.col("line").alias(text), *code)

    met = pairs.select("cell", "a", "b").repartition("cell")
    return met.join(side("a", "x", "src"), ["cell", "a"]).join(side("b", "y", "dst"), ["cell", "b"]).drop("cell", "a", "b")


def beside(run, spark):
    """``run()`` with joins on more columns than their sides are dealt by planned without a further shuffle."""
    before = spark.conf.get(CO_PARTITION)
    spark.conf.set(CO_PARTITION, "false")
    try:
        return run()
    finally:
        spark.conf.set(CO_PARTITION, before)


def membership(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """(doc_id, doc, line_no, line_id, class_id, kept) of every line that is
    not blank.  ``rows`` come from ``numbered``, ``classes`` from
    ``line_classes``; line numbers count from 0 and include blank lines."""
    line = F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line")
    df = rows.select("doc_id", "doc", line).withColumn("line", F.btrim("line", F.lit(" \t\n\x0b\f\r"))).where("line != ''")
    df = df.select("doc_id", "doc", "line_no", F.xxhash64("line").alias("id"), F.xxhash64(F.lit("second"), "line").alias("id2"))
    # written: a join of two plain tables is one that Spark splits where a line is hot
    df = saved(df.select("doc_id", "doc", "line_no", line_name("id", "id2").alias("line_id")), "lines-members")
    place = F.struct("doc", "line_no")
    first = df.groupBy("line_id").agg(F.min(place).alias("first"))  # partially combined per line, then per class
    first = first.join(classes.select("line_id", "class_id"), "line_id")
    first = saved(first.groupBy("class_id").agg(F.min("first").alias("first")), "lines-first")
    named = saved(classes.select("line_id", "class_id").join(first, "class_id"), "lines-named")
    return df.join(named, "line_id").select("doc_id", "doc", "line_no", "line_id", "class_id", (place == F.col("first")).alias("kept"))


def line_members(docs: DataFrame, edits: int = EDITS, min_chars: int = MIN_CHARS, per_edit: int | None = PER_EDIT) -> DataFrame:
    """(doc_id, line_no, line_id, class_id, kept, first_doc, copies, n_chars,
    n_links): every line of every text, with the values of its distinct line."""
    classes = saved(line_classes(docs, edits, min_chars, per_edit), "lines-classes")
    members = saved(membership(numbered(docs), classes), "lines-membership").drop("doc", "class_id")
    return members.join(classes, "line_id").select(
        "doc_id", "line_no", "line_id", "class_id", "kept", "first_doc", "copies", "n_chars", "n_links")


def remove_lines(docs: DataFrame, edits: int = EDITS, min_chars: int = MIN_CHARS, per_edit: int | None = PER_EDIT) -> DataFrame:
    """(doc_id, text, n_removed) per row of ``docs``: the text without lines
    whose class has an earlier line.  Blank lines stay."""
    rows = numbered(docs)
    classes = saved(line_classes(docs, edits, min_chars, per_edit), "lines-classes")
    gone = membership(rows, classes).where("not kept").groupBy("doc").agg(F.collect_set("line_no").alias("gone"))
    left = F.filter(F.split("text", "\n", -1), lambda x, k: ~F.array_contains("gone", k))
    return rows.join(gone, "doc", "left").select(
        "doc_id", F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(left, "\n")).alias("text"),
        F.coalesce(F.size("gone"), F.lit(0)).alias("n_removed"))
