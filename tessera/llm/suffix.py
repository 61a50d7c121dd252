"""Repeated byte strings by ranks of positions, doubled past the threshold.

Prefix doubling ranks every position by ever longer prefixes and drops it
once its rank is unique.  One row per byte position is many times the text
(see README), so the first rounds run on positions chosen by content:

1. Round one, 32 bytes.  For each start p the leftmost smallest 32-byte hash
   within its 100 bytes is p's anchor; equal 100-byte strings have equal
   anchors at equal offsets.  The starts of one anchor are an interval.  Spark
   sorts the anchors by rank; an anchor of unique rank settles its interval.
2. Round two, the whole context of the interval (100 bytes and more).  In a
   run of equal rank pairs all but the earliest interval are repeats.
3. Intervals that are the earliest of their context while their anchor has
   other contexts are cut into blocks of starts by distance to the anchor, an
   eighth of the threshold long.  The bytes common to all starts of a block
   (88 of 100) and the whole context of the block settle it as in rounds one
   and two: nearly all blocks are unique or repeats, at one row for a block.
4. What is still open is resolved start by start: a start's rank pair is
   (rank of 50 bytes at p, rank of 50 bytes at p + 50); sorting the pairs
   reranks at 100 bytes, and all but the first start of a rank are repeats.

Ranks are 64-bit polynomial hashes; two of them (128 bits) must agree.
Each batch settles its own repeats before the shuffle, so a passage shared by
a third of all documents does not meet in one task.  Sorting is Spark's;
tasks see sorted runs as a stream and hold one row.  The contexts of an anchor
are counted by a partially combined aggregate that is joined back.  Texts are
shuffled only for documents that a bounded bitmap cannot rule out.

Edge cases: null and empty texts have no bytes and no spans; texts shorter
than the threshold are kept; a null doc_id sorts first; rows that repeat a
doc_id are separate documents ordered by text hash; an empty table gives no
rows; very long texts are cut into overlapping pieces without effect on the
result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import maybe_in, saved

LENGTH = 100
GRAM = 32
PIECE = 1 << 22  # bytes hashed at a time; positions in a piece take 22 bits
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers: dict[str, np.ndarray] = {}


def _table(name: str, base: np.uint64, n: int) -> np.ndarray:
    if name not in _powers or len(_powers[name]) < n:
        size = max(n, 1 << 16)
        out = np.full(size, base, np.uint64)
        out[0] = 1
        _powers[name] = np.multiply.accumulate(out)
    return _powers[name]


def mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


class Hashes:
    """Hashes of any substring of a byte buffer, from one prefix sum."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _table("up", _BASE, n + 1)[:n], out=self.sums[1:])
        self.down = _table("down", _INVERSE, n + 1)

    def at(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[start]) * self.down[start])

    def every(self, length: int) -> np.ndarray:
        n = len(self.sums) - length
        return mixed((self.sums[length:] - self.sums[:n]) * self.down[:n])


def anchor_rows(data: np.ndarray, ends: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """(low, high, rank, context) of every interval of starts in a buffer of
    whole pieces that end at ``ends``."""
    empty = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    if len(data) < length:
        return empty
    hashes = Hashes(data)
    rank = hashes.every(gram)
    low22 = np.uint64((1 << 22) - 1)
    best = (rank & ~low22) | np.arange(len(rank), dtype=np.uint64)
    width, want = 1, length - gram + 1
    while width * 2 <= want:
        best = np.minimum(best[:-width], best[width:])
        width *= 2
    if width < want:
        best = np.minimum(best[:len(best) - (want - width)], best[want - width:])
    anchor = (best & low22).astype(np.int64)  # one per start 0 .. n - length
    inside = np.ones(len(anchor), bool)
    for e in ends.tolist():
        inside[max(0, e - length + 1):e] = False
    first = inside.copy()
    first[1:] &= ~inside[:-1] | (anchor[1:] != anchor[:-1])
    last = inside.copy()
    last[:-1] &= ~inside[1:] | (anchor[1:] != anchor[:-1])
    low, high = np.flatnonzero(first), np.flatnonzero(last)
    a = anchor[low]
    where = ((a - low).astype(np.uint64) << np.uint64(8)) + (high - low).astype(np.uint64)
    return low, high, rank[a], mixed(hashes.at(low, high + length) + where)


def pieces(raw: list[bytes], length: int, most: int | None = None) -> Iterator[tuple[list[int], list[int], bytes]]:
    """Buffers of at most ``most`` (PIECE) bytes or one part: (row, offset in
    its text) of each part and the bytes; parts of a long text are of PIECE
    bytes and overlap by length - 1."""
    rows, offsets, parts, size = [], [], [], 0
    for k, text in enumerate(raw):
        for at in range(0, max(1, len(text) - length + 1), PIECE - length + 1):
            part = text[at:at + PIECE]
            if rows and size + len(part) > (most or PIECE):
                yield rows, offsets, parts
                rows, offsets, parts, size = [], [], [], 0
            rows.append(k)
            offsets.append(at)
            parts.append(part)
            size += len(part)
    if rows:
        yield rows, offsets, parts


def utf8(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


SETTLED = 1 << 16  # flag in ``span``: a repeat that the task has settled


def settle_locally(pdf: pd.DataFrame) -> pd.DataFrame:
    """Before the shuffle, all but the earliest interval of a (rank, context)
    in a batch are repeats.  They are flagged, and their rank becomes a hash
    of their place, so a hot rank reaches its task once per batch."""
    rank, context = pdf["rank"].to_numpy(), pdf["context"].to_numpy()
    order = np.lexsort((pdf["low"], pdf["doc"], context, rank))
    r, c = rank[order], context[order]
    again = np.zeros(len(pdf), bool)
    again[order[1:]] = (r[1:] == r[:-1]) & (c[1:] == c[:-1])
    place = mixed(pdf["doc"].to_numpy().view(np.uint64) * _BASE + pdf["low"].to_numpy().view(np.uint64)).view(np.int64)
    return pdf.assign(rank=np.where(again, place, rank), span=np.where(again, pdf["span"] + SETTLED, pdf["span"]))


def anchors(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """(rank, context, doc, low, span): intervals low .. low + span."""

    def intervals(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            ids = pdf["doc"].to_numpy()
            for rows, offsets, parts in pieces([utf8(t) for t in pdf["text"]], length):
                ends = np.cumsum([len(p) for p in parts])
                low, high, rank, context = anchor_rows(np.frombuffer(b"".join(parts), np.uint8), ends, length, gram)
                part = np.searchsorted(ends, low, side="right")
                shift = np.array(offsets, np.int64) - (ends - [len(p) for p in parts])
                yield pd.DataFrame({"rank": rank.view(np.int64), "context": context.view(np.int64), "doc": ids[np.array(rows)[part]],
                                    "low": low + shift[part], "span": (high - low).astype(np.int32)})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            got = list(intervals(iter([pdf])))
            if got:
                yield settle_locally(pd.concat(got, ignore_index=True))

    return docs.select("doc", "text").mapInPandas(run, "rank long, context long, doc long, low long, span int")


def earliest(found: DataFrame) -> DataFrame:
    """(rank, doc, low, high, first): ``first`` marks the earliest interval of
    every (rank, context).  Tasks stream; the contexts of one rank are dealt
    over all of them."""

    def rows(pdf: pd.DataFrame, high: pd.Series, first: np.ndarray | bool) -> pd.DataFrame:
        return pd.DataFrame({"rank": pdf["rank"], "doc": pdf["doc"], "low": pdf["low"], "high": high, "first": first})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last = None  # last (rank, context) seen
        for pdf in batches:
            known = pdf["span"].to_numpy() >= SETTLED
            if known.any():
                done = pdf[known]
                yield rows(done, done["low"] + done["span"] - SETTLED, False)
                pdf = pdf[~known]
            rank, context = pdf["rank"].to_numpy(), pdf["context"].to_numpy()
            if not len(rank):
                continue
            again = np.zeros(len(rank), bool)
            again[1:] = (rank[1:] == rank[:-1]) & (context[1:] == context[:-1])
            again[0] = last == (rank[0], context[0])
            last = rank[-1], context[-1]
            yield rows(pdf, pdf["low"] + pdf["span"], ~again)

    return (found.repartition("rank", "context").sortWithinPartitions("rank", "context", "doc", "low")
            .mapInPandas(run, "rank long, doc long, low long, high long, first boolean"))


def settled(found: DataFrame) -> DataFrame:
    """(doc, low, high, open): repeated intervals, and open ones that are the
    earliest of their context while their rank has other contexts."""
    rows = saved(earliest(found), "suffix-earliest")
    firsts = rows.where("first").select("rank", "doc", "low", "high")
    shared = saved(firsts.groupBy("rank").agg(F.count("*").alias("n")).where("n > 1").select("rank"), "suffix-shared")
    opened = maybe_in(firsts, "rank", shared).where("_maybe").join(shared, "rank")
    return (rows.where("not first").select("doc", "low", "high", F.lit(False).alias("open"))
            .unionByName(opened.select("doc", "low", "high", F.lit(True).alias("open"))))


def with_intervals(docs: DataFrame, intervals: DataFrame, keep_rest: bool) -> DataFrame:
    """(doc_id, doc, text, spans): sorted [low, high] lists per document; documents
    without any have null spans and are left out unless ``keep_rest``."""
    lists = intervals.groupBy("doc").agg(F.array_sort(F.collect_list(F.struct("low", "high"))).alias("spans"))
    marked = maybe_in(docs.select("doc_id", "doc", "text"), "doc", intervals.select("doc").distinct())
    near = marked.where("_maybe").drop("_maybe").join(lists, "doc", "left" if keep_rest else "inner")
    if not keep_rest:
        return near
    kind = "array<struct<low:long,high:long>>"
    return near.unionByName(marked.where("not _maybe").select("doc_id", "doc", "text", F.lit(None).cast(kind).alias("spans")))


def open_parts(pdf: pd.DataFrame, length: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(bytes, doc, shift, low, high): buffers of whole pieces and the open
    intervals in them; a position plus ``shift`` is one of its document."""
    spans = [np.array([(s["low"], s["high"]) for s in x], np.int64).reshape(-1, 2) for x in pdf["spans"]]
    ids = pdf["doc"].to_numpy()
    for rows, offsets, parts in pieces([utf8(t) for t in pdf["text"]], length, 1 << 20):
        found, base = [], 0
        for k, at, part in zip(rows, offsets, parts):
            low, high = np.maximum(spans[k][:, 0], at), np.minimum(spans[k][:, 1], at + len(part) - length)
            inside = low <= high
            low, high = low[inside], high[inside]
            found.append((np.full(len(low), ids[k]), np.full(len(low), at - base), low - at + base, high - at + base))
            base += len(part)
        doc, shift, low, high = (np.concatenate(x) for x in zip(*found))
        if len(low):
            yield np.frombuffer(b"".join(parts), np.uint8), doc, shift, low, high


def anchor_of(h: Hashes, start: np.ndarray, length: int, gram: int) -> np.ndarray:
    """Anchors of ``start``, chosen as ``anchor_rows`` chooses them."""
    out = []
    for k in range(0, len(start), 4096):
        grams = start[k:k + 4096, None] + np.arange(length - gram + 1)
        out.append(start[k:k + 4096] + np.argmin(h.at(grams, grams + gram) >> np.uint64(22), axis=1))
    return np.concatenate(out)


def block_rows(open_docs: DataFrame, length: int, gram: int) -> DataFrame:
    """(rank, context, doc, low, span) of the blocks of open intervals: starts
    whose distance to the anchor has the same quotient by an eighth of
    ``length``.  The rank hashes the bytes that all starts of such a block
    have, the context all bytes of this one's; equal strings are in blocks of
    equal rank, as for anchors."""
    block = max(1, length // 8)

    def blocks(data: np.ndarray, doc: np.ndarray, shift: np.ndarray, low: np.ndarray, high: np.ndarray) -> pd.DataFrame:
        h = Hashes(data)
        anchor = anchor_of(h, low, length, gram)
        top = (anchor - low) // block
        n = top - (anchor - high) // block + 1
        of = np.repeat(np.arange(len(low)), n)
        j = top[of] - (np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n))
        core = anchor[of] - j * block  # last start of an uncut block
        a, b = np.maximum(low[of], core - block + 1), np.minimum(high[of], core)
        rank = mixed(h.at(core, core + length - block + 1) + j.astype(np.uint64))
        where = ((core - a).astype(np.uint64) << np.uint64(8)) + (b - a).astype(np.uint64)
        return pd.DataFrame({"rank": rank.view(np.int64), "context": mixed(h.at(a, b + length) + where).view(np.int64),
                             "doc": doc[of], "low": a + shift[of], "span": (b - a).astype(np.int32)})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            got = [blocks(*part) for part in open_parts(pdf, length)]
            if got:
                yield settle_locally(pd.concat(got, ignore_index=True))

    return open_docs.mapInPandas(run, "rank long, context long, doc long, low long, span int")


def start_ranks(open_docs: DataFrame, length: int) -> DataFrame:
    """(rank, next, doc, pos): rank pair of every start in open intervals."""
    half = length // 2

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for data, doc, shift, low, high in open_parts(pdf, length):
                h, size = Hashes(data), high - low + 1
                for k in range(0, len(low), 4096):
                    n = size[k:k + 4096]
                    p = np.repeat(low[k:k + 4096] - (np.cumsum(n) - n), n) + np.arange(n.sum())
                    yield pd.DataFrame({"rank": h.at(p, p + half).view(np.int64), "next": h.at(p + half, p + length).view(np.int64),
                                        "doc": np.repeat(doc[k:k + 4096], n), "pos": p + np.repeat(shift[k:k + 4096], n)})

    return open_docs.mapInPandas(run, "rank long, next long, doc long, pos long")


def later_starts(ranks: DataFrame) -> DataFrame:
    """(doc, low, high) of every start whose rank pair occurs earlier."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last = None
        for pdf in batches:
            a, b = pdf["rank"].to_numpy(), pdf["next"].to_numpy()
            if not len(a):
                continue
            again = np.zeros(len(a), bool)
            again[1:] = (a[1:] == a[:-1]) & (b[1:] == b[:-1])
            again[0] = last == (a[0], b[0])
            last = a[-1], b[-1]
            pos = pdf["pos"][again]
            yield pd.DataFrame({"doc": pdf["doc"][again], "low": pos, "high": pos})

    return (ranks.repartition("rank", "next").sortWithinPartitions("rank", "next", "doc", "pos")
            .mapInPandas(run, "doc long, low long, high long"))


def numbered(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text`` and ``doc``: a long that names the row and orders
    rows by doc_id.  It is the doc_id itself unless ids repeat or are null."""
    rows = docs.select("doc_id", "text")
    odd = rows.groupBy("doc_id").count().where("doc_id is null or count > 1").limit(1).count()
    if not odd:
        return rows.withColumn("doc", F.col("doc_id"))
    order = ["doc_id", "_h"]
    return saved(rows.withColumn("_h", F.xxhash64("text")).repartitionByRange(*order).sortWithinPartitions(*order)
                 .withColumn("doc", F.monotonically_increasing_id()).drop("_h"), "suffix-numbered")


def repeated_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(doc, low, high): starts low .. high of ``length``-byte strings that
    occur earlier; ``docs`` has doc and text."""
    found = saved(settled(anchors(docs, length, gram)), "suffix-settled")
    opened = with_intervals(docs, found.where("open").select("doc", "low", "high"), keep_rest=False)
    blocks = saved(settled(block_rows(opened, length, gram)), "suffix-blocks")
    opened = with_intervals(docs, blocks.where("open").select("doc", "low", "high"), keep_rest=False)
    done = found.where("not open").unionByName(blocks.where("not open")).select("doc", "low", "high")
    return saved(done.unionByName(later_starts(start_ranks(opened, length))), "suffix-repeats")


def cut(raw: bytes, spans, length: int) -> tuple[bytes, int, int]:
    """Bytes that stay, number removed, number of removed runs."""
    out, runs, last = [], 0, 0
    end = -1
    for s in spans:
        low, high = s["low"], s["high"] + length
        if low > end:
            out.append(raw[last:low] if low > last else b"")
            runs += 1
        end = max(end, high)
        last = end
    out.append(raw[last:])
    kept = b"".join(out)
    return kept, len(raw) - len(kept), runs


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, digest: bool = False) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept) per row of ``docs``: the
    remaining bytes, or with ``digest`` their lowercase hex SHA-256."""
    rows = numbered(docs)
    named = with_intervals(rows, repeated_spans(rows, length, gram), keep_rest=True)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            got = []
            for text, spans in zip(pdf["text"], pdf["spans"]):
                raw = utf8(text)
                kept, gone, runs = cut(raw, spans if spans is not None else [], length)
                got.append((len(raw), gone, runs, hashlib.sha256(kept).hexdigest() if digest else kept))
            out = pd.DataFrame(got, columns=["n_bytes", "n_removed", "n_spans", "kept"])
            yield out.assign(doc_id=pdf["doc_id"])[["doc_id", *out.columns]]

    kind = "string" if digest else "binary"
    return named.mapInPandas(run, f"doc_id long, n_bytes long, n_removed long, n_spans long, kept {kind}")
