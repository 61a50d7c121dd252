"""Benchmark decontamination by a broadcast set of test n-grams.

Benchmark items are cut into windows of ``size`` words (a shorter item is one
window).  Their words get small integer ids, their windows a 64-bit rolling
hash.  Each Arrow batch of documents is turned into one id array (0 for words
outside the benchmark); only windows without a 0 are hashed, looked up, and
every hit is verified id by id.  The scan is map-only.

The broadcast holds the windows of at most about ``block_bytes`` of benchmark text
(some four times these bytes): a larger benchmark is dealt into blocks by hash,
each block scans all documents and is released before the next one is built, and
the spans of a document are united.

Edge cases: null or wordless texts have no words and no hits; items without
words have no window; equal items all count; a null item_id marks words but
is not listed; an empty benchmark or corpus gives rows without hits.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import saved

WINDOW = 10
BLOCK_BYTES = 8 << 20  # benchmark text of one block
PART_CHARS = 1 << 20   # document text whose words a task holds at a time
# bytes -> bytes: A-Z lower-cased, every other ASCII byte outside a-z 0-9 a
# blank; bytes of non-ASCII characters are word bytes
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32
               for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_TABLE).split()


class Windows:
    """Window set of one benchmark block, as arrays: the items' words one after
    the other as ids and, per window length, the distinct windows by hash with
    their place in the words and their items.  About 20 bytes a word."""

    def __init__(self, items: list[tuple[str | None, str | None]], size: int):
        self.vocab: dict[bytes, int] = {}
        self.items = [item for item, _ in items]
        coded = [np.array([self.vocab.setdefault(w, len(self.vocab) + 1) for w in words_of(text)], np.int32) for _, text in items]
        self.tokens = np.concatenate([*coded, np.zeros(0, np.int32)])
        rng = np.random.default_rng(7)
        self.mult = rng.integers(0, 2**63, size, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        length = np.array([len(c) for c in coded], np.int64)
        first = np.cumsum(length) - length
        width = np.minimum(length, size)
        self.by_len = []
        for n in np.unique(width[width > 0]).tolist():
            own = np.flatnonzero(width == n)
            windows = length[own] - n + 1
            item = np.repeat(own, windows)
            start = np.repeat(first[own] - (np.cumsum(windows) - windows), windows) + np.arange(int(windows.sum()))
            self.by_len.append((n, *self._distinct(n, start, item)))

    def hash_at(self, ids: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
        """Rolling hash of the ``n`` ids from each place; column by column, so
        that no matrix of all windows is made."""
        h = np.zeros(len(at), np.uint64)
        for j in range(n):
            h += ids[at + j].astype(np.uint64) * self.mult[j]
        return h

    def _distinct(self, n: int, start: np.ndarray, item: np.ndarray):
        """(hashes, places, owner offsets, owners) of distinct windows."""
        h = self.hash_at(self.tokens, start, n)
        order = np.argsort(h, kind="stable")

        def equal(order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            a, b = start[order[:-1]], start[order[1:]]
            hashes = h[order[:-1]] == h[order[1:]]
            same = hashes.copy()
            for j in range(n):
                same &= self.tokens[a + j] == self.tokens[b + j]
            return hashes, same

        hashes, same = equal(order)
        if (hashes & ~same).any():  # different windows of one hash: order them by their words too
            order = np.lexsort([*(self.tokens[start + j] for j in reversed(range(n))), h])
            hashes, same = equal(order)
        group = np.concatenate(([0], np.cumsum(~same))) if len(order) else np.zeros(0, np.int64)
        rep = order[np.concatenate(([0], np.flatnonzero(~same) + 1))] if len(order) else order
        pairs = np.unique(group * len(self.items) + item[order])  # an item counts once per window
        offsets = np.searchsorted(pairs // max(1, len(self.items)), np.arange(len(rep) + 1))
        return h[rep], start[rep].astype(np.int64), offsets, (pairs % max(1, len(self.items))).astype(np.int32)

    def scan(self, ids: np.ndarray) -> Iterator[tuple[int, int, list]]:
        """(start, length, items) of every verified window occurrence."""
        zeros = np.concatenate(([0], np.cumsum(ids == 0)))
        for n, hashes, places, offsets, owners in self.by_len:
            if len(ids) < n:
                continue
            at = np.flatnonzero(zeros[n:] == zeros[:-n])
            if not len(at):
                continue
            h = self.hash_at(ids, at, n)
            k = np.searchsorted(hashes, h)
            seen = k < len(hashes)
            seen[seen] = hashes[k[seen]] == h[seen]
            for i, first in zip(at[seen].tolist(), k[seen].tolist()):
                for m in range(first, len(hashes)):  # windows of one hash stand together
                    if hashes[m] != hashes[first]:
                        break
                    if (ids[i:i + n] == self.tokens[places[m]:places[m] + n]).all():
                        yield i, n, [self.items[x] for x in owners[offsets[m]:offsets[m + 1]]]


def _scan_batch(texts: list[str | None], win: Windows) -> tuple[list[int], list[list], list[list]]:
    """Per text: number of words, merged word spans [first, last], item ids.
    Only the words of about ``PART_CHARS`` of text are held at a time."""
    out: tuple[list[int], list[list], list[list]] = ([], [], [])
    part, size = [], 0
    for k, text in enumerate(texts):
        part.append(text)
        size += len(text or "")
        if size >= PART_CHARS or k + 1 == len(texts):
            for done, new in zip(out, _scan_part(part, win)):
                done.extend(new)
            part, size = [], 0
    return out


def _scan_part(texts: list[str | None], win: Windows) -> tuple[list[int], list[list], list[list]]:
    get = win.vocab.get
    words = [words_of(t) for t in texts]
    counts = list(map(len, words))
    # a 0 between documents keeps windows inside one document
    ids = np.array([get(w, 0) for doc in words for w in (*doc, b" ")], np.int64)
    starts = np.concatenate(([0], np.cumsum(np.array(counts, np.int64) + 1)))
    spans: list[list] = [[] for _ in texts]
    items: list[set] = [set() for _ in texts]
    for i, n, owners in win.scan(ids):
        d = int(np.searchsorted(starts, i, side="right")) - 1
        spans[d].append((i - int(starts[d]), i - int(starts[d]) + n - 1))
        items[d].update(owners)
    return counts, [merged(s) for s in spans], [sorted(x for x in s if x is not None) for s in items]


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1] + 1:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [tuple(x) for x in out]


def n_blocks(bench: DataFrame, block_bytes: int) -> int:
    text = F.coalesce(F.col("text"), F.lit(""))
    total = bench.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0)).alias("n")).first()["n"]
    return max(1, -(-int(total) // block_bytes))


def blocks(bench: DataFrame, size: int, n: int) -> Iterator[Windows]:
    """The benchmark in ``n`` parts, each collected alone."""
    part = F.pmod(F.xxhash64("item_id", F.coalesce(F.col("text"), F.lit(""))), F.lit(n))
    for k in range(n):
        rows = bench.select(F.col("item_id").cast("string").alias("item_id"), "text").where(part == k)
        yield Windows([(r["item_id"], r["text"]) for r in rows.toLocalIterator()], size)


def in_turn(bench: DataFrame, size: int, block_bytes: int, scan) -> list[DataFrame]:
    """``scan(broadcast, last result)`` for every block.  Of several blocks each is
    written and its broadcast released before the next one is built."""
    n = n_blocks(bench, block_bytes)
    out: list[DataFrame] = []
    for win in blocks(bench, size, n):
        sent = bench.sparkSession.sparkContext.broadcast(win)
        got = scan(sent, out[-1] if out else None)
        if n > 1:
            got = saved(got, "decontam-block")
            sent.destroy()
        out.append(got)
    return out


def find_hits(docs: DataFrame, bench: DataFrame, size: int = WINDOW,
              block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, n_words, spans, items) for every row of ``docs``; spans are
    disjoint [first, last] word positions, items sorted item ids."""
    schema = "rid long, doc_id long, n_words long, spans array<struct<a:long,b:long>>, items array<string>"
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), "doc_id", "text")

    def scan(sent, _):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                n, spans, items = _scan_batch(pdf["text"].tolist(), sent.value)
                yield pd.DataFrame({"rid": pdf["rid"], "doc_id": pdf["doc_id"], "n_words": n,
                                    "spans": [[{"a": a, "b": b} for a, b in s] for s in spans], "items": items})

        return rows.mapInPandas(run, schema)

    parts = in_turn(bench, size, block_bytes, scan)
    if len(parts) == 1:
        return parts[0].drop("rid")
    both = reduce(DataFrame.unionByName, parts).groupBy("rid", "doc_id").agg(
        F.max("n_words").alias("n_words"),
        F.array_sort(F.flatten(F.collect_list("spans"))).alias("s"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    joined = F.aggregate(
        "s", F.array().cast("array<struct<a:long,b:long>>"),
        lambda acc, x: F.when(
            (F.size(acc) > 0) & (x["a"] <= F.element_at(acc, -1)["b"] + 1),
            F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(
                F.element_at(acc, -1)["a"].alias("a"),
                F.greatest(F.element_at(acc, -1)["b"], x["b"]).alias("b")))))
        .otherwise(F.concat(acc, F.array(x))))
    return both.select("doc_id", "n_words", joined.alias("spans"), "items")


def cut_spans(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the words of ``spans`` and what stands between them."""
    raw = text.encode("utf-8", "surrogatepass")
    flat = raw.translate(_TABLE)
    at, ends, pos = [], [], 0
    for w in flat.split():
        pos = flat.index(w, pos)
        at.append(pos)
        pos += len(w)
        ends.append(pos)
    out, last = [], 0
    for a, b in spans:
        out.append(raw[last:at[a]])
        last = ends[b]
    return b"".join([*out, raw[last:]]).decode("utf-8", "surrogatepass")


def decontaminate(docs: DataFrame, bench: DataFrame, mode: str = "drop", size: int = WINDOW,
                  block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` without contaminated rows (``drop``) or with the hit spans cut
    from their text (``cut``); all columns pass through.  A benchmark of
    several blocks is applied block after block; for ``cut`` every block sees
    the input text, and the united spans are cut once at the end."""
    if mode not in ("drop", "cut"):
        raise ValueError(mode)
    names = docs.columns
    at = names.index("text")
    span = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))

    def drop(sent):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                _, spans, _ = _scan_batch(batch.column(at).to_pylist(), sent.value)
                yield batch.filter(pa.array([not s for s in spans], pa.bool_()))

        return run

    def mark(sent):  # the last column holds the spans of the blocks so far
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                _, spans, _ = _scan_batch(batch.column(at).to_pylist(), sent.value)
                every = [[*old, *({"a": a, "b": b} for a, b in s)] for old, s in zip(batch.column(len(names)).to_pylist(), spans)]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:-1], pa.array(every, span)], names=batch.schema.names)

        return run

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).to_pylist()
            spans = [merged([(s["a"], s["b"]) for s in row]) for row in batch.column(len(names)).to_pylist()]
            new = pa.array([cut_spans(t, s) if s else t for t, s in zip(texts, spans)], batch.schema.field(at).type)
            yield pa.RecordBatch.from_arrays([new if k == at else batch.column(k) for k in range(len(names))], names=names)

    if mode == "drop":
        return in_turn(bench, size, block_bytes,
                       lambda sent, last: (docs if last is None else last).mapInArrow(drop(sent), docs.schema))[-1]
    extra = "_spans" + "_" * max(map(len, names))  # no input column has this name
    out = docs.withColumn(extra, F.array().cast("array<struct<a:long,b:long>>"))
    schema = out.schema
    marked = in_turn(bench, size, block_bytes, lambda sent, last: (out if last is None else last).mapInArrow(mark(sent), schema))[-1]
    return marked.mapInArrow(cut, docs.schema)
