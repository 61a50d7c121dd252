"""SimHash near-duplicates by bit-sliced comparison.

1. ``fingerprints``: Arrow batches of texts become 64-bit majority
   fingerprints (map-only, no shuffle).
2. Equal fingerprints are one vertex.  A fingerprint is cut into radius + 2
   blocks; two fingerprints within the radius agree in at least two of them,
   so every link meets in one of the C(radius + 2, 2) buckets keyed by two
   whole blocks.  Nothing is capped: a bucket above ``bucket_rows`` is dealt
   out as pairs of chunks.
3. In a bucket the fingerprints are stored as 64 vertical bit planes (one
   long integer per bit).  Shifting the planes by t compares every row with
   the t-th next at once; carry-save counters add the differing bits, and the
   shift is abandoned as soon as every pair exceeds the radius.
4. Each bucket emits a spanning forest of its links, never all pairs, and
   connected components run over those edges with written rounds.

Edge cases: null and blank texts have fingerprint zero and link like any
other; rows with a null doc_id take part in links but never name a
component (their component is the smallest other doc_id, else null);
repeated rows share one vertex; empty tables give an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import saved
from tessera.operators.graph import components

SHINGLE = 4
RADIUS = 4
SEED = 42
BLOCK_ROWS = 8192


def fingerprint(text: str | None, size: int = SHINGLE) -> int:
    """Majority bits over the XXH64 of all word shingles (with repeats)."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = list(accumulate(map(len, words), lambda a, n: a + n + 1))
    starts = [0, *(e + 1 for e in ends[:-1])]
    digest = xxhash.xxh64_digest
    if len(words) < size:
        hashes = [digest(line, SEED)]
    else:
        hashes = [digest(line[a:b], SEED) for a, b in zip(starts, ends[size - 1:])]
    count = np.zeros(64, np.int64)
    for k in range(0, len(hashes), 4096):
        part = np.frombuffer(b"".join(hashes[k:k + 4096]), np.uint8).reshape(-1, 8)
        count += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * count > len(hashes)).view(">u8")[0])


def row_keys(docs: DataFrame) -> tuple[Column, Column]:
    """Two 64-bit hashes that name a row by all its values (maps, which have
    no hash, are left out)."""
    cols = [F.col(f"`{f.name}`") for f in docs.schema.fields if "map<" not in f.dataType.simpleString()]
    null = F.concat(*[F.when(c.isNull(), "0").otherwise("1") for c in cols])  # hashes skip nulls
    return F.xxhash64(null, *cols), F.xxhash64(F.lit("second"), null, *cols)


def fingerprints(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """(doc_id, key1, key2, fp): fp is the fingerprint's bits as a signed
    long, the keys are those of ``row_keys``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            bits = np.array([fingerprint(t, size) for t in pdf["text"]], np.uint64)
            yield pdf[["doc_id", "key1", "key2"]].assign(fp=bits.view(np.int64))

    key1, key2 = row_keys(docs)
    rows = docs.select("doc_id", key1.alias("key1"), key2.alias("key2"), "text")
    return rows.mapInPandas(run, "doc_id long, key1 long, key2 long, fp long")


def block_spans(radius: int) -> list[tuple[int, int]]:
    """(shift, width) of radius + 2 blocks that cover 64 bits."""
    n = radius + 2
    edges = [64 * k // n for k in range(n + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def bucket_keys(fp: Column, radius: int) -> Column:
    """One key per pair of blocks; keys of different pairs never meet."""
    def part(span: tuple[int, int]) -> Column:
        return F.shiftrightunsigned(fp, span[0]).bitwiseAND(F.lit((1 << span[1]) - 1))

    return F.array(*[
        F.struct(F.lit(k).cast("short").alias("pair"),
                 F.shiftleft(part(a), b[1]).bitwiseOR(part(b)).alias("bits"))
        for k, (a, b) in enumerate(combinations(block_spans(radius), 2))])


def sliced_links(group: np.ndarray, fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links within the radius between rows of equal ``group``
    (sorted, complete groups)."""
    n = len(fps)
    change = np.flatnonzero(group[1:] != group[:-1]) + 1
    end = np.repeat(np.append(change, n), np.diff(np.concatenate(([0], change, [n]))))
    follow = end - np.arange(n) - 1
    bits = np.unpackbits(fps.astype(">u8").view(np.uint8).reshape(n, 8), axis=1)
    planes = [int.from_bytes(np.packbits(c, bitorder="little").tobytes(), "little")
              for c in np.ascontiguousarray(bits.T)]
    width = (radius + 8).bit_length()
    parent = np.arange(n)
    out: list[tuple[int, int]] = []

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return int(i)

    for t in range(1, int(follow.max(initial=0)) + 1):
        alive = int.from_bytes(np.packbits(follow >= t, bitorder="little").tobytes(), "little")
        counter = [0] * width
        for k in range(0, 64, 8):
            for p in planes[k:k + 8]:
                carry = (p ^ (p >> t)) & alive
                for j in range(width):  # carry-save add of one bit
                    counter[j], carry = counter[j] ^ carry, counter[j] & carry
            over, equal = 0, alive
            for j in reversed(range(width)):
                if radius >> j & 1:
                    equal &= counter[j]
                else:
                    over, equal = over | (equal & counter[j]), equal & ~counter[j]
            alive &= ~over
            if not alive:
                break
        if alive:
            lanes = np.frombuffer(alive.to_bytes((n + 7) // 8, "little"), np.uint8)
            at = np.flatnonzero(np.unpackbits(lanes, bitorder="little", count=n))
            at = at[parent[at] != parent[at + t]]
            for i in at.tolist():
                a, b = root(i), root(i + t)
                if a != b:
                    parent[max(a, b)] = min(a, b)
                    out.append((i, i + t))
            if len(at):
                while (up := parent[parent]).tobytes() != parent.tobytes():
                    parent = up
    pairs = np.array(out, np.int64).reshape(-1, 2)
    return fps[pairs[:, 0]], fps[pairs[:, 1]]


def links(distinct_fp: DataFrame, radius: int = RADIUS, bucket_rows: int = 65_536) -> DataFrame:
    """(src, dst) edges whose components equal those of all links."""
    keyed = distinct_fp.select("fp", F.explode(bucket_keys(F.col("fp"), radius)).alias("k")).select("fp", "k.*")
    hot = saved(keyed.groupBy("pair", "bits").count().where(F.col("count") > bucket_rows)
                .select("pair", "bits", F.ceil(F.col("count") / bucket_rows).cast("int").alias("chunks")), "simhash-hot")
    chunk = F.pmod(F.xxhash64("fp", F.lit("chunk")), F.col("chunks")).cast("int")
    dealt = (keyed.join(hot, ["pair", "bits"], "left")
             .withColumn("chunks", F.coalesce("chunks", F.lit(1))).withColumn("own", chunk)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
             .select("pair", "bits", "fp", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi")))
    key = ["pair", "bits", "lo", "hi"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        rows = 0

        def solve(pdf: pd.DataFrame) -> pd.DataFrame:
            same = (pdf[key].values[1:] == pdf[key].values[:-1]).all(axis=1)
            group = np.concatenate(([0], np.cumsum(~same)))
            twin = np.append(same, False) | np.insert(same, 0, False)
            group, fps = group[twin], pdf["fp"].values[twin].view(np.uint64)
            got = []
            while len(fps):  # whole groups, about BLOCK_ROWS rows at a time
                cut = np.searchsorted(group, group[min(BLOCK_ROWS, len(group)) - 1], side="right")
                a, b = sliced_links(group[:cut], fps[:cut], radius)
                got.append(pd.DataFrame({"src": a.view(np.int64), "dst": b.view(np.int64)}))
                group, fps = group[cut:], fps[cut:]
            return pd.concat(got) if got else pd.DataFrame({"src": [], "dst": []}, dtype="int64")

        for pdf in batches:
            held.append(pdf)
            rows += len(pdf)
            if rows < 4 * BLOCK_ROWS:
                continue
            pdf = pd.concat(held, ignore_index=True)
            last = (pdf[key] == pdf[key].iloc[-1]).all(axis=1).values
            first = int(np.argmax(last))  # rows are sorted: the open group is the tail
            if first:
                yield solve(pdf.iloc[:first])
            held = [pdf.iloc[first:]]
            rows = len(held[0]) if first else 0  # a growing group is joined up again after as many rows
        if held:
            yield solve(pd.concat(held, ignore_index=True))

    return (dealt.repartition(*key).sortWithinPartitions(*key, "fp")
            .mapInPandas(run, "src long, dst long").distinct())


def classes(docs: DataFrame, radius: int = RADIUS, size: int = SHINGLE) -> DataFrame:
    """(doc_id, key1, key2, fp, root, component_id) for every row of ``docs``;
    ``root``, a fingerprint, names the component also where doc_ids repeat."""
    rows = saved(fingerprints(docs, size), "simhash-fp")
    first = saved(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-first")
    edges = saved(links(first.select("fp"), radius), "simhash-links")
    ends = edges.select(F.col("src").alias("id")).union(edges.select("dst")).distinct()
    label = components(saved(ends, "simhash-ends"), edges).withColumnRenamed("id", "fp")
    linked = first.join(label, "fp")
    name = linked.join(linked.groupBy("comp").agg(F.min("first").alias("component_id")), "comp")
    named = first.join(name.select("fp", "comp", "component_id"), "fp", "left").select(
        "fp", F.coalesce("comp", "fp").alias("root"), F.coalesce("component_id", "first").alias("component_id"))
    # written: a join of two plain tables is one that Spark splits where a fingerprint is hot
    named = saved(named, "simhash-named")
    return rows.join(named, "fp").select("doc_id", "key1", "key2", "fp", "root", "component_id")


def near_duplicates(docs: DataFrame, radius: int = RADIUS, size: int = SHINGLE) -> DataFrame:
    """(doc_id, fp, component_id) for every row of ``docs``."""
    return classes(docs, radius, size).select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, radius: int = RADIUS, size: int = SHINGLE) -> DataFrame:
    """One row of ``docs`` per component: that of the smallest (doc_id, nulls
    last, fingerprint, row key).  Rows are told apart by all their values, so
    repeated or null doc_ids neither lose a document nor keep a copy; of rows
    equal in every value one stays."""
    found = saved(classes(docs, radius, size), "simhash-classes")
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "fp", "key1", "key2")
    stay = found.groupBy("root").agg(F.min(place).alias("best")).select("best.key1", "best.key2")
    twins = found.groupBy("key1", "key2").agg(F.count("*").alias("rows"))
    free = lambda c: c if c not in docs.columns else free(f"_{c}")
    k1, k2, n = free("_key1"), free("_key2"), free("_rows")
    stay = saved(stay.join(twins, ["key1", "key2"]).toDF(k1, k2, n), "simhash-stay")
    key1, key2 = row_keys(docs)
    kept = docs.withColumns({k1: key1, k2: key2}).join(stay, [k1, k2])
    own = [F.col(f"`{c}`") for c in docs.columns]
    return kept.where(F.col(n) == 1).select(*own).unionByName(
        kept.where(F.col(n) > 1).dropDuplicates([k1, k2]).select(*own))


def hex_of(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
