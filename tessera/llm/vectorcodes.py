"""Vector codes by member-resident Lloyd rounds.

A vector becomes integers floor(1024 x), cut into ``parts`` equal pieces; each
part position has its own codebook of at most ``entries`` rows.

1. Every part is a member of the owner (position, entry, salt).  Members of an
   owner lie together as one block (ids, integer matrix) in an RDD that is
   hash-partitioned by owner; the salt splits an entry that holds most parts
   over all partitions.
2. A round: each partition adds up its resident members, the sums of the
   entries (parts x entries rows) reach the driver, and the new codebooks go
   out by broadcast.  Each owner compares its members with the whole
   codebook of their position; members that keep their entry stay where they
   are, and only the others are shuffled to their new owner.  The union of
   both keeps the partitioner, so residents never move.
3. The members are written by ``checkpoint()`` after each round: lineage is
   one round long, and a lost executor costs its own partitions.
4. After the last round the residents give each part's code and error.

All arithmetic is on integers: distances use float64 products only while no
partial result can pass 2^53, else 64-bit integers.

Edge cases: a vector that is null or holds null or non-finite components is
dropped; so is one whose length is not that of the smallest kept id.  A
length that ``parts`` does not divide is filled with zeros.  Components
beyond +-2^26 (x beyond +-65536) count as +-2^26, so that sums fit 64 bits.
Null ids come last; equal ids are ordered by their components and coded row by
row.  Fewer than ``entries`` vectors give a shorter codebook; an empty
table gives no rows.  Only the three named columns are read.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import saved
from tessera.session import ensure_checkpoint_dir

SCALE = 1024
LIMIT = 1 << 26
PARTITION_PARTS = 1 << 20
BLOCK = "owner long, ids binary, parts binary"
CODES = "rid long, vec_id long, label long, code string, error long"


def kept_vectors(df: DataFrame, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    """(rid, vec_id, label, q): integer components of the usable rows."""
    vec = F.col(vec_col)
    usable = vec.isNotNull() & F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    level = lambda x: F.floor(F.greatest(F.least(x.cast("double") * SCALE, F.lit(float(LIMIT))), F.lit(float(-LIMIT))))
    return df.where(usable).select(
        F.monotonically_increasing_id().alias("rid"), F.col(id_col).cast("long").alias("vec_id"),
        F.col(label_col).cast("long").alias("label"), F.transform(vec, lambda x: level(x).cast("int")).alias("q"))


def nearest(part: np.ndarray, book: np.ndarray, step: int = 8192) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry (ties to the lower index) and the squared
    distance to it, for each row of an integer matrix."""
    peak = max(1, int(np.abs(book).max(initial=0)), int(np.abs(part).max(initial=0)))
    kind = np.float64 if 3 * max(1, part.shape[1]) * peak * peak < 1 << 53 else np.int64
    b = book.astype(kind)
    norm = (b * b).sum(axis=1)
    index, dist = np.zeros(len(part), np.int64), np.zeros(len(part), np.int64)
    for i in range(0, len(part), step):
        x = part[i:i + step]
        index[i:i + step] = k = (norm - 2 * (x.astype(kind) @ b.T)).argmin(axis=1)
        dist[i:i + step] = ((x.astype(np.int64) - book[k]) ** 2).sum(axis=1)
    return index, dist


def rows_by(label: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(value, row numbers) for every distinct value."""
    order = np.argsort(label, kind="stable")
    cuts = np.flatnonzero(np.diff(label[order])) + 1
    for rows in np.split(order, cuts):
        if len(rows):
            yield int(label[rows[0]]), rows


class Owners:
    """The numbering of owners, and the work on their blocks in tasks."""

    def __init__(self, entries: int, salts: int, width: int):
        self.entries, self.salts, self.width = entries, salts, width

    def owner(self, position, entry, ids):
        # neighbouring ids share the low bits of their row counter: spread them
        salt = (ids ^ (ids >> 33)) % self.salts
        return (position * self.entries + entry) * self.salts + salt

    def place(self, owner: int) -> tuple[int, int]:
        return divmod(owner // self.salts, self.entries)

    def pack(self, ids: np.ndarray, part: np.ndarray) -> tuple[bytes, bytes]:
        return ids.astype("<i8").tobytes(), part.astype("<i4").tobytes()

    def unpack(self, block: tuple[bytes, bytes]) -> tuple[np.ndarray, np.ndarray]:
        ids = np.frombuffer(block[0], "<i8")
        return ids, np.frombuffer(block[1], "<i4").reshape(len(ids), self.width)

    def dealt(self, position: int, ids: np.ndarray, part: np.ndarray, entry: np.ndarray):
        """One block per owner that receives some of these members."""
        for owner, rows in rows_by(self.owner(position, entry, ids)):
            yield owner, self.pack(ids[rows], part[rows])

    def gather(self, blocks: Iterator) -> Iterator:
        """The blocks of each owner of a partition put together."""
        found = defaultdict(list)
        for owner, block in blocks:
            found[owner].append(block)
        for owner, parts in found.items():
            yield owner, (b"".join(p[0] for p in parts), b"".join(p[1] for p in parts))

    def totals(self, blocks: Iterator) -> Iterator:
        """((position, entry), (component sums, members)) of a partition."""
        sums: dict = {}
        for owner, block in blocks:
            ids, part = self.unpack(block)
            key, add = self.place(owner), part.sum(axis=0, dtype=np.int64)
            s, n = sums.get(key, (0, 0))
            sums[key] = (s + add, n + len(ids))
        yield from sums.items()

    def settle(self, books: list[np.ndarray], blocks: Iterator) -> Iterator:
        """(owner, block, moved): members of a block by their new entry."""
        for owner, block in blocks:
            position, entry = self.place(owner)
            ids, part = self.unpack(block)
            new, _ = nearest(part, books[position])
            stay = new == entry
            if stay.any():
                yield owner, (*self.pack(ids[stay], part[stay]), False)
            for to, moved in self.dealt(position, ids[~stay], part[~stay], new[~stay]):
                yield to, (*moved, True)


def _first_blocks(kept: DataFrame, owners: Owners, books, parts: int) -> DataFrame:
    """Members dealt to the owners of their first entry."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            flat = batch.column(1).flatten().to_numpy(zero_copy_only=False)
            full = np.zeros((len(ids), parts * owners.width), np.int32)
            if len(ids):
                full[:, :len(flat) // len(ids)] = flat.reshape(len(ids), -1)
            rows = [(owner, *block) for p in range(parts)
                    for part in [full[:, p * owners.width:(p + 1) * owners.width]]
                    for owner, block in owners.dealt(p, ids, part, nearest(part, books.value[p])[0])]
            cols = list(zip(*rows)) or [[], [], []]
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.binary()), pa.array(cols[2], pa.binary())],
                names=["owner", "ids", "parts"])

    return kept.select("rid", "q").mapInArrow(run, BLOCK)


def lloyd(members: RDD, owners: Owners, books: list[np.ndarray], rounds: int) -> tuple[RDD, list[np.ndarray]]:
    """Members under their entry of the last assignment but one, and the
    codebooks after ``rounds`` updates.  ``members`` is partitioned by owner."""
    sc = members.context
    for k in range(rounds):
        totals = members.mapPartitions(owners.totals).reduceByKey(lambda a, b: (a[0] + b[0], a[1] + b[1])).collect()
        books = [b.copy() for b in books]
        for (position, entry), (total, n) in totals:
            books[position][entry] = total // n
        if k == rounds - 1:
            return members, books
        sent = sc.broadcast(books)
        judged = members.mapPartitions(lambda it, sent=sent: owners.settle(sent.value, it), preservesPartitioning=True)
        judged = judged.persist(StorageLevel.DISK_ONLY)
        stay = judged.filter(lambda kv: not kv[1][2])
        # filter keeps the partitioner, so only ``moved`` goes through a shuffle
        moved = judged.filter(lambda kv: kv[1][2]).partitionBy(members.getNumPartitions())
        before, members = members, stay.union(moved).mapPartitions(
            lambda it: owners.gather((o, b[:2]) for o, b in it), preservesPartitioning=True)
        members = members.persist(StorageLevel.DISK_ONLY)
        members.checkpoint()
        members.count()
        for done in (judged, before):
            done.unpersist()
    return members, books


def compress(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
             parts: int = 4, entries: int = 256, rounds: int = 4) -> tuple[DataFrame, list[np.ndarray]]:
    """(rid, vec_id, label, code, error) of every kept vector, and the final
    codebooks, one integer matrix per part position."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    kept = saved(kept_vectors(df, id_col, vec_col, label_col), "vector-levels")
    order = [F.col("vec_id").asc_nulls_last(), F.col("q"), F.col("rid")]
    first = kept.orderBy(*order).limit(1).collect()
    if not first:
        return spark.createDataFrame([], CODES), [np.zeros((0, 0), np.int64)] * parts
    dim = len(first[0]["q"])
    kept = kept.where(F.size("q") == dim)
    width = -(-dim // parts)
    start = np.zeros((entries, parts * width), np.int64)
    seeds = [r["q"] for r in kept.orderBy(*order).limit(entries).collect()]
    start[:len(seeds), :dim] = seeds
    books = [start[:len(seeds), p * width:(p + 1) * width] for p in range(parts)]

    sc = spark.sparkContext
    n = max(1, -(-kept.count() * parts // PARTITION_PARTS), sc.defaultParallelism)
    owners = Owners(entries, -(-n // parts), width)
    blocks = _first_blocks(kept, owners, sc.broadcast(books), parts).rdd.map(lambda r: (r[0], (r[1], r[2])))
    members = blocks.partitionBy(n).mapPartitions(owners.gather, preservesPartitioning=True)
    members = members.persist(StorageLevel.DISK_ONLY)
    members, books = lloyd(members, owners, books, rounds)
    codes = saved(_codes(spark, members, owners, sc.broadcast(books), parts), "vector-codes")
    members.unpersist()
    return kept.select("rid", "vec_id", "label").join(codes, "rid").select(*[c.split()[0] for c in CODES.split(", ")]), books


def _codes(spark: SparkSession, members: RDD, owners: Owners, books, parts: int) -> DataFrame:
    """(rid, code, error): the last assignment of the resident members."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for owner, *block in zip(*(c.to_pylist() for c in batch.columns)):
                position, _ = owners.place(owner)
                ids, part = owners.unpack(block)
                code, dist = nearest(part, books.value[position])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids), pa.array(np.full(len(ids), position, np.int32)), pa.array(code.astype(np.int32)),
                     pa.array(dist)], names=["rid", "position", "entry", "dist"])

    blocks = spark.createDataFrame(members.map(lambda kv: (kv[0], *kv[1])), BLOCK, verifySchema=False)
    rows = blocks.mapInArrow(run, "rid long, position int, entry int, dist long")
    digit = lambda p: F.max(F.when(F.col("position") == p, F.lower(F.lpad(F.hex("entry"), 2, "0"))))
    return rows.groupBy("rid").agg(F.concat(*[digit(p) for p in range(parts)]).alias("code"), F.sum("dist").alias("error"))


def books_digest(books: list[np.ndarray]) -> str:
    """SHA-256 of all entries' components by part, entry and place."""
    text = ",".join(str(int(v)) for book in books for v in book.reshape(-1))
    return hashlib.sha256(text.encode()).hexdigest()


def with_label_error(codes: DataFrame) -> DataFrame:
    """``codes`` with the error summed over rows of equal label, nulls together."""
    total = codes.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))
    return codes.join(total, F.col("label").eqNullSafe(F.col("_label"))).drop("_label")
