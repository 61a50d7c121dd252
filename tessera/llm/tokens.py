"""Token-id output: Parquet files of id lists with exact document starts.

Documents are range-partitioned and sorted by doc_id, tokenised in Arrow
batches, and written with small pages inside controlled row groups, so that
the page index lets a reader take a few documents or only the metadata
columns.  Ids are dictionary-encoded; where a dictionary grows too large the
version-2 writer falls back to delta encoding.  Every file row carries its
``shard`` and ``pos``, so starts come from one small table of shard totals.

Tokenising: with the normaliser and word splitting of ``SPLITS_AT_BLANKS``,
white space never joins two tokens.  A text is then cut at blanks and line feeds,
the distinct pieces of a part of a batch are encoded once (and kept in a cache
of bounded size), and the ids are gathered by piece number.  Texts of any other
tokenizer file are encoded whole.

Edge cases: null and empty texts give only the end id; a null doc_id sorts
first; rows of equal doc_id stand in the order of their texts; repeated rows are
separate documents; an empty table writes an empty file set that reads back as
no rows.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tessera.session import scratch_dir

END_ID = 1
CACHE_WORDS = 700_000
PART_BYTES = 16 << 20  # text of one part; a longer text is a part of its own
# The normaliser and word splitting that PieceIds is written for.
SPLITS_AT_BLANKS = {
    "normalizer": {"type": "Sequence", "normalizers": [
        {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
         "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]},
}
WRITE_OPTIONS = {
    "parquet.block.size": str(32 << 20),
    "parquet.page.size": str(256 << 10),
    "parquet.page.row.count.limit": "1000",
    "parquet.enable.dictionary": "true",
    "parquet.writer.version": "PARQUET_2_0",
}


def byte_characters() -> dict[int, str]:
    """latin-1 code point of a byte -> the character that stands for it in a
    byte-level vocabulary: printable bytes for themselves, the others for
    the characters from 256 on, in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(256 + k) for k, b in enumerate(rest)}


class PieceIds:
    """Ids of pieces between blanks as little-endian unsigned 32-bit bytes.
    Words, pieces without a closing mark, are cached; the cache is cleared when it
    reaches its size."""

    def __init__(self, tokenizer_json: str, words: int = CACHE_WORDS):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.max_words = Tokenizer.from_str(tokenizer_json), words
        self.model, self.words = self.tokenizer.model, {"": b""}
        self.id_bytes = [k.to_bytes(4, "little") for k in range(self.tokenizer.get_vocab_size())]
        self.shown = byte_characters()

    def word_ids(self, word: str) -> bytes:
        got = self.words.get(word)
        if got is None:
            if len(self.words) >= self.max_words:
                self.words = {"": b""}
            got = self.words[word] = self.lookup(word)
        return got

    def piece_ids(self, piece: str) -> bytes:
        # a "<" may belong to a special token, which is matched before lower-casing
        if "<" in piece:
            return self.word_ids(piece)
        word = piece.lower() if piece.isascii() else piece
        if word[-1:] in (".", ",") and word[-2:-1].isalnum():
            # a mark after a letter or digit is a token group of its own
            return self.word_ids(word[:-1]) + self.word_ids(word[-1])
        return self.word_ids(word)

    def lookup(self, word: str) -> bytes:
        """Ids of a word: lower-case Latin letters are one token group that
        needs no normalising, so they go straight to the model."""
        if word.isalpha() and (word.isascii() or max(word) < "\u0250" and word == word.lower()):
            shown = word if word.isascii() else word.encode().decode("latin-1").translate(self.shown)
            return b"".join([self.id_bytes[t.id] for t in self.model.tokenize(shown)])
        return np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, "<u4").tobytes()

    def encode_column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, number of ids per text)."""
        lists = pc.split_pattern(pc.replace_substring(pc.fill_null(texts, ""), "\n", " "), " ")
        pieces = lists.flatten().dictionary_encode()
        coded = [self.piece_ids(p) for p in pieces.dictionary.to_pylist()]
        pool = np.frombuffer(b"".join(coded), "<i4")
        size = np.array([len(c) for c in coded], np.int64) // 4
        first = np.cumsum(size) - size
        at = pieces.indices.to_numpy(zero_copy_only=False)
        n = size[at]
        end = np.cumsum(n)
        ids = pool[np.repeat(first[at] - (end - n), n) + np.arange(int(n.sum()))]
        last = np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))
        return ids, np.diff(np.concatenate(([0], np.concatenate(([0], end))[last])))


class WholeTexts:
    """Encodes whole texts with any tokenizer file."""

    def __init__(self, tokenizer_json: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)

    def encode_column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        found = [e.ids for e in self.tokenizer.encode_batch([t or "" for t in texts.to_pylist()], add_special_tokens=False)]
        return np.array([i for ids in found for i in ids], "<i4"), np.array([len(ids) for ids in found], np.int64)


def splits_at_blanks(tokenizer_json: str) -> bool:
    """Whether pieces between blanks may be encoded one by one."""
    spec = json.loads(tokenizer_json)
    return (all(spec[k] == v for k, v in SPLITS_AT_BLANKS.items())
            and all("<" in t["content"] and " " not in t["content"] for t in spec["added_tokens"]))


_caches: dict[str, PieceIds | WholeTexts] = {}


def cache_for(tokenizer_json: str) -> PieceIds | WholeTexts:
    """The worker's encoder; workers are reused, so later tasks start warm."""
    if tokenizer_json not in _caches:
        _caches.clear()
        _caches[tokenizer_json] = (PieceIds if splits_at_blanks(tokenizer_json) else WholeTexts)(tokenizer_json)
    return _caches[tokenizer_json]


def parts_of(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``PART_BYTES`` of text each."""
    size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
    k = 0
    while k < batch.num_rows:
        done = size[k - 1] if k else 0
        to = max(k + 1, int(np.searchsorted(size, done + PART_BYTES, side="right")))
        yield batch.slice(k, to - k)
        k = to


def encode(docs: DataFrame, tokenizer_json: str, end_id: int = END_ID) -> DataFrame:
    """(shard, pos, doc_id, n_tokens, ids) in ascending doc_id order."""
    schema = T.StructType([
        T.StructField("shard", T.IntegerType()), T.StructField("pos", T.LongType()),
        T.StructField("doc_id", T.LongType()), T.StructField("n_tokens", T.LongType()),
        T.StructField("ids", T.ArrayType(T.IntegerType(), False))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = cache_for(tokenizer_json)
        shard, pos = TaskContext.get().partitionId(), 0
        for batch in batches:
            for part in parts_of(batch, 1):
                ids, n = cache.encode_column(part.column(1))
                flat = pa.array(np.insert(ids, np.cumsum(n), np.int32(end_id)), pa.int32())
                n = n + 1
                offsets = pa.array(np.concatenate(([0], np.cumsum(n))).astype(np.int32))
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(n), shard, np.int32)), pa.array(np.arange(pos, pos + len(n))),
                    part.column(0), pa.array(n), pa.ListArray.from_arrays(offsets, flat)],
                    names=["shard", "pos", "doc_id", "n_tokens", "ids"])
                pos += len(n)

    ordered = docs.select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return ordered.mapInArrow(run, schema)


def write(docs: DataFrame, path: str, tokenizer_json: str, end_id: int = END_ID) -> None:
    encode(docs, tokenizer_json, end_id).write.options(**WRITE_OPTIONS).mode("overwrite").parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids): starts count all ids before the row."""
    rows = spark.read.parquet(path)
    return starts(rows.drop("ids"), rows).join(rows.select("shard", "pos", "ids"), ["shard", "pos"]).select(
        "doc_id", "start", "n_tokens", "ids")


def starts(rows: DataFrame, lengths: DataFrame) -> DataFrame:
    """Adds ``start`` to rows of (shard, pos, n_tokens, ...); the shard totals
    are read from the metadata columns of ``lengths``."""
    totals = lengths.groupBy("shard").agg(F.sum("n_tokens").alias("_t"))  # one row per file
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    base = totals.select("shard", F.coalesce(F.sum("_t").over(before), F.lit(0)).alias("_base"))
    inside = Window.partitionBy("shard").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    return (rows.withColumn("_in", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
            .join(base, "shard").withColumn("start", F.col("_base") + F.col("_in")).drop("_base", "_in"))


def checksums(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) from the files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("ids")
            at = lists.offsets.to_numpy()
            flat = np.ascontiguousarray(lists.values.to_numpy(zero_copy_only=False), "<i4")
            crc = [zlib.crc32(flat[a:b]) for a, b in zip(at[:-1], at[1:])]
            yield pa.RecordBatch.from_arrays([
                batch.column("shard"), batch.column("pos"), batch.column("doc_id"),
                pa.array(np.diff(at).astype(np.int64)), pa.array(crc, pa.int64())],
                names=["shard", "pos", "doc_id", "n_tokens", "ids_crc32"])

    rows = spark.read.parquet(path)
    found = rows.select("shard", "pos", "doc_id", "ids").mapInArrow(
        run, "shard int, pos long, doc_id long, n_tokens long, ids_crc32 long")
    return starts(found, rows).select("doc_id", "start", "n_tokens", "ids_crc32")


def tokenise_and_check(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID) -> DataFrame:
    """Write ``docs`` under the shared folder and digest the files."""
    with open(tokenizer_path, encoding="utf-8") as f:  # sent with the tasks: executors need no copy of the file
        spec = f.read()
    path = scratch_dir(docs.sparkSession, "llm-token-ids")
    write(docs, path, spec, end_id)
    return checksums(docs.sparkSession, path)
