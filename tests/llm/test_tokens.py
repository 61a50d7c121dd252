import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tessera.llm import tokens

PATH = public_tokenizers.path("word_bpe_49k.json")


def ids_of(text):
    return Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("text", [
    "Hello, World. it's 3.14 ok...", "a.,b ,. x., y", "  lead\n\n\ttab\x0bvt\x85nel  x　y", "<|endoftext|> <|ENDOFTEXT|>. a<|startoftext|>b,",
    "I'LL we're CAN'T. O'Neil's, 'S", "É́é ÀB. ΣΑΣ. İI ǅ, ß. ſ.", "12,5. 7. a1. 1a, x2,y3. ́. á.", "日本語。テスト, 한국어.", "",
    "A.B.C. ... ., ,. .", "ÀÉÎ été. été, ÉTÉ ñandú, Straße, ŒUVRE œuvre. ij ĳ ŉ ǅ ﬁn. Å. e\u0301. e\u0301, ½. x². ²,", "wor‍d. zwj﻿. \x00 nul. \x1f. a\x1cb"])
def test_pieces_equal_whole_text(text):
    cache = tokens.PieceIds(open(PATH, encoding="utf-8").read(), words=2)
    ids, n = cache.encode_column(pa.array([text, None, text]))
    assert ids.tolist() == ids_of(text) * 2 and n.tolist() == [len(ids_of(text)), 0, len(ids_of(text))]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_any_tokenizer_file(spark, tmp_path, name):
    """A file with another word splitting is encoded in whole texts."""
    path = public_tokenizers.path(name)
    own = Tokenizer.from_file(path)
    texts = ["Hello World, this is a test.", " two  blanks\n\nnew line ", "it's 12.5 <|endoftext|> é 日本", "", None]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    spec = open(path, encoding="utf-8").read()
    assert tokens.splits_at_blanks(spec) == (name == "word_bpe_49k.json")
    tokens.write(docs, f"file://{tmp_path}/ids", spec)
    got = {r["doc_id"]: list(r["ids"]) for r in tokens.read(spark, f"file://{tmp_path}/ids").collect()}
    assert got == {k: [*own.encode(t or "", add_special_tokens=False).ids, 1] for k, t in enumerate(texts)}


def test_parts_cover_the_batch(monkeypatch):
    monkeypatch.setattr(tokens, "PART_BYTES", 10)
    texts = ["x" * 25, None, "abc", "", "de", "f" * 7, "g" * 10, "h", None]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["doc_id", "text"])
    parts = [p.column(1).to_pylist() for p in tokens.parts_of(batch, 1)]
    assert [t for p in parts for t in p] == texts and all(len(p) == 1 or sum(len(t or "") for t in p) <= 10 for p in parts)


def test_row_groups_and_page_index(spark, tmp_path, monkeypatch):
    import glob

    import pyarrow.parquet as pq

    monkeypatch.setitem(tokens.WRITE_OPTIONS, "parquet.block.size", str(64 << 10))
    docs = spark.range(4000).selectExpr("id AS doc_id", "repeat(concat('word', id, ' some text '), 10) AS text").coalesce(1)
    tokens.write(docs, f"file://{tmp_path}/ids", open(PATH, encoding="utf-8").read())
    files = [pq.ParquetFile(f).metadata for f in glob.glob(f"{tmp_path}/ids/*.parquet")]
    assert max(f.num_row_groups for f in files) > 1
    for f in files:
        for g in range(f.num_row_groups):
            for c in range(f.num_columns):
                col = f.row_group(g).column(c)
                assert col.has_offset_index
                assert {"RLE_DICTIONARY", "DELTA_BINARY_PACKED"} & set(col.encodings)


def test_equal_ids_stand_in_text_order(spark, tmp_path):
    docs = spark.createDataFrame([(1, "b b b"), (1, "a"), (1, None), (0, "c c")], "doc_id long, text string").repartition(3)
    tokens.write(docs, f"file://{tmp_path}/ids", open(PATH, encoding="utf-8").read())
    got = sorted((r["start"], r["n_tokens"]) for r in tokens.read(spark, f"file://{tmp_path}/ids").collect())
    assert got == [(0, 3), (3, 1), (4, 2), (6, 4)]


def test_files_round_trip(spark, tmp_path):
    rows = [(5, "five tokens, here.", "a"), (1, None, "b"), (3, "", "c"), (None, "no id", "d"), (3, "", "c"), (9, "long " * 30_000, "e"), (2, "x", "f")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, start string")
    path = f"file://{tmp_path}/ids"
    tokens.write(docs, path, open(PATH, encoding="utf-8").read())
    key = lambda r: (r[0] is not None, r[0] or 0)
    want, at = [], 0
    for doc_id, text, _ in sorted(rows, key=key):
        ids = [*ids_of(text), 1]
        want.append((doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert sorted(map(tuple, tokens.checksums(spark, path).collect()), key=lambda r: r[1]) == want
    back = {r["start"]: list(r["ids"]) for r in tokens.read(spark, path).collect()}
    assert {k: len(v) for k, v in back.items()} == {w[1]: w[2] for w in want}
    assert zlib.crc32(np.array(back[want[-1][1]], "<u4").tobytes()) == want[-1][3]
    empty = f"file://{tmp_path}/none"
    tokens.write(docs.limit(0), empty, open(PATH, encoding="utf-8").read())
    assert tokens.checksums(spark, empty).count() == 0


def test_query_against_brute_force(spark):
    from tessera.llm.queries import QUERIES
    sf = "/root/testdata/sf0.001"
    docs = sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect())
    whole = Tokenizer.from_file(PATH).encode_batch([t or "" for _, t in docs], add_special_tokens=False)
    want, at = [], 0
    for (doc_id, _), e in zip(docs, whole):
        ids = [*e.ids, 1]
        want.append((doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert sorted(map(tuple, QUERIES["op10_token_ids"](spark, sf).collect())) == want
