"""WARC archives written and read by Spark, with boundary-chain verification.

Writing is a DataFrame job: a payload's digest decides, by one aggregate per
digest, which page holds the response and which pages revisit it; each record
is one row of the text writer, whose line separator is the record's closing
blank line.  Spark's commit protocol makes the files appear whole or not.

Reading cuts the files into byte ranges.  A task lists every place where the
version line stands (also inside payloads) with the offset its
Content-Length leads to, and follows these links inside its range.  What is
left per candidate is one link out of the range; pointer jumping from offset
0 doubles the known chain every round, until each range knows the one offset
at which the chain enters it.  A second pass walks only the chain, so magic
bytes inside payloads are never taken for records.

Edge cases: null html is an empty payload; a null page_id is smaller than any
number and is written without a page header; rows that repeat the largest
page_id of a payload are all responses; line breaks in urls become blanks;
an empty table writes no records and reads back as no rows.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import saved

MAGIC = b"WARC/1.1\r\n"
END = b"\r\n\r\n"
DATE = "1970-01-01T00:00:00Z"
RANGES_PER_TASK = 4
# Fixed value: the base32 alphabet.
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_of_sha1(hex40: Column) -> Column:
    """Five hex digits are four base32 digits; 40 give 32."""
    out = []
    for k in range(8):
        v = F.conv(F.substring(hex40, 5 * k + 1, 5), 16, 10).cast("int")
        out += [F.substring(F.lit(BASE32), F.shiftright(v, s).bitwiseAND(31) + 1, F.lit(1)) for s in (15, 10, 5, 0)]
    return F.concat(*out)


def records(pages: DataFrame, min_bytes: int = 0, date: str = DATE) -> DataFrame:
    """One ``value`` per page: the record without its closing blank line."""
    html = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select("page_id", "url", html.alias("html"), F.sha1(F.encode(html, "UTF-8")).alias("sha1"),
                        F.octet_length(html).cast("long").alias("bytes"))
    # written first: the planner then knows the size of the table of repeated payloads
    same = saved(rows.where(F.col("bytes") >= min_bytes).groupBy("sha1", "bytes")
                 .agg(F.count("*").alias("n"), F.max("page_id").alias("keeper")).where("n > 1").drop("n"), "warc-same")
    rows = rows.join(same, ["sha1", "bytes"], "left")
    revisit = F.col("keeper").isNotNull() & ~F.coalesce(F.col("page_id") == F.col("keeper"), F.lit(False))
    field = lambda name, value: F.coalesce(F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit("\r\n")), F.lit(""))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.col("bytes").cast("string"), F.lit("\r\n\r\n"))
    block = F.when(revisit, F.lit("HTTP/1.1 200 OK\r\n\r\n")).otherwise(F.concat(http, "html"))
    rows = rows.select("page_id", "url", "sha1", "bytes", "keeper", revisit.alias("revisit"), block.alias("block"))
    head = F.concat(
        F.lit(MAGIC.decode()), F.lit("WARC-Type: "), F.when(F.col("revisit"), "revisit").otherwise("response"), F.lit("\r\n"),
        F.lit("WARC-Record-ID: <urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("none")), F.lit(">\r\n"),
        field("WARC-Target-URI", F.regexp_replace("url", r"[\r\n]", " ")),
        F.lit(f"WARC-Date: {date}\r\n"),
        F.lit("WARC-Payload-Digest: sha1:"), base32_of_sha1(F.col("sha1")), F.lit("\r\n"),
        F.when(F.col("revisit"), F.concat(
            F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\n"),
            F.lit("WARC-Refers-To: <urn:page:"), F.col("keeper").cast("string"), F.lit(">\r\n"))).otherwise(F.lit("")),
        field("X-Page-Id", F.col("page_id")), field("X-Payload-Length", F.col("bytes")),
        F.lit("Content-Type: application/http; msgtype=response\r\n"),
        F.lit("Content-Length: "), F.octet_length("block").cast("string"), F.lit(END.decode()))
    return rows.select(F.concat(head, "block").alias("value"))


def write(pages: DataFrame, path: str, min_bytes: int = 0) -> None:
    records(pages, min_bytes).write.option("lineSep", END.decode()).mode("overwrite").text(path)


def opened(path: str):
    """A seekable file of any file system Arrow knows."""
    from pyarrow import fs

    uri = re.sub(r"^file:/+", "file:///", path)
    system, name = fs.FileSystem.from_uri(uri)
    return system.open_input_file(name)


def read_head(f, at: int, size: int) -> tuple[bytes, int] | None:
    """Header bytes at ``at`` and the offset behind them, None if unended."""
    got, step = b"", 4096
    while (end := got.find(END)) < 0:
        if at + len(got) >= size:
            return None
        f.seek(at + len(got))
        got, step = got + f.read(step), step * 2
    return got[:end + 2], at + end + len(END)


def field_of(head: bytes, name: str) -> str | None:
    m = re.search(rb"(?im)^" + name.encode() + rb":[ \t]*(.*?)\r$", head)
    return m[1].decode("utf-8", "surrogatepass") if m else None


def ranges(spark: SparkSession, path: str, split_bytes: int) -> DataFrame:
    """(path, size, range) of every byte range of the archive's files."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
             .select("path", F.col("length").alias("size")).where("size > 0"))
    last = F.floor((F.col("size") - 1) / split_bytes).cast("long")
    return files.withColumn("last", last).select(
        "path", "size", "last", F.explode(F.sequence(F.lit(0).cast("long"), "last")).alias("range"))


def candidates(parts: DataFrame, split_bytes: int) -> DataFrame:
    """(path, range, offset, leaves): every place of the version line whose
    links stay inside the file, and where they leave its range."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for path, size, part in zip(pdf["path"], pdf["size"], pdf["range"]):
                low, high = part * split_bytes, min((part + 1) * split_bytes, size)
                link: dict[int, int] = {}
                with opened(path) as f:
                    f.seek(low)
                    data = f.read(min(high + len(MAGIC) - 1, size) - low)
                    at = data.find(MAGIC)
                    while at >= 0:
                        if (got := read_head(f, low + at, size)) and (n := field_of(got[0], "Content-Length")) and n.isdigit():
                            after = got[1] + int(n) + len(END)
                            if after <= size:
                                link[low + at] = after
                        at = data.find(MAGIC, at + 1)
                leaves: dict[int, int | None] = {}
                for at in sorted(link, reverse=True):  # links lead forward
                    after = link[at]
                    leaves[at] = after if after >= high else leaves.get(after)
                rows = [(path, part, a, b) for a, b in leaves.items() if b is not None]
                yield pd.DataFrame(rows, columns=["path", "range", "offset", "leaves"])

    return dealt(parts.select("path", "size", "range"), parts).mapInPandas(run, "path string, range long, offset long, leaves long")


def dealt(rows: DataFrame, parts: DataFrame) -> DataFrame:
    """Rows that stand for ranges of files, a few to a task.  The count is given,
    since the rows are small and would be coalesced by their own size."""
    return rows.repartition(max(1, -(-parts.count() // RANGES_PER_TASK)))


def chain_entries(found: DataFrame, parts: DataFrame) -> DataFrame:
    """(path, offset): where the chain from offset 0 enters each range, by
    pointer jumping; one row per range."""
    jump = found.select("path", "offset", "leaves")
    known = parts.select("path", F.lit(0).cast("long").alias("offset")).distinct()
    rounds = int(parts.agg(F.coalesce(F.max("last"), F.lit(0)).alias("n")).first()["n"]).bit_length()
    for k in range(rounds):
        ahead = known.join(jump, ["path", "offset"]).select("path", F.col("leaves").alias("offset"))
        known = saved(known.union(ahead).distinct(), f"warc-known{k}")
        if k + 1 < rounds:
            onward = jump.select("path", F.col("offset").alias("leaves"), F.col("leaves").alias("next"))
            # a link to the end of its file has no successor and stays
            jump = saved(jump.join(onward, ["path", "leaves"], "left").select(
                "path", "offset", F.coalesce("next", "leaves").alias("leaves")), f"warc-jump{k}")
    return known


def read(spark: SparkSession, path: str, split_bytes: int = 16 << 20) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to, url of
    every record on the chains; a broken chain or digest raises."""
    parts = saved(ranges(spark, path, split_bytes), "warc-ranges")
    found = saved(candidates(parts, split_bytes), "warc-candidates")
    entry = (chain_entries(found, parts).withColumn("range", F.floor(F.col("offset") / split_bytes).cast("long"))
             .join(parts, ["path", "range"]))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for path, size, part, at in zip(pdf["path"], pdf["size"], pdf["range"], pdf["offset"]):
                high, rows = min((part + 1) * split_bytes, size), []
                with opened(path) as f:
                    while at < high:
                        got = read_head(f, at, size)
                        if not got or not got[0].startswith(MAGIC):
                            raise ValueError(f"{path}: no record at {at}")
                        head, body = got
                        length = int(field_of(head, "Content-Length"))
                        f.seek(body)
                        block = f.read(length)
                        if f.read(len(END)) != END:
                            raise ValueError(f"{path}: the record at {at} does not end at its length")
                        at = body + length + len(END)
                        page, kind = field_of(head, "X-Page-Id"), field_of(head, "WARC-Type")
                        digest = field_of(head, "WARC-Payload-Digest").removeprefix("sha1:")
                        n, refers = int(field_of(head, "X-Payload-Length")), None
                        if kind == "response":
                            payload = block[block.index(END) + len(END):]
                            n = len(payload)
                            if base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
                                raise ValueError(f"{path}: digest of the record before {at}")
                        else:
                            refers = int(field_of(head, "WARC-Refers-To").removeprefix("<urn:page:").rstrip(">"))
                        rows.append((page and int(page), n, digest, kind, refers, field_of(head, "WARC-Target-URI")))
                yield pd.DataFrame(rows, columns=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url"]
                                   ).astype({"page_id": "Int64", "refers_to": "Int64"})

    return dealt(entry, parts).mapInPandas(
        run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string")
