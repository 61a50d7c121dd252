import base64
import glob
import hashlib

import pytest

from tessera.llm import warc

TRAP = "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
ROWS = [(1, "http://a/", "<p>one</p>"), (2, "http://b/\r\nX: y", "<p>one</p>"), (3, "u", None), (4, "u", ""), (5, None, "ünï"), (6, "t", TRAP * 40),
        (7, "t", "x" + TRAP + "WARC/1.1\r\n"), (8, "l", "long " * 60_000), (None, "n", "<p>one</p>"), (9, "s", "single"), (9, "s", "single"), (None, "n", "alone"),
        (10, "z", "end\r\n\r\n"), (11, "z", "\r\n\r\nWARC/1.1\r\nContent-Length: 99999999\r\n\r\n")]


def brute(rows):
    out = []
    for page, _, html in rows:
        raw = (html or "").encode()
        same = [p for p, _, h in rows if (h or "") == (html or "") and p is not None]
        last = max(same, default=None)
        revisit = len(same) > 0 and page != last
        out.append((page, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "revisit" if revisit else "response", last if revisit else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("split", [64, 1000, 16 << 20])
def test_round_trip(spark, tmp_path, split):
    pages = spark.createDataFrame([(*r, "x") for r in ROWS], "page_id long, url string, html string, sha1 string").coalesce(2)
    path = f"file://{tmp_path}/warc"
    warc.write(pages, path)
    got = warc.read(spark, path, split).drop("url").collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(ROWS)


def test_bytes_are_records(spark, tmp_path):
    warc.write(spark.createDataFrame(ROWS[:2], "page_id long, url string, html string").coalesce(1), f"file://{tmp_path}/w")
    raw = open(glob.glob(f"{tmp_path}/w/part-*")[0], "rb").read()
    assert raw.startswith(warc.MAGIC) and raw.count(warc.MAGIC) == 2 and raw.endswith(b"\r\n\r\n")


def test_empty_and_broken(spark, tmp_path):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    warc.write(none, f"file://{tmp_path}/e")
    assert warc.read(spark, f"file://{tmp_path}/e").count() == 0
    warc.write(spark.createDataFrame(ROWS[:1], "page_id long, url string, html string").coalesce(1), f"file://{tmp_path}/b")
    (part,) = glob.glob(f"{tmp_path}/b/part-*")
    raw = open(part, "rb").read().replace(b"<p>one", b"<p>two")
    open(f"{tmp_path}/b/.x", "wb").close()
    new = f"{tmp_path}/c"
    import os
    os.mkdir(new)
    open(f"{new}/part-0.txt", "wb").write(raw)
    with pytest.raises(Exception, match="digest"):
        warc.read(spark, f"file://{new}").count()


def test_ranges_are_read_by_many_tasks(spark, tmp_path):
    rows = [(k, f"http://x/{k}", "<p>" + "y" * 400) for k in range(150)]
    warc.write(spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1), f"file://{tmp_path}/w")
    got = warc.read(spark, f"file://{tmp_path}/w", 1000)
    assert got.rdd.getNumPartitions() >= 60 // warc.RANGES_PER_TASK and got.count() == 150
