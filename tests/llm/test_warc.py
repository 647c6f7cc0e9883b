"""Archives hold every payload; the index is in order; duplicates refer."""

import base64
import gzip
import hashlib
import os
import random
from glob import glob

from conftest import SF_MID
from rill.llm import queries, warc
from rill.llm.common import table


def brute(rows, min_bytes=0):
    digest = {i: hashlib.sha1((t or "").encode()).digest() for i, (_, _, t) in enumerate(rows)}
    largest = {}
    for i, (page, _, t) in enumerate(rows):
        if page is not None and len((t or "").encode()) >= min_bytes:
            largest[digest[i]] = max(largest.get(digest[i], page), page)
    out = []
    for i, (page, _, t) in enumerate(rows):
        data = (t or "").encode()
        first = largest.get(digest[i]) if len(data) >= min_bytes else None
        again = first is not None and first != page
        out.append((page, len(data), base64.b32encode(digest[i]).decode(), "revisit" if again else "response",
                    first if again else None))
    return sorted(out, key=str)


def odd_pages():
    rng = random.Random(9)
    ends = ["", "\r\n", "\r\n\r\n", "\r\n\r\n\r\n", "x\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n", "é🎉\r", "\n"]
    rows = [(i, f"http://h{i % 7}.example.com/{i % 5}", rng.choice(ends) + "a" * rng.randint(0, 3) + rng.choice(ends))
            for i in range(300)]
    rows += [(1000 + i, "http://hot.example.org/", "same") for i in range(200)]
    rows += [(2000, None, None), (2001, "not a url [", ""), (2002, "http://x/ y\r\nz", "u"), (None, "http://n/", "same"),
             (2003, "http://long/", "é" * 300_000), (2004, "http://a/", "twice"), (2004, "http://a/", "twice"),
             (-5, "http://neg/?q=1", "neg")]
    return rows


def columns(got):
    return sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"])
                   for r in got), key=str)


def test_odd_pages(spark, tmp_dir):
    rows = odd_pages()
    pages = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, value int")
    for n, least in enumerate((0, 3)):
        folder = os.path.join(tmp_dir, f"w{n}")
        got = warc.archive(pages.repartition(4), min_bytes=least, folder=folder).collect()
        assert columns(got) == brute(rows, least)
        order = [(r["url_key"], r["captured"]) for r in got]
        assert order == sorted(order) and ("org,example,hot)/" in {o[0] for o in order})
        # any WARC reader that follows Content-Length finds the same records
        records = 0
        for path in glob(f"{folder}/*.gz"):
            with gzip.open(path) as f:
                records += sum(1 for _ in warc.cut_records(bytearray(f.read())))
        assert records == len(rows)


def test_given_pages(spark):
    rows = [(r["page_id"], r["url"], r["html"]) for r in table(spark, SF_MID, "pages").collect()]
    assert columns(queries.op4_warc(spark, SF_MID).collect()) == brute(rows)


def test_empty_table(spark):
    assert warc.archive(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_loser_tree():
    rng = random.Random(1)
    for k in (0, 1, 2, 3, 7, 20):
        runs = [sorted(rng.randint(0, 50) for _ in range(rng.randint(0, 30))) for _ in range(k)]
        assert list(warc.LoserTree(runs)) == sorted(x for r in runs for x in r)
