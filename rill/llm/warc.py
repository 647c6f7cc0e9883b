"""WARC archives written and read by Spark, with a merged capture index.

*Writing.*  Equal payloads are told by their SHA-1; per digest the largest page
id is found with partial aggregation, and only digests that occur more than once
take part in the join that marks revisits (Spark can split its large
partitions, so one payload may make up a third of all rows).  Records are put
together by SQL functions and written by Spark's own text writer, whose line
separator is the end of a WARC record (CR LF CR LF): each task commits one
gzipped archive in any file system that Spark can write.

*Reading.*  Spark reads the archives by the same separator, which also stands
inside records, so a task puts the stream together again and cuts it by the
records' Content-Length.  It holds one record at a time.  Digests and lengths
of responses are computed anew from what was read.

*Index.*  Every reading task sorts its captures by URL key, time and id: a run,
stored in the shared folder.  Range partitions over the runs are merged by a
loser tree over the sorted runs that meet in them; partitions in order give the
capture histories in order.  The id is part of the range key, so a URL with a
third of all captures is spread, too.

Defined cases: a null payload is empty and may be a duplicate; payloads below
``min_bytes`` are always responses; equal rows (same id, same payload) are all
responses if theirs is the largest id, and a null id is smaller than any; null
URLs have no WARC-Target-URI and an empty key; blanks and control characters in
URLs are written as %20; further columns are ignored; an empty table gives no
rows.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
from collections.abc import Iterator
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rill.session import cut_lineage, ensure_checkpoint_dir

RECORD_END = "\r\n\r\n"
# Header fields and the alphabet of base32 digests.
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
FIRST_CAPTURE = 1_704_067_200


def base32(sha1: Column) -> Column:
    """RFC 4648 text of a SHA-1 in hexadecimal, 40 bits at a time."""
    part = lambda k: F.lpad(F.conv(F.substring(sha1, 10 * k + 1, 10), 16, 32), 8, "0")
    return F.translate(F.concat(*map(part, range(4))), "0123456789ABCDEFGHIJKLMNOPQRSTUV", BASE32)


def records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
            min_bytes: int = 0) -> DataFrame:
    """One column, ``value``: the records without their final line ends."""
    payload = F.coalesce(F.col(payload_col).cast("string"), F.lit(""))
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("sha1", F.sha1(F.col("payload").cast("binary")))
    large = F.octet_length("payload") >= min_bytes
    groups = rows.filter(large).groupBy("sha1").agg(F.max("id").alias("first"), F.count("*").alias("n"))
    groups = cut_lineage(groups.filter("n > 1").select(F.col("sha1").alias("s"), "first"))
    rows = rows.join(groups, (F.col("sha1") == F.col("s")) & large, "left")
    again = F.col("s").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))
    name = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("null")), F.lit(">"))
    line = lambda field, value: F.concat(F.lit(f"{field}: "), value, F.lit("\r\n"))
    seconds = F.lit(FIRST_CAPTURE) + F.pmod(F.coalesce(F.col("id").cast("long"), F.lit(0)), F.lit(10**9))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.octet_length("payload").cast("string"), F.lit(RECORD_END))
    block = F.concat(http, F.when(again, F.lit("")).otherwise(F.col("payload")))
    head = F.concat(
        F.lit("WARC/1.1\r\n"), line("WARC-Type", F.when(again, F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", name(F.col("id"))),
        line("WARC-Date", F.date_format(F.timestamp_seconds(seconds), "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        F.coalesce(line("WARC-Target-URI", F.regexp_replace("url", r"[\x00-\x20\x7F]", "%20")), F.lit("")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), base32(F.col("sha1")))),
        F.when(again, F.concat(line("WARC-Refers-To", name(F.col("first"))), line("WARC-Profile", F.lit(PROFILE))))
        .otherwise(F.lit("")),
        F.lit("Content-Type: application/http; msgtype=response\r\nContent-Length: "),
        F.octet_length(block).cast("string"), F.lit(RECORD_END))
    return rows.select(F.concat(head, block).alias("value"))


def write(pages: DataFrame, folder: str, **columns) -> str:
    """Write the archives (one gzipped WARC file per task); returns the folder."""
    records(pages, **columns).write.text(folder, compression="gzip", lineSep=RECORD_END)
    return folder


def url_key(url: str) -> str:
    """Host labels from the last to the first, then path and query."""
    try:
        parts = urlsplit(url)
        host = (parts.hostname or "").removeprefix("www.")
    except ValueError:
        return url.lower()
    return ",".join(reversed(host.split("."))) + ")" + (parts.path or "/") + (f"?{parts.query}" if parts.query else "")


def cut_records(stream: bytearray) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and block of every whole record; takes them off the stream."""
    end = RECORD_END.encode()
    while (head := stream.find(end)) >= 0:
        fields = dict(x.split(": ", 1) for x in stream[:head].decode().split("\r\n")[1:])
        start = head + len(end)
        stop = start + int(fields["Content-Length"])
        if len(stream) < stop + len(end):
            return
        yield fields, bytes(stream[start:stop])
        del stream[:stop + len(end)]


SCHEMA = ("id string, payload_bytes long, payload_digest string, record_type string, refers_to string, "
          "url_key string, captured string")


def read(spark: SparkSession, folder: str) -> DataFrame:
    """What the archives hold, a row per record (ids as text, null ids null)."""
    lines = spark.read.text(folder, lineSep=RECORD_END)
    lines = lines.select(F.xxhash64("_metadata.file_path").alias("file"), F.col("value").cast("binary").alias("value"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream, file = bytearray(), None
        schema = pa.schema([(c, pa.int64() if c == "payload_bytes" else pa.string())
                            for c in (x.split()[0] for x in SCHEMA.split(", "))])
        own = lambda urn: None if urn == "<urn:page:null>" else urn[10:-1]
        for batch in batches:
            out = []
            for f, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if f != file:                   # an archive ends with its last record
                    stream.clear()
                    file = f
                stream += value.as_py() + RECORD_END.encode()
                for fields, block in cut_records(stream):
                    http, payload = block.split(RECORD_END.encode(), 1)
                    kind, refers = fields["WARC-Type"], fields.get("WARC-Refers-To")
                    if kind == "response":
                        size, digest = len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode()
                    else:
                        size = int(http.rsplit(b"Content-Length: ", 1)[1])
                        digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                    url = fields.get("WARC-Target-URI")
                    out.append((own(fields["WARC-Record-ID"]), size, digest, kind, refers and own(refers),
                                url_key(url) if url else "", fields["WARC-Date"]))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t.type) for c, t in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)

    return lines.mapInArrow(run, SCHEMA)


class LoserTree:
    """Merges sorted runs: the inner nodes hold the losers of their matches, so
    the next winner takes one match per level."""

    def __init__(self, runs: list[list]):
        self.runs = [iter(r) for r in runs]
        self.size = 1
        while self.size < len(runs):
            self.size *= 2
        self.head = [next(r, None) for r in self.runs] + [None] * (self.size - len(runs))
        self.loser = [0] * self.size
        self.loser[0] = self.play(1)

    def before(self, a: int, b: int) -> bool:
        x, y = self.head[a], self.head[b]
        return y is None or x is not None and (x, a) <= (y, b)

    def play(self, node: int) -> int:
        if node >= self.size:
            return node - self.size
        a, b = self.play(2 * node), self.play(2 * node + 1)
        a, b = (a, b) if self.before(a, b) else (b, a)
        self.loser[node] = b
        return a

    def __iter__(self) -> Iterator:
        while (item := self.head[win := self.loser[0]]) is not None:
            yield item
            self.head[win] = next(self.runs[win], None)
            node = (win + self.size) // 2
            while node:
                if self.before(self.loser[node], win):
                    self.loser[node], win = win, self.loser[node]
                node //= 2
            self.loser[0] = win


def merge_index(captures: DataFrame) -> DataFrame:
    """The captures in order of url_key, captured and id, over all partitions."""
    order = ("url_key", "captured", "id")
    runs = cut_lineage(captures.sortWithinPartitions(*order))
    names = runs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = pa.Table.from_batches(batches, schema)
        if not len(got):
            return
        keys = list(zip(*((x or "" for x in got[c].to_pylist()) for c in order), range(len(got)), strict=True))
        # a new run begins wherever the order falls
        cuts = [0, *(i for i in range(1, len(keys)) if keys[i][:3] < keys[i - 1][:3]), len(keys)]
        merged = LoserTree([keys[a:b] for a, b in zip(cuts, cuts[1:], strict=False)])
        at = np.fromiter((k[3] for k in merged), np.int64, len(keys))
        yield from got.take(pa.array(at)).combine_chunks().to_batches()

    parts = int(captures.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    schema = pa.schema([(c, pa.int64() if c == "payload_bytes" else pa.string()) for c in names])
    return runs.repartitionByRange(parts, *order).mapInArrow(run, SCHEMA)


def archive(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
            min_bytes: int = 0, folder: str | None = None) -> DataFrame:
    """Write, read back and merge the index: ``id_col``, payload_bytes,
    payload_digest, record_type, refers_to, url_key, captured.  The archives
    stay in ``folder`` (by default a new one beside the checkpoints)."""
    spark = pages.sparkSession
    folder = folder or f"{ensure_checkpoint_dir(spark).rstrip('/')}/warc-{uuid.uuid4().hex}"
    kind = pages.schema[id_col].dataType
    write(pages, folder, id_col=id_col, url_col=url_col, payload_col=payload_col, min_bytes=min_bytes)
    rows = merge_index(read(spark, folder))
    return rows.select(F.col("id").cast(kind).alias(id_col), "payload_bytes", "payload_digest", "record_type",
                       F.col("refers_to").cast(kind).alias("refers_to"), "url_key", "captured")
