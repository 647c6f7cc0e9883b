"""File sources of the workloads (S1-S16), all with declared schemas.

Text formats are read by Spark's own readers (splittable, parallel);
``.gz`` inputs are read as they are (one task per file, since gzip does not
split).  Malformed fields become nulls rather than failing the job.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_delimited(spark: SparkSession, path: str | Sequence[str], schema: StructType | str,
                   sep: str = "\t", header: bool = False) -> DataFrame:
    """Delimited text with a declared schema; unparsable fields
    become null (PERMISSIVE), compressed files are decompressed on read."""
    return (spark.read.schema(schema).option("sep", sep).option("header", header)
            .option("mode", "PERMISSIVE").csv(path))


def read_csv_header(spark: SparkSession, path: str | Sequence[str],
                    schema: StructType | str | None = None) -> DataFrame:
    """CSV with a header line.  Without a schema every column is a
    string (as the header-only reader gives); with one, types are declared
    (no inference pass over the data)."""
    r = spark.read.option("header", True).option("mode", "PERMISSIVE")
    if schema is not None:
        r = r.schema(schema)
    return r.csv(path)


def read_csv_files(spark: SparkSession, paths: Sequence[str], schema=None) -> DataFrame:
    """Several CSV files as one table; files whose headers differ are
    aligned by column name (missing columns become null)."""
    out = None
    for p in paths:
        df = read_csv_header(spark, p, schema)
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


def read_tsv_renamed(spark: SparkSession, path: str, rename: Mapping[str, str],
                     schema: StructType | str | None = None) -> DataFrame:
    """TSV with a header, columns renamed (e.g. to ``src``/``dst``)."""
    r = spark.read.option("header", True).option("sep", "\t")
    if schema is not None:
        r = r.schema(schema)
    return r.csv(path).withColumnsRenamed(dict(rename))


def read_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Text lines (a file, a folder or a glob) as ``value``."""
    return spark.read.text(path)


def _edges(lines: DataFrame, sep: str) -> DataFrame:
    """``src, dst`` of every line that is neither blank nor a comment; a field
    that is missing or no number is null, so no line is lost unseen."""
    text = F.trim(F.col("value"))
    parts = F.split(text, sep)
    return (lines.where((text != "") & ~text.startswith("#"))
            .select(F.get(parts, F.lit(0)).try_cast("long").alias("src"),
                    F.get(parts, F.lit(1)).try_cast("long").alias("dst")))


def read_edge_tsv(spark: SparkSession, path: str) -> DataFrame:
    """``src<TAB>dst`` edge list; ``#`` lines are skipped, malformed ids
    are null (``complete_edges`` drops and ``bad_edges`` counts them)."""
    return _edges(spark.read.text(path), r"\t")


def read_edge_list(spark: SparkSession, path: str) -> DataFrame:
    """Pairs separated by white space; ``#`` lines and blank lines are
    skipped, malformed ids are null."""
    return _edges(spark.read.text(path), r"\s+")


def complete_edges(edges: DataFrame) -> DataFrame:
    return edges.where(F.col("src").isNotNull() & F.col("dst").isNotNull())


def bad_edges(edges: DataFrame) -> DataFrame:
    return edges.agg(F.count_if(F.col("src").isNull() | F.col("dst").isNull()).alias("bad"))


RATINGS_SCHEMA = "userId int, movieId int, rating double, timestamp long"


def read_ratings(spark: SparkSession, path: str) -> DataFrame:
    """Ratings CSV with header; the trailing timestamp is dropped."""
    return read_csv_header(spark, path, RATINGS_SCHEMA).drop("timestamp")


def read_keyed_tsv(spark: SparkSession, path: str, columns: Sequence[str],
                   key: str = "row_key") -> DataFrame:
    """Keyed TSV import -- first field is the row key, then the named
    columns (all strings, as cells are)."""
    schema = ", ".join([f"{key} string"] + [f"{c} string" for c in columns])
    return read_delimited(spark, path, schema, sep="\t")


def kafka_stream(spark: SparkSession, servers: str, topic: str,
                 starting_offsets: str = "latest"):
    """A Kafka subscription as a stream of ``timestamp, value``
    (plus ``partition, offset``).  Needs the Kafka connector on the class
    path; the reader is returned unloaded so options can be inspected."""
    return (spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", servers)
            .option("subscribe", topic)
            .option("startingOffsets", starting_offsets))


def kafka_lines(raw: DataFrame) -> DataFrame:
    """The columns the trend job uses from a Kafka row."""
    return raw.select(F.col("timestamp").cast("timestamp").alias("timestamp"),
                      F.col("value").cast("string").alias("value"),
                      "partition", "offset")
