"""Sinks and managed tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rill.session import cut_lineage, release


def write_delimited(df: DataFrame, path: str, sep: str = "\t", header: bool = False,
                    mode: str = "overwrite") -> None:
    """K1/K6: delimited text, one part file per partition."""
    df.write.mode(mode).option("sep", sep).option("header", header).csv(path)


def write_text(df: DataFrame, path: str, sep: str = "\t", mode: str = "overwrite") -> None:
    """K2: plain text lines (columns joined by ``sep``)."""
    df.select(F.concat_ws(sep, *[F.col(c).cast("string") for c in df.columns]).alias("value")) \
        .write.mode(mode).text(path)


def write_report_csv(df: DataFrame, path: str, header: bool = True, mode: str = "overwrite") -> None:
    """K3/K4: a report as one CSV part file.  The result is computed and
    written in parallel first; only the finished rows are merged into one
    file, so the plan behind the report never runs in one task."""
    done = cut_lineage(df)
    done.coalesce(1).write.mode(mode).option("header", header).csv(path)
    release(done)


def show_rows(df: DataFrame, n: int = 20) -> list:
    """A bounded peek at the first rows (never an unbounded collect)."""
    return df.limit(n).collect()


def create_table(spark: SparkSession, name: str, schema: str, fmt: str = "parquet",
                 database: str | None = None) -> None:
    """Create-if-not-exists a managed table (and its database)."""
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
        name = f"{database}.{name}"
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({schema}) USING {fmt}")


def truncate_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"TRUNCATE TABLE {name}")


def load_into(df: DataFrame, name: str, overwrite: bool = False) -> None:
    """Load rows into an existing table, replacing or appending."""
    df.write.insertInto(name, overwrite=overwrite)
