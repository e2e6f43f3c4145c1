"""Catalog tables as sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from flightloom.schemas import ddl


def create_table(
    spark: SparkSession,
    table: str,
    schema: StructType,
    location: str | None = None,
    partition_columns: Sequence[str] = (),
) -> None:
    """A new parquet table with the declared columns; fails if it exists.

    Parquet, because a comma in a text would break a comma-delimited table.
    """
    statement = f"CREATE TABLE IDENTIFIER(:table) ({ddl(schema)}) USING parquet"
    if partition_columns:
        statement += f" PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_columns)})"
    if location:
        escaped = location.replace("\\", "\\\\").replace("'", "\\'")
        statement += f" LOCATION '{escaped}'"
    spark.sql(statement, args={"table": table})


def append_rows(df: DataFrame, table: str) -> None:
    """One parallel append; columns are matched by name."""
    target = df.sparkSession.table(table).columns
    df.select(*target).write.insertInto(table)


def _saved(writer: DataFrameWriter, table: str, location: str | None) -> None:
    writer = writer.format("parquet").mode("errorifexists")
    if location:
        writer = writer.option("path", location)
    writer.saveAsTable(table)


def save_table(
    df: DataFrame,
    table: str,
    location: str | None = None,
    partition_columns: Sequence[str] = (),
) -> None:
    """Saves a frame as a new catalog table; fails if it exists.

    Rows of a partitioned table are brought together first, or every task would write
    a file per partition. The rebalance lets AQE split a partition value with many
    rows over several tasks, and merge those with few.
    """
    if partition_columns:
        df = df.hint("rebalance", *partition_columns)
    writer = df.write
    if partition_columns:
        writer = writer.partitionBy(*partition_columns)
    _saved(writer, table, location)


def save_lookup_table(
    df: DataFrame,
    table: str,
    key: str,
    location: str | None = None,
    distinct_per_file: int = 100_000,
    row_group_bytes: int = 32 << 20,
) -> None:
    """Saves a frame as a new table in which the rows of one key are found without a scan.

    Rows are sorted by key in ranges over all tasks, so the statistics of files and row groups
    leave out nearly all of them; within the range of a group, a Bloom filter does for keys
    that are not there. The key with the most rows spreads over several ranges.
    ``distinct_per_file`` is the number of keys that a filter is sized for.
    """
    # Rows of one key are told apart by a hash, or they would all fall in one range.
    spread = F.xxhash64(*[c for c in df.columns if c != key]).alias("_spread")
    keys = [F.col(key), F.col("_spread")]
    placed = df.select("*", spread).repartitionByRange(*keys).sortWithinPartitions(*keys)
    writer = (
        placed.drop("_spread")
        .write.option(f"parquet.bloom.filter.enabled#{key}", "true")
        .option(f"parquet.bloom.filter.expected.ndv#{key}", distinct_per_file)
        .option("parquet.block.size", row_group_bytes)
    )
    _saved(writer, table, location)


def save_bucketed(
    df: DataFrame,
    table: str,
    keys: Sequence[str],
    buckets: int,
    location: str | None = None,
    hot_rows: int | None = None,
) -> None:
    """Saves a frame in buckets by a hash of ``keys``: joins and groupings by them, or by
    more, then take no shuffle if the other side lies in as many buckets.

    A bucket is one task's work, so a key that has a large share of the rows must not be in
    one: keys with more than ``hot_rows`` rows go to a second table, ``<table>_hot``, in no
    buckets. See ``bucketed_flight_max`` for a join of both.
    """
    spark = df.sparkSession

    def save(rows: DataFrame) -> None:
        # One file per bucket, sorted, so that a merge join need not sort.
        writer = rows.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys)
        _saved(writer, table, location)

    if hot_rows is None:
        return save(df)
    # The keys that are hot are few: each has more than hot_rows rows.
    save_table(
        df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > hot_rows).drop("_n"),
        f"{table}_hot_keys",
        location and f"{location}_hot_keys",
    )
    hot = spark.table(f"{table}_hot_keys").alias("h")
    same = F.lit(True)
    for key in keys:
        same = same & F.col(f"d.{key}").eqNullSafe(F.col(f"h.{key}"))
    save(df.alias("d").join(hot, same, "left_anti"))
    save_table(
        df.alias("d").join(hot, same, "left_semi"), f"{table}_hot", location and f"{location}_hot"
    )
