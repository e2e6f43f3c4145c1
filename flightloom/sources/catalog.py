"""Catalog tables and inline rows as DataFrames."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from flightloom.operators import equals, in_periods, in_periods_of


def scan(spark: SparkSession, table: str, unique_id: int | None = None) -> DataFrame:
    """All columns of a table, or of the rows with one ``unique_id``.

    Columns a job does not use are pruned, and the equality reaches the files.
    """
    df = spark.table(table)
    return df if unique_id is None else equals(df, "unique_id", unique_id)


def scan_where_in(
    spark: SparkSession,
    table: str,
    periods: Sequence[str],
    column: str = "sub_part1",
    limit: int | None = None,
) -> DataFrame:
    """Rows of a table in the given periods.

    Values are bound as literals, never pasted in SQL text. On a table partitioned
    by ``column`` only the matching directories are read.
    """
    df = in_periods(spark.table(table), periods, column)
    return df if limit is None else df.limit(limit)


def scan_periods_of(
    spark: SparkSession, table: str, periods: DataFrame, column: str = "sub_part1"
) -> DataFrame:
    """Rows of a table in the periods that the first column of another table lists."""
    return in_periods_of(spark.table(table), periods, column)


def inline_rows(
    spark: SparkSession, rows: Iterable[tuple], schema: StructType | str
) -> DataFrame:
    """A few literal rows with a declared schema.

    They are literals of the plan, so their size is known and a join with a large table
    sends them to it, whatever the table's size.
    """
    schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    structs = [
        F.struct(*[F.lit(x).cast(f.dataType).alias(f.name) for x, f in zip(row, schema)])
        for row in rows
    ]
    if not structs:
        return spark.createDataFrame([], schema)
    return spark.range(1).select(F.inline(F.array(*structs)))
