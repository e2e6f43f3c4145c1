"""Tombstones, NaN and missing values, casts on landing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StructType

from flightloom.functions.envelope import CORRUPT
from flightloom.schemas import LANDED


def drop_tombstones(records: DataFrame) -> DataFrame:
    """Records that carry a payload."""
    return records.where(F.col("value").isNotNull())


def _is_float(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, (DoubleType, FloatType))


def is_missing(df: DataFrame, column: str) -> Column:
    """NULL, or NaN in a floating-point column."""
    c = F.col(column)
    return (c.isNull() | F.isnan(c)) if _is_float(df, column) else c.isNull()


def reject_non_numeric(
    df: DataFrame, columns: tuple[str, ...] = ("value", "MaxOffset")
) -> tuple[DataFrame, DataFrame]:
    """Rows with a number in every given column, and the other rows."""
    bad = F.lit(False)
    for column in columns:
        bad = bad | is_missing(df, column)
    return df.where(~bad), df.where(bad)


def cast_to(df: DataFrame, schema: StructType) -> DataFrame:
    """Columns by name, in the order and types of ``schema``; NULL where a cast fails."""
    return df.select(
        *[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema]
    )


# Why a record is not landed, in the order in which reasons are named.
REASONS = (
    "unreadable",
    "no_ems_system_id",
    "no_flight_record_number",
    "no_value",
    "no_max_offset",
    "max_offset_not_a_number",
)


def with_reject_reason(nested: DataFrame) -> DataFrame:
    """Adds why a decoded record cannot be landed; NULL where it can.

    ``nested`` is what ``decode_nested`` returns: ``data`` and ``record``. Every reason that
    holds is named, so that counts per reason are whole.
    """

    def field(name: str) -> Column:
        return F.col("data").getField(name)

    holds = (
        F.col("data").isNull() | field(CORRUPT).isNotNull(),
        field("ems_system_id").isNull(),
        field("adi_flight_record_number").isNull(),
        field("value").isNull(),
        field("MaxOffset").isNull(),
        F.isnan(field("MaxOffset")),
    )
    text = F.concat_ws(",", *[F.when(bad, reason) for bad, reason in zip(holds, REASONS)])
    landed = [field(f.name).alias(f.name) for f in LANDED]
    return nested.select(
        *landed, "record", F.when(text != "", text).alias("reject_reason")
    )


def reason_counts(reason: Column | str) -> list[Column]:
    """One aggregate per reason: how many rows have it, alone or among others."""
    each = F.split(reason, ",")
    return [
        F.count(F.when(F.array_contains(each, r), F.lit(1))).alias(f"refused_{r}") for r in REASONS
    ]
