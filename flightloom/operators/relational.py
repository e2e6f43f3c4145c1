"""Filters, joins and aggregates on samples and metadata."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

JOIN_KEYS = ["unique_id", "ems_system_id", "parameter_id"]
FLIGHT_KEYS = ["adi_flight_record_number", "ems_system_id", "parameter_id", "unique_id"]
RESULT_KEYS = ["adi_flight_record_number", "ems_system_id", "parameter_id", "value"]


def select_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns)


def equals(df: DataFrame, column: str, constant: Any) -> DataFrame:
    """Rows whose column equals a constant; reaches the scan as a pushed filter."""
    return df.where(F.col(column) == F.lit(constant))


def in_periods(df: DataFrame, periods: Sequence[str], column: str = "sub_part1") -> DataFrame:
    """Rows of the given periods; prunes whole directories if partitioned by them."""
    return df.where(F.col(column).isin(*periods))


def in_periods_of(df: DataFrame, periods: DataFrame, column: str = "sub_part1") -> DataFrame:
    """Rows whose period is in a table of periods, which may be filtered itself.

    On a table partitioned by period, Spark evaluates the small side first and then reads the
    matching directories only. It does so if that side is below the broadcast threshold;
    beyond it the rows meet in a shuffled join.
    """
    return df.join(periods.select(F.col(periods.columns[0]).alias(column)), column, "left_semi")


def preview(df: DataFrame, rows: int = 20) -> DataFrame:
    """Some rows, in no given order."""
    return df.limit(rows)


def dedupe_keys(metadata: DataFrame) -> DataFrame:
    """Distinct flight key tuples.

    Copies are merged inside each task before the shuffle, so a tuple that was
    ingested any number of times costs one row per task.
    """
    return metadata.select(*FLIGHT_KEYS).distinct()


def collapse_samples(samples: DataFrame) -> DataFrame:
    """Largest offset per join key and value; all that the flight maximum needs.

    The shuffle key includes ``value``, so the samples of one long flight spread
    over many tasks, and repeats of one value are merged before the shuffle.
    """
    return samples.groupBy(*JOIN_KEYS, "value").agg(F.max("offset").alias("offset"))


def enrich_join(samples: DataFrame, keys: DataFrame) -> DataFrame:
    """Samples with the flight numbers of their key; NULL keys match nothing.

    No hint: AQE broadcasts the keys when their measured size is below the
    threshold, and otherwise splits the partitions a hot flight makes large.
    """
    return samples.join(keys, JOIN_KEYS, "inner")


def max_offset(joined: DataFrame) -> DataFrame:
    """Largest offset per flight, system, parameter and value."""
    return joined.groupBy(*RESULT_KEYS).agg(F.max("offset").alias("MaxOffset"))


def rekey(metadata: DataFrame, keys: DataFrame | None = None) -> DataFrame:
    """Metadata key columns of the rows whose key tuple is in ``keys``, copies kept.

    ``keys`` must hold each tuple once. Left out, the metadata's own distinct
    tuples are meant: then every row without a NULL in its key matches exactly
    one of them, and a filter gives the join's rows without any shuffle.
    """
    columns = ["unique_id", "adi_flight_record_number", "ems_system_id", "parameter_id"]
    if keys is None:
        return metadata.select(*columns).dropna(how="any")
    return metadata.select(*columns).join(keys, FLIGHT_KEYS, "inner").select(*columns)


def unique_records(records: DataFrame) -> DataFrame:
    """Each topic record once, for reads that overlap (delivery is at-least-once)."""
    return records.dropDuplicates(["topic", "partition", "offset"])
