"""Largest offset per flight, system, parameter and value."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from flightloom.operators import (
    collapse_samples,
    dedupe_keys,
    enrich_join,
    equals,
    max_offset,
)
from flightloom.operators.relational import JOIN_KEYS
from flightloom.plans.roundtrip import round_trip
from flightloom.schemas import RESULT
from flightloom.sources.tables import save_bucketed
from flightloom.sources.topics import Topics


def flight_max_offset(
    samples: DataFrame,
    metadata: DataFrame,
    unique_id: int | None = None,
    collapse: bool = False,
) -> DataFrame:
    """The result for all ids, or for one.

    ``collapse`` merges repeated sample values ahead of the join, in one more shuffle.
    It pays where values repeat often within an id: the join then shuffles distinct
    values instead of samples, and a flight with several flight numbers multiplies
    values instead of samples. It forgoes a join without a shuffle of the samples.
    """
    if unique_id is not None:
        samples = equals(samples, "unique_id", unique_id)
        metadata = equals(metadata, "unique_id", unique_id)
    if collapse:
        samples = collapse_samples(samples)
    return max_offset(enrich_join(samples, dedupe_keys(metadata)))


def save_flight_buckets(
    samples: DataFrame,
    metadata: DataFrame,
    table: str,
    buckets: int,
    location: str | None = None,
    hot_rows: int = 50_000_000,
) -> None:
    """Samples and metadata keys in buckets of the join keys, as ``<table>`` and
    ``<table>_keys``; samples of a key with more than ``hot_rows`` rows lie apart."""
    save_bucketed(samples, table, JOIN_KEYS, buckets, location, hot_rows)
    keys = dedupe_keys(metadata)
    save_bucketed(keys, f"{table}_keys", JOIN_KEYS, buckets, location and f"{location}_keys")


def bucketed_flight_max(spark: SparkSession, table: str) -> DataFrame:
    """The result from what ``save_flight_buckets`` saved.

    Bucketed samples meet their keys where they lie and combine there before the one shuffle
    by result. The few hot keys are joined as ``flight_max_offset`` does it, where Spark may
    split them over tasks.
    """
    keys = spark.table(f"{table}_keys")
    apart = keys.join(spark.table(f"{table}_hot_keys"), JOIN_KEYS, "left_semi")
    near = enrich_join(spark.table(table), keys)
    hot = enrich_join(spark.table(f"{table}_hot"), apart)
    return max_offset(near.unionByName(hot))


def publish_flight_max(
    samples: DataFrame,
    metadata: DataFrame,
    topics: Topics,
    topic: str,
    unique_id: int | None = None,
    collapse: bool = False,
    publish: str | None = None,
) -> DataFrame:
    """Publishes the result, keyed by flight record number, and reads the topic back."""
    result = flight_max_offset(samples, metadata, unique_id, collapse)
    return round_trip(
        result, topics, topic, RESULT, key="adi_flight_record_number", publish=publish
    )
