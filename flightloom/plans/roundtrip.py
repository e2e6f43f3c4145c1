"""Publish a table to a topic and read the topic back, typed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from flightloom.functions import decode, encode
from flightloom.sources.topics import Topics


def round_trip(
    df: DataFrame,
    topics: Topics,
    topic: str,
    schema: StructType,
    key: str = "unique_id",
    lossless_time: bool = False,
    publish: str | None = None,
) -> DataFrame:
    """All records of the topic after publishing ``df`` to it, with the broker time.

    ``publish`` names the publish, which may then be run again; file topics only.
    """
    topics.publish(encode(df, key, lossless_time), topic, name=publish)
    return decode(topics.read(topic), schema, lossless_time)
