"""Send the rows that pass a filter to several topics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql.types import StructType

from flightloom.functions import decode, encode
from flightloom.sources.topics import Topics


def filter_and_route(
    rows: DataFrame,
    predicate: Column,
    topics: Topics,
    names: list[str],
    schema: StructType,
    key: str = "unique_id",
    publish: str | None = None,
) -> dict[str, DataFrame]:
    """Publishes the passing rows to every topic, and returns each topic decoded.

    The rows are scanned, filtered and encoded once, however many topics there are.
    """
    topics.publish(encode(rows.where(predicate), key), *names, name=publish)
    return {name: decode(topics.read(name), schema) for name in names}
