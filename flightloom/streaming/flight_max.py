"""The flight maximum on a stream of samples."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flightloom.functions import decode, encode
from flightloom.operators import dedupe_keys, drop_tombstones, enrich_join
from flightloom.operators.relational import RESULT_KEYS
from flightloom.schemas import RESULT, SAMPLES
from flightloom.session import delete_folder, shared_path
from flightloom.sources.maximum_table import MaximumTable
from flightloom.sources.topics import Topics


@dataclass
class Drained:
    """What a drain did: its batches, the groups its state holds, and the rows too late for it."""

    batches: int = 0
    state_groups: int = 0
    late_rows: int = 0


def windowed_maxima(
    records: DataFrame, metadata: DataFrame, window: str = "1 hour", delay: str = "1 day"
) -> DataFrame:
    """Largest offsets per result group and window of broker time, as a stream.

    Samples meet the distinct metadata keys as they are at each batch. The state holds one
    maximum per group and window; the watermark lets go of windows ``delay`` behind the newest
    record, so the state is bounded by the groups of that time, not by the stream.
    """
    return _maxima_of(records, dedupe_keys(metadata), window, delay)


def _maxima_of(records: DataFrame, keys: DataFrame, window: str, delay: str) -> DataFrame:
    samples = decode(drop_tombstones(records), SAMPLES).withWatermark("timestamp", delay)
    joined = enrich_join(samples, keys)
    return joined.groupBy(F.window("timestamp", window), *RESULT_KEYS).agg(
        F.max("offset").alias("MaxOffset")
    )


def drain_flight_max(
    stream: DataFrame,
    metadata: DataFrame,
    table: MaximumTable,
    checkpoint: str,
    window: str = "1 hour",
    delay: str = "1 day",
    publish: tuple[Topics, str] | None = None,
) -> Drained:
    """Takes the samples that the stream has not delivered yet into the table, and returns.

    The distinct metadata keys are made once, when the drain begins, for all its batches. Each
    batch puts the maxima that it changed by, and at the end the table takes them in at once and
    keeps the largest. So after every drain the table holds the maximum over all samples drained
    so far, whatever windows the state has let go of; the work of a drain does not grow with its
    batches times the table. A batch that died is done again without harm, and what a drain that
    died had put by is taken in by the next one on its checkpoint.

    ``publish`` also sends each batch's maxima to a topic, in file topics under a name of the
    batch; the largest per group there is the result, see ``latest_maxima``.

    ``late_rows`` counts samples that came more than ``delay`` after newer ones and are not in
    the table: take them in with ``table.merge(flight_max_offset(...))``. Metadata must be there
    before the samples of its flights are drained.
    """

    spark = stream.sparkSession
    path = shared_path(spark, "flight-keys")
    dedupe_keys(metadata).write.option("compression", "zstd").parquet(path)
    keys = spark.read.parquet(path)

    def take_in(batch: DataFrame, number: int) -> None:
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        maxima = table.hold(batch, query, number)
        if publish:
            topics, topic = publish
            records = encode(maxima, "adi_flight_record_number")
            topics.publish(records, topic, name=f"{query}-{number}" if topics.takes_names else None)

    query = (
        _maxima_of(stream, keys, window, delay)
        .writeStream.outputMode("update")
        .foreachBatch(take_in)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    try:
        query.awaitTermination()
    finally:
        delete_folder(spark, path)
    table.merge_held(str(query.id))
    done = Drained()
    for progress in query.recentProgress:
        for state in progress["stateOperators"]:
            done.late_rows += state["numRowsDroppedByWatermark"]
            done.state_groups = state["numRowsTotal"]
        done.batches += 1
    return done


def latest_maxima(records: DataFrame) -> DataFrame:
    """The result from a topic to which drains sent their maxima."""
    rows = decode(drop_tombstones(records), RESULT)
    return rows.groupBy(*RESULT_KEYS).agg(F.max("MaxOffset").alias("MaxOffset"))
