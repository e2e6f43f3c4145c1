"""Landing, drain by drain."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from flightloom.plans.landing import (
    clear_staging,
    create_landing_tables,
    fill_parts,
    stage,
    staged_rows,
)


def land_topic(
    stream: DataFrame,
    table: str,
    rejects: str,
    staging: str,
    checkpoint: str,
    create: bool = True,
    location: str | None = None,
    accounts: str | None = None,
) -> None:
    """Lands what the stream has not delivered yet in two tables, and returns.

    ``accounts`` names a table of counts, one set per batch: see ``stage``.

    Tables carry the name of the batch, made of the query's id and the batch number, as
    last column and partition. The id stays with the checkpoint, so a batch that is tried
    again writes its own partition again, and other topics or checkpoints never write it.
    A new checkpoint lands the topic once more. With ``create`` the tables must not exist
    yet; later drains pass ``create=False``.
    """
    spark: SparkSession = stream.sparkSession
    if create:
        create_landing_tables(
            spark, table, rejects, location, by_batch=True, accounts=accounts
        )

    def land(batch: DataFrame, number: int) -> None:
        # Spark sets the id, which a restart on the same checkpoint keeps.
        query_id = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        path = f"{staging}/{query_id}"
        counts = stage(batch, path)
        staged = staged_rows(batch.sparkSession, path)
        fill_parts(staged, counts, table, rejects, f"{query_id}-{number}", accounts)
        clear_staging(batch.sparkSession, path)

    query = (
        stream.writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
