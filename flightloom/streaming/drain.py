"""Incremental drain of a topic: what is new since the last drain, then stop."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, StructField, StructType

from flightloom.functions import decode
from flightloom.operators import drop_tombstones
from flightloom.schemas import MESSAGE
from flightloom.session import delete_folder, file_exists


def drain(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Appends what the stream has not delivered yet to parquet files, and returns.

    The position lies in the checkpoint, and the file sink commits each batch in
    its log, so a drain that is repeated or killed neither loses nor doubles rows.
    """
    query = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def drain_typed(
    stream: DataFrame, schema: StructType, path: str, checkpoint: str
) -> DataFrame:
    """Drains topic records as typed rows with the broker time; returns all drained."""
    spark = stream.sparkSession
    drain(decode(drop_tombstones(stream), schema), path, checkpoint)
    drained = StructType([*schema.fields, StructField("timestamp", MESSAGE["timestamp"].dataType)])
    return spark.read.schema(drained).parquet(path)


# What makes two records of a topic the same, if they were published twice; and if a reader
# got them twice.
CONTENT, POSITION = ("topic", "key", "value"), ("topic", "partition", "offset")


def _digest(identity: Sequence[str]) -> Column:
    texts = [F.coalesce(F.hex(F.col(c).cast("string").cast("binary")), F.lit("-")) for c in identity]
    return F.unhex(F.sha2(F.concat_ws(",", *texts), 256))


def unique_stream(
    stream: DataFrame, within: str = "7 days", identity: Sequence[str] = CONTENT
) -> DataFrame:
    """Each record once, if its copies come ``within`` that time of broker time.

    The state holds a digest per record of that time, not the record; the watermark lets go of
    older ones. A copy that comes later is taken for a new record, one more than that time
    behind the newest record is dropped.
    """
    return (
        stream.withColumn("_record", _digest(identity))
        .withWatermark("timestamp", within)
        .dropDuplicatesWithinWatermark(["_record"])
        .drop("_record")
    )


class _UniqueRecords:
    """The records that drains on one checkpoint found to be new, batch by batch, in files.

    They take the place of the state of ``unique_stream``: a batch meets the digests of the
    records before it in a join, which needs no more memory the more there are. A batch that
    is done again replaces its own files.
    """

    _STORED = StructType(
        [
            StructField("_record", BinaryType()),
            StructField("value", BinaryType()),
            StructField("timestamp", MESSAGE["timestamp"].dataType),
            StructField("batch", IntegerType()),
        ]
    )

    def __init__(
        self, spark: SparkSession, checkpoint: str, within: str, identity: Sequence[str]
    ) -> None:
        self.spark = spark
        self.root, self._newest = f"{checkpoint}/unique", f"{checkpoint}/newest"
        self.identity = identity
        after = F.timestamp_micros(F.lit(0)) + F.expr(f"interval '{within}'")
        self.within = spark.range(1).select(F.unix_micros(after)).first()[0]
        if self.within < 0:
            raise ValueError(f"not a time that copies may come within: {within!r}")
        # Of this drain.
        self._last: int | None = None
        # A stream needs its folder; nothing is written if there is one already.
        empty = spark.createDataFrame([], StructType(self._STORED.fields[:-1]))
        empty.write.mode("ignore").parquet(f"{self.root}/batch=-1")

    def newest(self, number: int) -> int | None:
        """The newest time that a record had up to that batch, in microseconds."""
        path = f"{self._newest}/batch={number}"
        if number < 0 or not file_exists(self.spark, path):
            return None
        return self.spark.read.schema("newest long").parquet(path).first()[0]

    def take_in(self, batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        # Not observed beside the write: a plan that is found to be empty loses what it observed.
        times = [batch.agg(F.max(F.unix_micros("timestamp"))).first()[0], self.newest(number - 1)]
        records = batch.select(_digest(self.identity).alias("_record"), "value", "timestamp")
        known = spark.read.schema(self._STORED).parquet(self.root).where(F.col("batch") < number)
        # As with a state store: the first batch of a drain meets the watermark of all before
        # it, a further one that of the batch before it.
        newest = self.newest(number - 1 if self._last is None else number - 2)
        if newest is not None:
            # Watermarks are in milliseconds.
            watermark = newest // 1000 * 1000 - self.within
            late = F.col("timestamp") <= F.timestamp_micros(F.lit(watermark))
            records = records.where(~F.coalesce(late, F.lit(False)))
            known = known.where(
                F.col("timestamp") > F.timestamp_micros(F.lit(watermark - self.within))
            )
        new = (
            records.repartition("_record")
            .join(known.select("_record"), "_record", "left_anti")
            .dropDuplicates(["_record"])
        )
        writer = new.write.mode("overwrite").option("compression", "zstd")
        writer.parquet(f"{self.root}/batch={number}")
        newest = max((t for t in times if t is not None), default=None)
        held = spark.createDataFrame([(newest,)], "newest long").coalesce(1)
        held.write.mode("overwrite").parquet(f"{self._newest}/batch={number}")
        self._last = number

    def read_stream(self) -> DataFrame:
        return (
            self.spark.readStream.schema(self._STORED)
            # Else files a week older than the newest one would be passed over.
            .option("maxFileAge", "36500d")
            .parquet(self.root)
        )

    def forget_old(self) -> None:
        """Deletes batches of which no record can have copies any more; all must be drained."""
        if self._last is None:
            return
        newest = self.newest(self._last)
        if newest is None:
            return
        limit = newest // 1000 * 1000 - 2 * self.within
        batches = self.spark.read.schema("newest long, batch int").parquet(self._newest)
        old = batches.where((F.col("newest") <= limit) & (F.col("batch") < self._last))
        for number in [row.batch for row in old.collect()]:
            delete_folder(self.spark, f"{self.root}/batch={number}")
            delete_folder(self.spark, f"{self._newest}/batch={number}")


def drain_unique(
    stream: DataFrame,
    schema: StructType,
    path: str,
    checkpoint: str,
    within: str = "7 days",
    identity: Sequence[str] = CONTENT,
) -> DataFrame:
    """As ``drain_typed``, with records that were published again drained once.

    What ``unique_stream`` gives, with the digests in files beside the checkpoint instead of a
    state store, so that copies are found across drains, too, and any number of records fits.
    A checkpoint that was begun with a state store goes on with it.
    """
    spark = stream.sparkSession
    if file_exists(spark, f"{checkpoint}/state"):
        return drain_typed(unique_stream(stream, within, identity), schema, path, checkpoint)
    unique = _UniqueRecords(spark, checkpoint, within, identity)
    query = (
        stream.writeStream.foreachBatch(unique.take_in)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    drained = drain_typed(unique.read_stream(), schema, path, f"{checkpoint}/drained")
    unique.forget_old()
    return drained
