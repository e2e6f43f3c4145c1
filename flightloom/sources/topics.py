"""Topics: append-only tables of keyed records, in Kafka or in a shared folder.

Both backends return the columns of Spark's Kafka source (``schemas.RECORD``), take
frames with ``key`` and ``value``, and deliver at least once: a publish that is run
again appends its records again, and a batch read returns the whole topic. File topics also
take a name for a publish, under which it may be run again and is read once.
"""

from __future__ import annotations

import re
import uuid
import warnings
from datetime import datetime
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from flightloom.schemas import RECORD
from flightloom.session import file_exists


# Of topic files, so that reading a topic is parallel whatever published it.
ROW_GROUP_BYTES = 16 << 20


class Topics(Protocol):
    # Whether a publish may have a name.
    takes_names: bool

    def publish(self, records: DataFrame, *topics: str, name: str | None = None) -> None:
        """Appends the records to every named topic, reading their source once."""

    def read(self, *topics: str, since: datetime | None = None) -> DataFrame:
        """All records of the topics, or those the broker got at that time or later."""

    def read_stream(
        self, *topics: str, since: datetime | None = None, **options: str
    ) -> DataFrame:
        """The records as a stream, from the first one on, or from that time on."""


def _named(topics: tuple[str, ...]) -> None:
    if not topics or len(set(topics)) < len(topics):
        raise ValueError(f"name one or more different topics, not {topics}")


def _key_and_value(records: DataFrame) -> DataFrame:
    return records.select(
        F.col("key").cast("binary").alias("key"), F.col("value").cast("binary").alias("value")
    )


def _named_parts(records: DataFrame) -> DataFrame:
    """The connector's columns with the partition as text, as ``schemas.RECORD`` has it."""
    return records.withColumn("partition", F.col("partition").cast("string"))


class KafkaTopics:
    """Topics of a Kafka cluster; needs the Spark Kafka connector on the class path."""

    takes_names = False
    # Client settings a Spark job can pass on, once they carry the "kafka." prefix.
    CLIENT_SETTINGS = ("isolation.level", "enable.idempotence")
    # Settings the Spark connector manages itself, or cannot honour: positions belong to
    # the checkpoint or to startingOffsets, and the sink opens no transactions.
    UNSUPPORTED = (
        "enable.auto.commit",
        "auto.commit.enable",
        "auto.offset.reset",
        "transactional.id",
    )

    def __init__(
        self,
        spark: SparkSession,
        servers: str,
        read_options: dict[str, str] | None = None,
        write_options: dict[str, str] | None = None,
    ) -> None:
        self.spark = spark
        self.servers = servers
        self._read = self.connector_options(read_options or {})
        self._write = self.connector_options(write_options or {})

    @classmethod
    def connector_options(cls, options: dict[str, str]) -> dict[str, str]:
        """Spells client settings as the connector reads them; drops what it cannot do."""
        result = {}
        for name, value in options.items():
            bare = name.removeprefix("kafka.")
            if bare in cls.UNSUPPORTED:
                warnings.warn(f"{name} has no effect in a Spark job, left out", stacklevel=3)
            elif bare in cls.CLIENT_SETTINGS:
                result[f"kafka.{bare}"] = value
            else:
                result[name] = value
        return result

    def source_options(self, *topics: str) -> dict[str, str]:
        _named(topics)
        return {
            **self._read,
            "kafka.bootstrap.servers": self.servers,
            "subscribe": ",".join(topics),
        }

    def sink_options(self) -> dict[str, str]:
        return {**self._write, "kafka.bootstrap.servers": self.servers}

    def publish(self, records: DataFrame, *topics: str, name: str | None = None) -> None:
        _named(topics)
        if name is not None:
            raise ValueError("a Kafka topic keeps no names of publishes")
        each = F.explode(F.array(*[F.lit(topic) for topic in topics]))
        rows = _key_and_value(records).withColumn("topic", each)
        rows.write.format("kafka").options(**self.sink_options()).save()

    @staticmethod
    def start_options(since: datetime | None) -> dict[str, str]:
        """Where reading starts; partitions without a later record give none."""
        if since is None:
            return {}
        return {
            "startingTimestamp": str(int(since.timestamp() * 1000)),
            "startingOffsetsByTimestampStrategy": "latest",
        }

    def read(self, *topics: str, since: datetime | None = None) -> DataFrame:
        options = {**self.source_options(*topics), **self.start_options(since)}
        return _named_parts(self.spark.read.format("kafka").options(**options).load())

    def read_stream(
        self, *topics: str, since: datetime | None = None, **options: str
    ) -> DataFrame:
        options = {
            "startingOffsets": "earliest",
            **self.source_options(*topics),
            **self.start_options(since),
            **self.connector_options(options),
        }
        return _named_parts(self.spark.readStream.format("kafka").options(**options).load())


class FileTopics:
    """Topics as parquet files below a folder that all executors share.

    Layout: ``<root>/topic=<name>/partition=<publish>/*.parquet``. Every publish has a
    name, a fresh one if none is given, and numbers its rows without a shuffle, so
    ``(topic, partition, offset)`` is unique, though offsets have gaps. Readers list only the
    folders of the topics they name; the driver lists one folder per publish.

    A publish that ended is not done again under its name, so that neither a batch read nor a
    stream sees its records twice. One that died is: what it left is replaced. A stream that
    drains while a publish dies may have taken some of its files; see ``drain_unique``.
    """

    takes_names = True
    # What a stream of files understands; others would be passed over in silence.
    STREAM_OPTIONS = (
        "maxFilesPerTrigger",
        "maxBytesPerTrigger",
        "maxFileAge",
        "maxCachedFiles",
        "latestFirst",
        "cleanSource",
        "sourceArchiveDir",
    )
    _STORED = StructType([f for f in RECORD if f.name not in ("topic", "partition")])

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = root.rstrip("/")

    @staticmethod
    def _checked(name: str) -> str:
        if not re.fullmatch(r"[A-Za-z0-9._-]+", name):
            raise ValueError(f"not a name for a topic or a publish: {name!r}")
        return name

    def _folder(self, topic: str) -> str:
        return f"{self.root}/topic={self._checked(topic)}"

    def publish(self, records: DataFrame, *topics: str, name: str | None = None) -> None:
        _named(topics)
        rows = _key_and_value(records).select(
            "key",
            "value",
            F.monotonically_increasing_id().alias("offset"),
            F.current_timestamp().alias("timestamp"),
            F.lit(0).alias("timestampType"),
        )
        # A folder of its own, so that publishers cannot meet in one. Further topics are
        # copied from the first, so that the source is read once.
        name = uuid.uuid4().hex if name is None else self._checked(name)
        first, *others = [f"{self._folder(topic)}/partition={name}" for topic in topics]
        self._write(rows, first)
        for other in others:
            self._write(self.spark.read.schema(self._STORED).parquet(first), other)

    def _write(self, rows: DataFrame, path: str) -> None:
        if file_exists(self.spark, f"{path}/_SUCCESS"):
            return
        # JSON text takes half the space in zstd that it takes in the default, snappy. Small
        # row groups let many tasks read one file back.
        writer = rows.write.mode("overwrite").option("compression", "zstd")
        writer.option("parquet.block.size", ROW_GROUP_BYTES).parquet(path)

    @staticmethod
    def _from(records: DataFrame, since: datetime | None) -> DataFrame:
        return records if since is None else records.where(F.col("timestamp") >= F.lit(since))

    def read(self, *topics: str, since: datetime | None = None) -> DataFrame:
        _named(topics)
        folders = [self._folder(topic) for topic in topics]
        records = (
            self.spark.read.schema(RECORD)
            .option("basePath", self.root)
            .parquet(*folders)
            .select(*RECORD.names)
        )
        return self._from(records, since)

    def read_stream(
        self, *topics: str, since: datetime | None = None, **options: str
    ) -> DataFrame:
        _named(topics)
        unknown = set(options) - set(self.STREAM_OPTIONS)
        if unknown:
            raise ValueError(f"file topics have no options {sorted(unknown)}")
        streams = [self._stream(topic, options) for topic in topics]
        result = streams[0]
        for stream in streams[1:]:
            result = result.unionByName(stream)
        return self._from(result, since)

    def _stream(self, topic: str, options: dict[str, str]) -> DataFrame:
        # A stream needs its folder; nothing is written if there is one already.
        stored = StructType([*self._STORED.fields, RECORD["partition"]])
        empty = self.spark.createDataFrame([], self._STORED)
        empty.write.mode("ignore").parquet(f"{self._folder(topic)}/partition=none")
        return (
            self.spark.readStream.schema(stored)
            # Else files a week older than the newest one would be passed over.
            .option("maxFileAge", "36500d")
            .options(**options)
            .parquet(self._folder(topic))
            .withColumn("topic", F.lit(topic))
            .select(*RECORD.names)
        )
