"""A table of largest offsets that is kept up to date, bucket by bucket.

Result groups are dealt to a fixed number of buckets by a hash of their keys. A merge writes a
new version of the buckets whose groups it changes, and one small file that names these
versions; the others keep their files. Readers see the versions that such a file names, so a
merge that dies has no effect, and one that is run again adds nothing: a maximum of maxima is
the same however often a part of it comes in. One merge may run at a time.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from flightloom.operators.relational import RESULT_KEYS
from flightloom.schemas import RESULT
from flightloom.session import delete_folder, file_exists, shared_path

_COMMIT = StructType(
    [
        StructField("number", LongType()),
        StructField("bucket", IntegerType()),
        StructField("version", StringType()),
    ]
)


class MaximumTable:
    """Layout: ``<root>/of=<buckets>/version=<name>/bucket=<b>/`` and ``<root>/.../commits/``.

    The number of buckets stays with the table: opened with another one it is another table.
    It bounds what a merge writes for one changed group, a bucket's worth, and what the driver
    holds: a version per bucket.
    """

    def __init__(self, spark: SparkSession, root: str, buckets: int = 64) -> None:
        self.spark = spark
        self.buckets = buckets
        self.root = f"{root.rstrip('/')}/of={buckets}"

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*RESULT_KEYS), F.lit(self.buckets)).cast("int").alias("bucket")

    def _commits(self) -> DataFrame:
        if not file_exists(self.spark, f"{self.root}/commits"):
            return self.spark.createDataFrame([], _COMMIT)
        return self.spark.read.schema(_COMMIT).parquet(f"{self.root}/commits")

    def versions(self) -> dict[int, str]:
        """The current version of each bucket that has rows."""
        last = F.max_by("version", "number").alias("version")
        return {r.bucket: r.version for r in self._commits().groupBy("bucket").agg(last).collect()}

    def _folder(self, bucket: int, version: str) -> str:
        return f"{self.root}/version={version}/bucket={bucket}"

    def _rows(self, versions: dict[int, str]) -> DataFrame:
        folders = [self._folder(b, v) for b, v in versions.items()]
        if not folders:
            return self.spark.createDataFrame([], RESULT)
        return self.spark.read.schema(RESULT).parquet(*folders)

    def read(self) -> DataFrame:
        return self._rows(self.versions())

    def merge(self, partial: DataFrame) -> list[int]:
        """Takes in result rows, of which a group may have several; returns changed buckets.

        Only buckets that the rows fall in are read, and only those in which a group is new or
        has a larger maximum are written.
        """
        best = partial.groupBy(*RESULT_KEYS).agg(F.max("MaxOffset").alias("MaxOffset"))
        name = uuid.uuid4().hex
        fresh = shared_path(self.spark, "maxima")
        best.select(*RESULT.names).write.option("compression", "zstd").parquet(fresh)
        best = self.spark.read.schema(RESULT).parquet(fresh)
        versions = self.versions()
        met = {r.bucket for r in best.select(self._bucket()).distinct().collect()}
        known = self._rows({b: v for b, v in versions.items() if b in met})

        both = known.withColumn("old", F.lit(True)).unionByName(best.withColumn("old", F.lit(False)))
        known_max = F.max(F.when(F.col("old"), F.col("MaxOffset")))
        groups = both.groupBy(*RESULT_KEYS).agg(
            F.max("MaxOffset").alias("MaxOffset"),
            # A NULL maximum is one, too: a group that was there and still has none is the same.
            (F.bool_or("old") & F.max("MaxOffset").eqNullSafe(known_max)).alias("same"),
        )
        merged = shared_path(self.spark, "merged")
        groups.withColumn("bucket", self._bucket()).write.option("compression", "zstd").parquet(merged)
        groups = self.spark.read.schema(groups.withColumn("bucket", self._bucket()).schema).parquet(merged)
        changed = [
            r.bucket for r in groups.filter("not same").select("bucket").distinct().collect()
        ]
        if changed:
            rows = groups.filter(F.col("bucket").isin(changed)).select(*RESULT.names, "bucket")
            rows.hint("rebalance", "bucket").write.partitionBy("bucket").option(
                "compression", "zstd"
            ).parquet(f"{self.root}/version={name}")
            self._commit(name, changed)
        delete_folder(self.spark, merged)
        delete_folder(self.spark, fresh)
        return sorted(changed)

    def _held(self, owner: str) -> str:
        return f"{self.root}/held/{owner}"

    def hold(self, maxima: DataFrame, owner: str, number: int) -> DataFrame:
        """Keeps result rows beside the table until ``merge_held``; returns them as written.

        Rows that are held again under their number replace what was there.
        """
        path = f"{self._held(owner)}/number={number}"
        maxima.select(*RESULT.names).write.mode("overwrite").option("compression", "zstd").parquet(path)
        return self.spark.read.schema(RESULT).parquet(path)

    def merge_held(self, owner: str) -> list[int]:
        """Merges all that the owner holds, at once. One that dies is done again without harm."""
        if not file_exists(self.spark, self._held(owner)):
            return []
        rows = self.spark.read.schema(RESULT).parquet(f"{self._held(owner)}/number=*")
        changed = self.merge(rows)
        delete_folder(self.spark, self._held(owner))
        return changed

    def _commit(self, version: str, buckets: list[int]) -> None:
        """One file, which is there as a whole or not at all."""
        number = (self._commits().agg(F.max("number")).first()[0] or 0) + 1
        rows = self.spark.range(1).select(
            F.lit(number).cast("bigint").alias("number"),
            F.explode(F.array(*[F.lit(b) for b in buckets])).alias("bucket"),
            F.lit(version).alias("version"),
        )
        rows.coalesce(1).write.mode("append").parquet(f"{self.root}/commits")

    def forget_old(self) -> int:
        """Deletes versions of buckets that no reader finds any more; returns how many.

        Not while another session reads the table.
        """
        current = set(self.versions().items())
        rows = self._commits().select("bucket", "version").distinct().collect()
        old = [(r.bucket, r.version) for r in rows if (r.bucket, r.version) not in current]
        gone = [folder for b, v in old if file_exists(self.spark, folder := self._folder(b, v))]
        for folder in gone:
            delete_folder(self.spark, folder)
        return len(gone)
