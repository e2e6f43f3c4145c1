"""Land result records in a clean table, with the refused ones in a second table.

All forms go the same way: records are decoded once into a staging table, which counts them
in the same pass, and both tables are filled from there, part by part. A part has a name, under
which a landing that died is run again and leaves no row twice.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from flightloom.functions import decode_nested
from flightloom.operators import drop_tombstones, reason_counts, with_reject_reason
from flightloom.schemas import ACCOUNT, LANDED, REJECTED, REJECTED_LINE, RESULT
from flightloom.sources.csv_files import parsed_line, read_lines
from flightloom.sources.tables import append_rows, create_table

# Extra last column of tables that are filled part by part: what names the part.
BATCH = "drain_batch"


class Miscounted(RuntimeError):
    """Records that were read did not all end as kept, refused or skipped."""


def create_landing_tables(
    spark: SparkSession,
    table: str,
    rejects: str,
    location: str | None = None,
    by_batch: bool = False,
    accounts: str | None = None,
    rejected: StructType = REJECTED,
) -> None:
    """The tables, new; fails if one exists. ``accounts`` is always filled by parts."""
    wanted = [(table, LANDED, by_batch), (rejects, rejected, by_batch)]
    wanted += [(accounts, ACCOUNT, True)] if accounts else []
    for name, schema, parts in wanted:
        if parts:
            schema = StructType([*schema.fields, StructField(BATCH, StringType())])
        create_table(
            spark,
            name,
            schema,
            location and f"{location}/{name}",
            [BATCH] if parts else [],
        )


def _staged_type(rejected: StructType) -> StructType:
    record = StructType([f for f in rejected if f.name != "reject_reason"])
    return StructType(
        [*LANDED.fields, rejected["reject_reason"], StructField("record", record)]
    )


def _write_staged(checked: DataFrame, path: str, read: Observation | None) -> dict[str, int]:
    """Writes decoded rows with the reason if refused; returns how many there are of each kind.

    No executor has to hold a row, and a lost one costs only its own tasks. Kept rows do not
    carry their record, and file statistics let the refused rows be found without reading the
    rest. The counts are taken as the rows go by.
    """
    passed = Observation()
    reason = F.col("reject_reason")
    counted = checked.observe(
        passed,
        F.count(F.when(reason.isNull(), 1)).alias("kept"),
        F.count(reason).alias("refused"),
        *reason_counts(reason),
    )
    record = F.when(reason.isNotNull(), F.col("record")).alias("record")
    staged = counted.select(*LANDED.names, "reject_reason", record)
    staged.write.mode("overwrite").option("compression", "zstd").parquet(path)
    counts = dict(passed.get)
    before = read.get if read else {"read": counts["kept"] + counts["refused"], "skipped": 0}
    counts = {"read": before["read"], "skipped": before["skipped"], **counts}
    if counts["kept"] + counts["refused"] + counts["skipped"] != counts["read"]:
        raise Miscounted(str(counts))
    return counts


def stage(records: DataFrame, path: str) -> dict[str, int]:
    """Decodes topic records once and writes them to ``path``; returns the counts.

    Those are ``read``, ``skipped`` (tombstones), ``kept``, ``refused`` and ``refused_...`` per
    reason, of which a record may have several. In one pass: the payload is parsed once.
    """
    read = Observation()
    payload = F.col("value")
    seen = records.observe(
        read,
        F.count(F.lit(1)).alias("read"),
        F.count(F.when(payload.isNull(), 1)).alias("skipped"),
    )
    return _write_staged(
        with_reject_reason(decode_nested(drop_tombstones(seen), RESULT)), path, read
    )


def stage_csv(spark: SparkSession, spool: str, path: str) -> dict[str, int]:
    """The same for the lines of spooled CSV files, each parsed once; none is skipped."""
    lines = read_lines(spark, spool, RESULT)
    nested = lines.select(
        F.struct("line").alias("record"), parsed_line("line", RESULT).alias("data")
    )
    return _write_staged(with_reject_reason(nested), path, None)


def staged_rows(spark: SparkSession, path: str, rejected: StructType = REJECTED) -> DataFrame:
    return spark.read.schema(_staged_type(rejected)).parquet(path)


def kept_rows(staged: DataFrame) -> DataFrame:
    return staged.where(F.col("reject_reason").isNull()).select(*LANDED.names)


def refused_rows(staged: DataFrame) -> DataFrame:
    return staged.where(F.col("reject_reason").isNotNull()).select("reject_reason", "record.*")


def clear_staging(spark: SparkSession, path: str) -> None:
    """Leaves an empty table where rows were staged."""
    empty = spark.createDataFrame([], staged_rows(spark, path).schema)
    empty.write.mode("overwrite").parquet(path)


def replace_part(rows: DataFrame, table: str, part: str | int) -> None:
    """Fills one part of a table, replacing what a failed try left there."""
    spark = rows.sparkSession
    columns = [c for c in spark.table(table).columns if c != BATCH]
    if not re.fullmatch(r"[A-Za-z0-9._-]+", str(part)):
        raise ValueError(f"not a name for a part: {part!r}")
    spark.sql(
        f"INSERT OVERWRITE TABLE IDENTIFIER(:table) PARTITION ({BATCH} = '{part}') "
        f"SELECT {', '.join(f'`{c}`' for c in columns)} FROM {{rows}}",
        args={"table": table},
        rows=rows,
    )


def account_rows(spark: SparkSession, counts: dict[str, int]) -> DataFrame:
    """The counts as rows; ``read`` is the sum of ``skipped``, ``kept`` and ``refused``."""
    pairs: list[Column] = [
        F.struct(F.lit(m).alias("measure"), F.lit(n).cast("bigint").alias("n"))
        for m, n in counts.items()
    ]
    return spark.range(1).select(F.inline(F.array(*pairs)))


def fill_parts(
    staged: DataFrame,
    counts: dict[str, int],
    table: str,
    rejects: str,
    part: str,
    accounts: str | None = None,
) -> None:
    """One part of every table; the account comes last, so a part that has one is whole."""
    replace_part(kept_rows(staged), table, part)
    replace_part(refused_rows(staged), rejects, part)
    if accounts:
        replace_part(account_rows(staged.sparkSession, counts), accounts, part)


def land_batch(
    records: DataFrame,
    table: str,
    rejects: str,
    staging: str,
    load: str | None = None,
    accounts: str | None = None,
) -> dict[str, int]:
    """Lands records in the landing tables, which exist, in two bulk inserts; returns counts.

    Every record but tombstones ends in exactly one of the tables. ``load`` names this
    load; tables made with ``by_batch`` hold it as a part, so a load that died is run again
    under its name and leaves no row twice. Without a name rows are appended, and a load
    that died between the two inserts must not be run again.
    """
    if accounts and load is None:
        raise ValueError("only a named load can be accounted for")
    counts = stage(records, staging)
    staged = staged_rows(records.sparkSession, staging)
    if load is None:
        append_rows(kept_rows(staged), table)
        append_rows(refused_rows(staged), rejects)
    else:
        fill_parts(staged, counts, table, rejects, load, accounts)
    clear_staging(records.sparkSession, staging)
    return counts


def land_csv(
    spark: SparkSession,
    path: str,
    table: str,
    rejects: str,
    staging: str,
    load: str,
    accounts: str | None = None,
) -> dict[str, int]:
    """Lands result rows spooled as CSV as the part ``load`` of the tables; returns counts.

    The tables exist and were made with ``by_batch``; the one of refused lines has the columns
    of ``REJECTED_LINE``: a refused line keeps its text and its reasons. Each line is parsed
    once. A landing that died is run again under its name.
    """
    counts = stage_csv(spark, path, staging)
    staged = staged_rows(spark, staging, REJECTED_LINE)
    fill_parts(staged, counts, table, rejects, load, accounts)
    clear_staging(spark, staging)
    return counts
