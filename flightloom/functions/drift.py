"""What payloads hold beside, or instead of, the fields that a schema declares."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

COUNTS = ("n_present", "n_lacking", "n_null", "n_unreadable")
# What a payload makes of a declared field.
READABLE, LACKING, NULL, UNREADABLE = range(4)


def payload_drift(records: DataFrame, schema: StructType) -> DataFrame:
    """One row per field: how often it is there, lacking, NULL or of another type.

    Columns: ``field``, ``declared``, ``n_present``, ``n_lacking``, ``n_null`` (a JSON null),
    ``n_unreadable`` (not NULL, but decodes to NULL). Fields that the schema does not have are
    not ``declared``, and are nowhere lacking; names differ if their case does. The row without
    a field counts payloads: those that are JSON objects as present, others as unreadable.
    Tombstones are not looked at.

    A payload is parsed once, to a VARIANT, and the source is read once. Payloads are counted by
    the fields they have beside the declared ones; only these counts become rows per field.
    """
    text = F.col("value").cast("string")
    # No filter on the text, which Spark would push below what makes it, and make it twice.
    parsed = records.select(
        text.isNotNull().alias("alive"),
        F.try_parse_json(text).try_cast("map<string, variant>").alias("fields"),
        F.from_json(text, schema).alias("data"),
    )
    states = []
    for f in schema:
        # A value that is not there is no JSON null either.
        value = F.element_at("fields", F.lit(f.name))
        states.append(
            F.when(F.col("fields").isNull(), None)
            .when(value.isNull(), LACKING)
            .when(F.is_variant_null(value), NULL)
            .when(F.col("data")[f.name].isNull(), UNREADABLE)
            .otherwise(READABLE)
        )
    names = F.array(*[F.lit(n) for n in schema.names])
    extra = F.array_except(F.map_keys("fields"), names)
    extra = F.when(
        F.size(extra) > 0,
        F.transform(
            extra,
            lambda name: F.struct(
                name.alias("field"), F.is_variant_null(F.element_at("fields", name)).alias("null")
            ),
        ),
    )
    told = parsed.select(
        "alive",
        F.col("fields").isNotNull().alias("is_object"),
        extra.alias("extra"),
        *[s.alias(f"state_{i}") for i, s in enumerate(states)],
    )

    # A row that counts as nothing, so that there are counts of no payloads, too.
    flags = ("alive", "is_object")
    nothing = records.sparkSession.range(1).select(
        *[F.lit(False if f.name in flags else None).cast(f.dataType).alias(f.name) for f in told.schema]
    )

    def count(condition: Column) -> Column:
        return F.count(F.when(condition, 1))

    def counts(state: str) -> list[Column]:
        at = F.col(state)
        return [count(at != LACKING), *[count(at == s) for s in (LACKING, NULL, UNREADABLE)]]

    of_each = [
        each.alias(f"n_{i}_{name}")
        for i in range(len(schema))
        for each, name in zip(counts(f"state_{i}"), COUNTS)
    ]
    by_extra = told.unionByName(nothing).groupBy("extra").agg(
        count(F.col("is_object")).alias("n_objects"),
        count(F.col("alive") & ~F.col("is_object")).alias("n_broken"),
        *of_each,
    )
    none = F.lit(0).cast("bigint")

    def line(field: Column, declared: bool, *numbers: Column) -> Column:
        named = [n.alias(name) for n, name in zip(numbers, COUNTS)]
        return F.struct(field.cast("string").alias("field"), F.lit(declared).alias("declared"), *named)

    declared = [
        line(F.lit(f.name), True, *[F.col(f"n_{i}_{name}") for name in COUNTS])
        for i, f in enumerate(schema)
    ]
    broken = line(F.lit(None), False, F.col("n_objects"), none, none, F.col("n_broken"))
    unknown = F.coalesce("extra", F.array().cast("array<struct<field: string, null: boolean>>"))
    unknown = F.transform(
        unknown,
        lambda e: line(
            e.getField("field"), False, F.col("n_objects"), none,
            F.when(e.getField("null"), F.col("n_objects")).otherwise(none), none,
        ),
    )
    lines = by_extra.select(F.inline(F.concat(F.array(*declared, broken), unknown)))
    return lines.groupBy("field", "declared").agg(*[F.sum(name).alias(name) for name in COUNTS])
