"""Encoding by a vocabulary that is a table, for columns with any number of levels.

Levels get their vector slots from running totals over the sorted levels, stay in the shared
folder, and meet the rows in a join. Per column the driver holds a mode, a size and an offset;
no list of levels reaches it. Small vocabularies are broadcast by the optimizer's own size check,
large ones are joined by shuffle, where adaptive execution splits a frequent level.

The vector is a sparse one. It is written as its four fields and read back under MLlib's vector
type, so no Python touches a row.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, functions as F, types as T

from riskloom.functions import sqltext
from riskloom.operators import counts, encoding
from riskloom.operators.running import running_totals
from riskloom.schema import CATEGORICAL_FEATURES, NUMERIC_FEATURES
from riskloom.session import scratch_path, settle, stored


@dataclass(frozen=True)
class TableEncoding:
    """Fitted numbers per column, and the stored vocabulary ``(feature, value, n, slot)``."""

    numeric: dict[str, tuple[float, float, float]]  # median, mean, scale
    modes: dict[str, str]
    size: int
    levels: DataFrame

    @property
    def names(self) -> DataFrame:
        """``(idx, name)`` of the vector slots, as a table."""
        spark = self.levels.sparkSession
        numbers = spark.createDataFrame(
            [(i, f"num__{c}") for i, c in enumerate(self.numeric)], "idx int, name string"
        )
        named = F.concat(F.lit("cat__"), "feature", F.lit("_"), "value")
        return numbers.unionAll(self.levels.select(F.col("slot").alias("idx"), named.alias("name")))


def fit(
    df: DataFrame, numeric: Iterable[str] = NUMERIC_FEATURES, categorical: Iterable[str] = CATEGORICAL_FEATURES,
    exact: bool = True,
) -> TableEncoding:
    """Learn medians, means, scales, modes and the vocabulary of ``df``."""
    numeric, categorical = list(numeric), list(categorical)
    learned = {}
    if numeric:
        for r in encoding.scaling_table(df, numeric, exact).collect():  # one row per column
            learned[r["feature"]] = (r["median"], r["mean"], r["scale"])
    numbers = {c: learned.get(c, (0.0, 0.0, 1.0)) for c in numeric}
    found = settle(counts.text_counts(df, categorical))
    # One row per column: the most frequent level, the smallest on ties, and how many there are.
    best = F.min(F.struct((-F.col("n")).alias("n"), F.col("value"))).alias("best")
    columns = {r["feature"]: r for r in found.groupBy("feature").agg(best, F.count(F.lit(1)).alias("levels")).collect()}
    offset, at = {}, len(numeric)
    for c in categorical:
        if c in columns:
            offset[c] = at
            at += columns[c]["levels"]
    placed = running_totals(found.withColumn("one", F.lit(1).cast("bigint")), "value", ["one"], ["feature"])
    begin = F.expr("CASE feature " + " ".join(f"WHEN {sqltext.value(c)} THEN {o}" for c, o in offset.items()) + " END") if offset else F.lit(0)
    slots = placed.select("feature", "value", "n", (begin + F.col("cum_one") - 1).cast("int").alias("slot"))
    return TableEncoding(
        numbers, {c: columns[c]["best"]["value"] for c in categorical if c in columns}, at,
        stored(slots, "vocabulary"),
    )


def entries(encoder: TableEncoding, df: DataFrame, keep: Iterable[str] = ()) -> DataFrame:
    """Kept columns and ``vector``: the fields of a sparse vector.

    A missing category counts as the column's mode, a level that was not learned has no entry.
    """
    keep = list(keep)
    scaled = [
        f"(coalesce(nanvl(CAST({sqltext.name(c)} AS DOUBLE), NULL), {median!r}D) - {mean!r}D) / {scale!r}D"
        for c, (median, mean, scale) in encoder.numeric.items()
    ]
    cells = {
        f"_cell_{i}": f"coalesce(CAST({sqltext.name(c)} AS STRING), {sqltext.value(mode)})"
        for i, (c, mode) in enumerate(encoder.modes.items())
    }
    rows = df.select(
        *[F.col(c) for c in keep], F.expr(f"array({', '.join(scaled)})").cast("array<double>").alias("_numbers"),
        *[F.expr(e).alias(name) for name, e in cells.items()],
    )
    for i, c in enumerate(encoder.modes):
        own = encoder.levels.filter(F.col("feature") == c)
        own = own.select(F.col("value").alias(f"_level_{i}"), F.col("slot").alias(f"_slot_{i}"))
        rows = rows.join(own, F.col(f"_cell_{i}") == F.col(f"_level_{i}"), "left")
    # Columns have ascending ranges of slots, so the slots of a row are in order.
    slots = F.array_compact(F.array(*[F.col(f"_slot_{i}") for i in range(len(encoder.modes))]).cast("array<int>"))
    first = F.expr(f"slice(sequence(0, {len(encoder.numeric)}), 1, {len(encoder.numeric)})")
    ones = F.transform(slots, lambda s: F.lit(1.0))
    vector = F.struct(
        F.lit(0).cast("tinyint").alias("type"), F.lit(encoder.size).alias("size"),
        F.concat(first, slots).alias("indices"), F.concat("_numbers", ones).alias("values"),
    )
    return rows.select(*keep, vector.alias("vector"))


def encode(encoder: TableEncoding, df: DataFrame, keep: Iterable[str] = (), output: str = "features") -> DataFrame:
    """Kept columns and the feature vector, stored."""
    made = entries(encoder, df, keep).withColumnRenamed("vector", output)
    path = scratch_path(df.sparkSession, "vectors")
    made.write.parquet(path)
    fields = [T.StructField(f.name, VectorUDT() if f.name == output else f.dataType) for f in made.schema]
    return df.sparkSession.read.schema(T.StructType(fields)).parquet(path)


def long_entries(encoder: TableEncoding, df: DataFrame, key: str) -> DataFrame:
    """Non-zero entries as ``(key, feature, value)``; names come by join."""
    pairs = F.arrays_zip(F.col("vector.indices").alias("idx"), F.col("vector.values").alias("value"))
    return (
        entries(encoder, df, [key]).select(key, F.inline(pairs)).filter("value <> 0")
        .join(encoder.names, "idx").select(key, F.col("name").alias("feature"), "value")
    )
