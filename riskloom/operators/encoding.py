"""Imputation, scaling and one-hot encoding.

Fitted values are computed from the distinct-value tables and put into native MLlib
stages, so a fitted encoder is a ``PipelineModel``: it runs in the JVM and is saved and
loaded with MLlib's own persistence.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.ml import Estimator, PipelineModel, Transformer
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window, functions as F

from riskloom.functions import sqltext
from riskloom.operators import counts
from riskloom.schema import CATEGORICAL_FEATURES, NUMERIC_FEATURES

_ROWS = "_rows"


def _counts_with_rows(df: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct values plus one pseudo feature that counts all rows."""
    return counts.numeric_counts(df.withColumn(_ROWS, F.lit(1.0)), [*columns, _ROWS])


def median_table(
    df: DataFrame, columns: Iterable[str]
) -> DataFrame:
    """``(feature, median)`` of the values present, interpolated."""
    table = counts.numeric_counts(df, columns)
    return counts.order_statistics(table, {"median": 0.5}).select("feature", "median")


def _approximate_scaling(df: DataFrame, columns: list[str]) -> DataFrame:
    """Scaling values with sketched medians: two wide aggregates and no shuffle of values."""
    values = [f"nanvl(double({sqltext.name(c)}), NULL)" for c in columns]
    first = df.agg(
        *[F.expr(f"percentile_approx({v}, 0.5, 10000)").alias(str(i)) for i, v in enumerate(values)]
    ).first()
    found = [i for i in range(len(columns)) if first[i] is not None]
    filled = {i: f"coalesce({values[i]}, {sqltext.value(float(first[i]))})" for i in found}
    second = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.expr(f"avg({v})").alias(f"mean{i}") for i, v in filled.items()],
        *[F.expr(f"stddev_pop({v})").alias(f"scale{i}") for i, v in filled.items()],
    ).first()
    rows = [
        (columns[i], float(first[i]), second[f"mean{i}"], second[f"scale{i}"] or 1.0) for i in found
    ]
    return df.sparkSession.createDataFrame(
        rows, "feature string, median double, mean double, scale double"
    )


def scaling_table(
    df: DataFrame, columns: Iterable[str], exact: bool = True
) -> DataFrame:
    """``(feature, median, mean, scale)`` after median imputation.

    ``scale`` is the population deviation, 1 where that is 0. Exact medians need one scan
    and a shuffle of the distinct values; ``exact=False`` sketches them, which suits
    continuous columns of very large tables.
    """
    columns = list(columns)
    if not exact:
        return _approximate_scaling(df, columns)
    table = counts.ranged_counts(_counts_with_rows(df, columns))
    stats = counts.order_statistics(table, {"median": 0.5}, settled=True)
    rows = stats.filter(F.col("feature") == _ROWS).select(F.lit(1).alias("_one"), F.col("total").alias("_rows"))
    medians = (
        stats.filter(F.col("feature") != _ROWS)
        .withColumn("_one", F.lit(1))
        .join(F.broadcast(rows), "_one")  # a single row
        .select("feature", "median", "_rows")
    )
    # Rows without a value sit at the median, so sums of distances from it need the others only.
    gap = F.col("value") - F.col("median")
    sums = (
        table.join(F.broadcast(medians), "feature")  # a row per column
        .groupBy("feature", "median", "_rows")
        .agg(F.sum(F.col("n") * gap).alias("_gaps"), F.sum(F.col("n") * gap * gap).alias("_squares"))
    )
    off = F.col("_gaps") / F.col("_rows")
    variance = F.greatest(F.col("_squares") / F.col("_rows") - off * off, F.lit(0.0))
    # What rounding leaves of a constant column's variance is none.
    constant = variance <= F.lit(1e-24) * F.greatest(F.pow(F.col("median"), 2), F.lit(1.0))
    return sums.select(
        "feature", "median", (F.col("median") + off).alias("mean"),
        F.when(constant, F.lit(1.0)).otherwise(F.sqrt(variance)).alias("scale"),
    )


def mode_table(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """``(feature, mode)``: the most frequent category, the smallest on ties."""
    return (
        counts.text_counts(df, columns)
        .groupBy("feature")
        .agg(F.min(F.struct((-F.col("n")).alias("n"), F.col("value"))).alias("_best"))
        .select("feature", F.col("_best.value").alias("mode"))
    )


def level_table(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """``(feature, value, n)``: the vocabulary of each category."""
    return counts.text_counts(df, columns)


@dataclass(frozen=True)
class FittedValues:
    """What an encoder learns: per numeric column three numbers, per category its levels."""

    numeric: dict[str, tuple[float, float, float]]  # median, mean, scale
    categorical: dict[str, tuple[str, list[str]]]  # mode, sorted levels


def fit_values(
    df: DataFrame, numeric: Iterable[str], categorical: Iterable[str], exact: bool = True,
    max_levels: int | None = None,
) -> FittedValues:
    """Learn medians, means, scales, modes and vocabularies from ``df``.

    The vocabulary becomes part of the model, so it comes to the driver. ``max_levels`` bounds
    it where wanted: only the most frequent levels of a column (ties: the smaller) are coded,
    and the others encode to zeros as unseen ones do. Without it every level is coded.
    """
    numeric, categorical = list(numeric), list(categorical)
    learned = {}
    if numeric:
        for r in scaling_table(df, numeric, exact).collect():  # one row per column
            learned[r["feature"]] = (r["median"], r["mean"], r["scale"])
    levels: dict[str, list[tuple[int, str]]] = {c: [] for c in categorical}
    if categorical:
        table = level_table(df, categorical)
        if max_levels is not None:
            order = Window.partitionBy("feature").orderBy(F.desc("n"), "value")
            table = table.withColumn("_place", F.row_number().over(order)).filter(F.col("_place") <= max_levels)
        for r in table.toLocalIterator():
            levels[r["feature"]].append((-r["n"], r["value"]))
    return FittedValues(
        {c: learned.get(c, (0.0, 0.0, 1.0)) for c in numeric},
        {
            c: (min(found)[1], sorted(v for _, v in found)) if found else ("", [])
            for c, found in levels.items()
        },
    )


def build_encoder(values: FittedValues, sample: DataFrame, output: str = "features") -> PipelineModel:
    """Native stages for the fitted values; ``sample`` only supplies the input schema."""
    items = []
    for name, (median, mean, scale) in values.numeric.items():
        filled = f"coalesce(nanvl(CAST(`{name}` AS DOUBLE), NULL), {median!r}D)"
        items.append(f"({filled} - {mean!r}D) / {scale!r}D AS `num__{name}`")
    # A column without any level encodes to nothing.
    coded = {c: v for c, v in values.categorical.items() if v[1]}
    for name, (mode, _) in coded.items():
        items.append(f"coalesce(CAST(`{name}` AS STRING), {sqltext.value(mode)}) AS `cat__{name}`")
    stages: list[Transformer] = [SQLTransformer(statement=f"SELECT *, {', '.join(items)} FROM __THIS__")]
    inputs = [f"num__{c}" for c in values.numeric]
    if coded:
        indexers = [
            StringIndexerModel.from_labels(
                levels, inputCol=f"cat__{c}", outputCol=f"index__{c}", handleInvalid="keep"
            )
            for c, (_, levels) in coded.items()
        ]
        hot = [f"hot__{c}" for c in coded]
        prepared = PipelineModel([stages[0], *indexers]).transform(sample.limit(0))
        # The unknown level comes last and is the one dropped: it encodes to zeros. The
        # level counts are read from column metadata, without a job.
        encoder = OneHotEncoder(
            inputCols=[f"index__{c}" for c in coded], outputCols=hot, dropLast=True
        ).fit(prepared)
        stages += [*indexers, encoder]
        inputs += hot
    stages.append(VectorAssembler(inputCols=inputs, outputCol=output))
    return PipelineModel(stages)


class TabularEncoder(Estimator):
    """Median-impute and scale numeric columns, mode-impute and one-hot categories."""

    def __init__(
        self,
        numeric: Iterable[str] = NUMERIC_FEATURES,
        categorical: Iterable[str] = CATEGORICAL_FEATURES,
        output: str = "features",
        exact: bool = True,
    ):
        super().__init__()
        self.numeric, self.categorical, self.output = list(numeric), list(categorical), output
        self.exact = exact

    def _fit(self, dataset: DataFrame) -> PipelineModel:
        values = fit_values(dataset, self.numeric, self.categorical, exact=self.exact)
        return build_encoder(values, dataset, self.output)


def feature_names(encoder: PipelineModel) -> list[str]:
    """Name of every vector slot: ``num__column`` or ``cat__column_level``."""
    names: list[str] = []
    labels: dict[str, list[str]] = {}
    for stage in encoder.stages:
        if isinstance(stage, StringIndexerModel):
            labels[stage.getInputCol().removeprefix("cat__")] = list(stage.labels)
        if isinstance(stage, VectorAssembler):
            for column in stage.getInputCols():
                if column.startswith("num__"):
                    names.append(column)
                else:
                    base = column.removeprefix("hot__")
                    names += [f"cat__{base}_{level}" for level in labels[base]]
    return names


def name_table(encoder: PipelineModel, df: DataFrame) -> DataFrame:
    """``(idx, name)`` of the vector slots."""
    rows = list(enumerate(feature_names(encoder)))
    return df.sparkSession.createDataFrame(rows, "idx int, name string")


def encode(encoder: PipelineModel, df: DataFrame, keep: Iterable[str] = ()) -> DataFrame:
    """Kept columns and the feature vector."""
    output = encoder.stages[-1].getOutputCol()
    return encoder.transform(df).select(*keep, output)


def long_features(
    encoded: DataFrame, names: list[str], key: str, vector: str = "features"
) -> DataFrame:
    """Non-zero entries as ``(key, feature, value)``."""
    values = vector_to_array(vector)
    labels = F.array(*[F.lit(n) for n in names])
    pairs = F.arrays_zip(labels.alias("feature"), values.alias("value"))
    return (
        encoded.select(key, F.explode(pairs).alias("pair"))
        .select(key, F.col("pair.feature").alias("feature"), F.col("pair.value").alias("value"))
        .filter("value <> 0")
    )
