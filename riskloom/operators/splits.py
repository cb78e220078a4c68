"""Seeded stratified splits and folds with exact shares and no shuffle of the rows.

Rows of a stratum are ordered by ``md5(id:seed)``. A split needs only the few hash
values at which the shares are cut: counts per 16-bit hash bucket locate each cut, and
only the rows of the located buckets are ranked. Assigning the rows is then a
comparison of their hash with those constants.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from riskloom.session import stored

BUCKET_HEX = 4  # 65,536 buckets per stratum


def hash_key(key: Column, seed: int) -> Column:
    """Order key of a row: stable across runs, engines and partitionings."""
    text = key.cast("string")
    return F.concat_ws("|", F.md5(F.concat_ws(":", text, F.lit(str(seed)))), text)


def _cut_table(
    df: DataFrame, key: str, stratum: str, shares: Sequence[float], seed: int
) -> DataFrame:
    """``(_s, _limits)``: per stratum the first order key at or past each cumulative share.

    A cut past the last row has no limit. There is a row per stratum, however many there are.
    """
    slim = df.select(F.col(stratum).alias("s"), hash_key(F.col(key), seed).alias("h"))
    slim = slim.withColumn("b", F.substring("h", 1, BUCKET_HEX))
    by_bucket = slim.groupBy("s", "b").agg(F.count(F.lit(1)).alias("n"))
    # At most 65,536 bucket rows per stratum, whatever the size of the data.
    run = Window.partitionBy("s").orderBy("b")
    located = by_bucket.withColumn("cum", F.sum("n").over(run)).withColumn(
        "total", F.sum("n").over(Window.partitionBy("s"))
    )
    # A cut keeps the first floor(share * total + 0.5) rows below it.
    ranks = F.array(*[F.floor(F.col("total") * s + 0.5).cast("bigint") for s in shares])
    inside = (F.col("rank") >= F.col("cum") - F.col("n")) & (F.col("rank") < F.col("cum"))
    spots = stored(
        located.select("s", "b", "n", "cum", F.explode(ranks).alias("rank"))
        .filter(inside)
        .select("s", "b", (F.col("rank") - F.col("cum") + F.col("n") + 1).alias("place")),
        "cuts",
    )
    # Rank only the rows of the located buckets: about rows / 65,536 per cut.
    wanted = spots.select(F.col("s").alias("bs"), F.col("b").alias("bb")).distinct()
    near = slim.join(wanted, F.col("s").eqNullSafe(F.col("bs")) & (F.col("b") == F.col("bb")), "left_semi")
    ranked = near.select(
        F.col("s").alias("rs"), F.col("b").alias("rb"), "h",
        F.row_number().over(Window.partitionBy("s", "b").orderBy("h")).alias("rank"),
    )
    hits = ranked.join(
        spots,
        F.col("rs").eqNullSafe(F.col("s")) & (F.col("rb") == F.col("b")) & (F.col("rank") == F.col("place")),
    )
    return stored(
        hits.groupBy(F.col("rs").alias("_s")).agg(F.collect_list("h").alias("_limits")), "limits"
    )


def hash_parts(
    df: DataFrame, key: str, stratum: str, shares: Sequence[float], seed: int, out: str = "part"
) -> DataFrame:
    """Add ``out``: how many of the cumulative ``shares`` the row lies at or past."""
    limits = _cut_table(df, key, stratum, shares, seed)
    placed = df.withColumn("_h", hash_key(F.col(key), seed)).join(
        limits, F.col(stratum).eqNullSafe(F.col("_s")), "left"
    )
    passed = F.size(F.filter(F.coalesce("_limits", F.array().cast("array<string>")), lambda x: F.col("_h") >= x))
    return placed.withColumn(out, passed).drop("_h", "_s", "_limits")


def assign_splits(
    df: DataFrame, key: str, target: str = "readmitted", test_size: float = 0.15,
    val_size: float = 0.15, seed: int = 42,
) -> DataFrame:
    """Add ``split``: test, val or train, with exact shares in each target class."""
    parts = hash_parts(df, key, target, [test_size, test_size + val_size], seed, "_part")
    name = F.when(F.col("_part") == 0, "test").when(F.col("_part") == 1, "val").otherwise("train")
    return parts.withColumn("split", name).drop("_part")


def split_data(
    df: DataFrame, key: str, target: str = "readmitted", test_size: float = 0.15,
    val_size: float = 0.15, seed: int = 42,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Train, validation and test tables: three filters over one assignment."""
    parts = assign_splits(df, key, target, test_size, val_size, seed)
    return tuple(parts.filter(F.col("split") == s).drop("split") for s in ("train", "val", "test"))


def assign_folds(
    df: DataFrame, key: str, target: str = "readmitted", k: int = 5, seed: int = 42,
    out: str = "fold",
) -> DataFrame:
    """Add a fold number 0..k-1; fold sizes differ by at most one row per class."""
    return hash_parts(df, key, target, [i / k for i in range(1, k)], seed, out)


def class_weights(df: DataFrame, target: str = "readmitted") -> DataFrame:
    """``(label, n, weight)`` with weight n / (classes * n_c)."""
    by_class = df.groupBy(F.col(target).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    totals = by_class.agg(F.count(F.lit(1)).alias("classes"), F.sum("n").alias("total"))
    # One row joins every class.
    return by_class.withColumn("_one", F.lit(1)).join(F.broadcast(totals.withColumn("_one", F.lit(1))), "_one").select(
        "label", "n", (F.col("total") / (F.col("classes") * F.col("n"))).alias("weight")
    )


def hash_sample(df: DataFrame, key: str, rows: int, seed: int = 42) -> DataFrame:
    """The ``rows`` first rows in hash order: a repeatable sample, run as a top-k."""
    return df.withColumn("_h", hash_key(F.col(key), seed)).orderBy("_h").limit(rows).drop("_h")


def concat(parts: Iterable[DataFrame]) -> DataFrame:
    """Rows of all parts, columns matched by name."""
    parts = list(parts)
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
