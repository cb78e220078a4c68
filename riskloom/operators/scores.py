"""Evaluation of binary scores.

Every metric starts from ``score_counts``: one row per distinct score with the number
of positives and negatives. Raw rows are read once; curves, areas, cuts and errors are
small aggregates over that table.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F

from riskloom.functions.scoring import ratio_or_zero
from riskloom.operators.running import ranged, running_totals
from riskloom.session import settle

METRICS = ("roc_auc", "pr_auc", "f1", "precision", "recall", "brier_score")
THRESHOLD_CUTS = 99
_ALL = "_all"


def score_counts(
    scored: DataFrame, y: str = "y", p: str = "p", group: Iterable[str] = ()
) -> DataFrame:
    """``(group..., p, pos, neg)`` per distinct score."""
    return (
        scored.select(*group, F.col(p).cast("double").alias("p"), F.col(y).cast("bigint").alias("y"))
        .groupBy(*group, "p")
        .agg(F.sum("y").alias("pos"), F.sum(1 - F.col("y")).alias("neg"))
    )


def cumulative_counts(counts: DataFrame, group: Iterable[str] = ()) -> DataFrame:
    """Adds ``tp`` and ``fp``: positives and negatives scored at or above each score."""
    return (
        running_totals(_downwards(counts, group), "_down", ["pos", "neg"], group)
        .withColumnsRenamed({"cum_pos": "tp", "cum_neg": "fp"})
        .drop("_down")
    )


def _downwards(counts: DataFrame, group: Iterable[str]) -> DataFrame:
    """The counts stored in order, highest score first."""
    return counts if "_down" in counts.columns else ranged(counts.withColumn("_down", -F.col("p")), "_down", group)


def _class_totals(counts: DataFrame, group: list[str]) -> DataFrame:
    """Positives and negatives per group: a small row each."""
    return counts.groupBy(*group).agg(F.sum("pos").alias("all_pos"), F.sum("neg").alias("all_neg"))


def _curve(
    scored: DataFrame, y: str, p: str, group: Iterable[str]
) -> tuple[DataFrame, DataFrame, list[str]]:
    """Cumulative counts with the class totals of each group, the settled counts, the keys.

    Without group columns a constant stands in, so both cases share one equi-join with
    one small row per group.
    """
    group = list(group)
    if not group:
        scored, group = scored.withColumn(_ALL, F.lit(0)), [_ALL]
    counts = _downwards(score_counts(scored, y, p, group), group)
    curve = cumulative_counts(counts, group)
    # The totals come from the stored counts, not from the curve, which would be run twice.
    return curve.join(_class_totals(counts, group), group), counts, group


def curve_of(scored: DataFrame, y: str = "y", p: str = "p", group: Iterable[str] = ()):
    """The stored cumulative counts that metrics and curves of one table share."""
    curve, counts, keys = _curve(scored, y, p, group)
    return settle(curve), counts, keys


def roc_points(
    scored: DataFrame, y: str = "y", p: str = "p", group: Iterable[str] = (), curve=None,
) -> DataFrame:
    """``(fpr, tpr, threshold)`` for every distinct score.

    The origin of the curve, where nothing is flagged, has no threshold.
    """
    curve, counts, keys = curve or _curve(scored, y, p, group)
    points = curve.select(
        *keys,
        ratio_or_zero(F.col("fp"), F.col("all_neg")).alias("fpr"),
        ratio_or_zero(F.col("tp"), F.col("all_pos")).alias("tpr"),
        F.col("p").alias("threshold"),
    )
    origin = _class_totals(counts, keys).select(
        *keys, F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"),
        F.lit(None).cast("double").alias("threshold"),
    )
    return points.unionByName(origin).drop(_ALL)


def pr_points(
    scored: DataFrame, y: str = "y", p: str = "p", group: Iterable[str] = (), curve=None,
) -> DataFrame:
    """``(precision, recall, threshold, baseline)`` for every distinct score.

    The end point (precision 1, recall 0) has no threshold; the baseline is the share
    of positives.
    """
    curve, counts, keys = curve or _curve(scored, y, p, group)
    baseline = ratio_or_zero(F.col("all_pos"), F.col("all_pos") + F.col("all_neg")).alias("baseline")
    points = curve.select(
        *keys,
        ratio_or_zero(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        ratio_or_zero(F.col("tp"), F.col("all_pos")).alias("recall"),
        F.col("p").alias("threshold"),
        baseline,
    )
    end = _class_totals(counts, keys).select(
        *keys, F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"),
        F.lit(None).cast("double").alias("threshold"), baseline,
    )
    return points.unionByName(end).drop(_ALL)


def _roc_auc() -> Column:
    # A positive beats the negatives below its score and half of those tied with it.
    below = F.col("all_neg") - F.col("fp")
    wins = F.sum(F.col("pos") * (below + F.col("neg") / 2))
    return F.try_divide(wins, (F.max("all_pos") * F.max("all_neg")).cast("double"))


def _average_precision() -> Column:
    step = F.col("pos") / F.greatest(F.col("all_pos"), F.lit(1))
    return F.sum(step * (F.col("tp") / (F.col("tp") + F.col("fp"))))


def _brier() -> Column:
    squared = F.col("pos") * F.pow(F.col("p") - 1, F.lit(2.0)) + F.col("neg") * F.pow("p", F.lit(2.0))
    return F.try_divide(F.sum(squared), F.sum(F.col("pos") + F.col("neg")).cast("double"))


def cut_metrics(tp: Column, flagged: Column, positives: Column) -> dict[str, Column]:
    """Precision, recall and F1 from counts, 0 where undefined."""
    return {
        "precision": ratio_or_zero(tp, flagged),
        "recall": ratio_or_zero(tp, positives),
        "f1": ratio_or_zero(2 * tp, flagged + positives),
    }


def compute_metrics(
    scored: DataFrame,
    threshold: float = 0.5,
    y: str = "y",
    p: str = "p",
    group: Iterable[str] = (),
    curve=None,
) -> DataFrame:
    """All six metrics, one row per group. ROC-AUC is null when a class is absent."""
    curve, _, keys = curve or _curve(scored, y, p, group)
    flagged = F.col("p") >= F.lit(float(threshold))

    def picked(count: Column) -> Column:
        return F.coalesce(F.sum(F.when(flagged, count)), F.lit(0))

    tp, hits = picked(F.col("pos")), picked(F.col("pos") + F.col("neg"))
    return (
        curve.groupBy(*keys)
        .agg(
            _roc_auc().alias("roc_auc"),
            _average_precision().alias("pr_auc"),
            *[c.alias(n) for n, c in cut_metrics(tp, hits, F.max("all_pos")).items()],
            _brier().alias("brier_score"),
        )
        .select(*[k for k in keys if k != _ALL], *METRICS)
    )


def roc_auc(scored: DataFrame, y: str = "y", p: str = "p", group: Iterable[str] = ()) -> DataFrame:
    """Area under the ROC curve, tied scores counting half."""
    curve, _, keys = _curve(scored, y, p, group)
    return curve.groupBy(*keys).agg(_roc_auc().alias("roc_auc")).drop(_ALL)


def average_precision(scored: DataFrame, y: str = "y", p: str = "p", group: Iterable[str] = ()) -> DataFrame:
    """Step-wise area under precision and recall (not the trapezoid)."""
    curve, _, keys = _curve(scored, y, p, group)
    return curve.groupBy(*keys).agg(_average_precision().alias("pr_auc")).drop(_ALL)


def brier_score(scored: DataFrame, y: str = "y", p: str = "p",
                group: Iterable[str] = ()) -> DataFrame:
    return scored.groupBy(*group).agg(
        F.avg(F.pow(F.col(p) - F.col(y), F.lit(2.0))).alias("brier_score")
    )


def precision_recall_f1(scored: DataFrame, threshold: float, y: str = "y", p: str = "p",
                        group: Iterable[str] = ()) -> DataFrame:
    """Precision, recall and F1 at a cut: one aggregate, no ordering."""
    hit = (F.col(p) >= F.lit(float(threshold))).cast("bigint")
    label = F.col(y).cast("bigint")
    made = cut_metrics(F.sum(hit * label), F.sum(hit), F.sum(label))
    return scored.groupBy(*group).agg(*[c.alias(n) for n, c in made.items()])


def tall_metrics(metrics: DataFrame, keep: Iterable[str] = ()) -> DataFrame:
    """One row per ``(metric, value)``."""
    names = [m for m in METRICS if m in metrics.columns]
    return metrics.unpivot(list(keep), names, "metric", "value")


def threshold_table(scored: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    """Counts, precision and recall at the 99 cuts 0.01, 0.02, ..., 0.99.

    Rows are first reduced to the number of cuts they reach: at most 100 groups, packed
    into one row, from which every cut sums the groups that reach it.
    """
    score = F.col(p).cast("double")
    last = F.lit(THRESHOLD_CUTS)

    def cut(i: Column) -> Column:
        return F.lit(0.01) + (i - 1) * F.lit(0.01)

    # The guess is off by at most one cut; compare with the exact cut values.
    guess = F.least(F.greatest(F.floor(score * 100), F.lit(0)), last)
    down = guess - F.when((guess > 0) & (score < cut(guess)), 1).otherwise(0)
    reached = down + F.when((down < last) & (score >= cut(down + 1)), 1).otherwise(0)
    groups = (
        scored.select(reached.cast("int").alias("reached"), F.col(y).cast("bigint").alias("y"))
        .groupBy("reached")
        .agg(F.sum("y").alias("pos"), F.count(F.lit(1)).alias("rows"))
    )
    packed = groups.agg(
        F.collect_list(F.struct("reached", "pos", "rows")).alias("groups"),
        F.coalesce(F.sum("pos"), F.lit(0)).alias("positives"),
    )

    def total(i: Column, name: str) -> Column:
        return F.aggregate(
            "groups",
            F.lit(0).cast("bigint"),
            lambda acc, g: acc + F.when(g["reached"] >= i, g[name]).otherwise(F.lit(0)),
        )

    rows = F.transform(
        F.sequence(F.lit(1), last),
        lambda i: F.struct(
            cut(i).alias("threshold"), total(i, "pos").alias("tp"), total(i, "rows").alias("flagged")
        ),
    )
    return packed.select("positives", F.inline(rows)).select(
        "threshold", "tp", "flagged", "positives",
        ratio_or_zero(F.col("tp"), F.col("flagged")).alias("precision"),
        ratio_or_zero(F.col("tp"), F.col("positives")).alias("recall"),
    )


def find_optimal_threshold(
    scored: DataFrame, min_recall: float = 0.70, y: str = "y", p: str = "p"
) -> DataFrame:
    """One row: the cut of best precision at the required recall, 0.5 when none has it.

    Equal precision goes to the lowest cut.
    """
    return (
        threshold_table(scored, y, p)
        .filter(F.col("recall") >= min_recall)
        .agg(
            F.max_by(
                F.struct("threshold", "precision", "recall"),
                F.struct(F.col("precision"), -F.col("threshold")),
            ).alias("best")
        )
        .select(
            F.coalesce("best.threshold", F.lit(0.5)).alias("threshold"),
            F.col("best.precision").alias("precision"),
            F.col("best.recall").alias("recall"),
        )
    )


def highest_score_with_recall(
    scored: DataFrame, min_recall: float = 0.70, y: str = "y", p: str = "p"
) -> DataFrame:
    """One row: the largest score that still reaches the required recall."""
    points = pr_points(scored, y, p).filter(
        (F.col("recall") >= min_recall) & F.col("threshold").isNotNull()
    )
    return points.agg(
        F.max("threshold").alias("threshold"),
        F.max_by("precision", "threshold").alias("precision"),
        F.max_by("recall", "threshold").alias("recall"),
    )


def confusion_matrix(scored: DataFrame, threshold: float, y: str = "y", p: str = "p") -> DataFrame:
    """Four rows ``(actual, predicted, n)``, zeros included, in one aggregate."""
    hit = F.col(p) >= F.lit(float(threshold))
    cells = [(a, b) for a in (0, 1) for b in (0, 1)]
    counts = scored.agg(
        *[F.count_if((F.col(y) == a) & (hit if b else ~hit)).alias(f"n{a}{b}") for a, b in cells]
    )
    rows = F.array(
        *[
            F.struct(F.lit(a).alias("actual"), F.lit(b).alias("predicted"), F.col(f"n{a}{b}").alias("n"))
            for a, b in cells
        ]
    )
    return counts.select(F.inline(rows))


def calibration_curve(scored: DataFrame, bins: int = 10, y: str = "y", p: str = "p") -> DataFrame:
    """Mean score and positive rate per equal-width bin of [0, 1]; empty bins dropped.

    Bins are closed on the right, so a score on an inner edge belongs to the lower bin.
    """
    score = F.col(p).cast("double")

    def edge(i: Column) -> Column:
        return i * F.lit(1.0 / bins)

    guess = F.least(F.greatest(F.ceil(score * bins) - 1, F.lit(0)), F.lit(bins - 1))
    down = guess - F.when((guess > 0) & (score <= edge(guess)), 1).otherwise(0)
    placed = down + F.when((down < bins - 1) & (score > edge(down + 1)), 1).otherwise(0)
    return scored.groupBy(placed.cast("int").alias("bin")).agg(
        F.avg(score).alias("mean_predicted"),
        F.avg(F.col(y).cast("double")).alias("fraction_positive"),
        F.count(F.lit(1)).alias("n"),
    )


def model_comparison(scored: DataFrame, y: str = "y", p: str = "p", model: str = "model") -> DataFrame:
    """Metrics of several models at 0.5, four decimals, best PR-AUC first."""
    table = compute_metrics(scored, 0.5, y, p, [model])
    return table.select(
        model, *[F.round(m, 4).alias(m) for m in METRICS if m != "brier_score"]
    ).orderBy(F.col("pr_auc").desc(), model)


def best_model(scores: DataFrame, score: str = "score", order: str = "position") -> DataFrame:
    """Row of the highest score; ties go to the earliest configured model."""
    return scores.orderBy(F.col(score).desc(), F.col(order).asc()).limit(1)
