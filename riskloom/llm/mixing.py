"""Mix sources to target weights by a budget that runs down a domain-language-source tree.

A node hands its token budget to its children by weight. A child that has fewer tokens (all its
documents, ``max_epochs`` times) keeps what it has, and its shortage goes to its siblings by
weight; since a node never gets more than its leaves hold together, a shortage reaches the level
above only when no sibling is left. Sorted by capacity over weight, the children that run short
are a prefix, so each level is one window over the children of a node.

A leaf then takes whole epochs and, of one more, the longest prefix that fits the rest, in an
order drawn from seed, epoch, id and text. No leaf is sorted as a whole: token sums per digit of
the order key find the digit where the budget ends, level by level, at most 256 rows per leaf,
and only the rows behind the last digit are sorted. What is selected is a comparison of a row's
key with its leaf's last key.

Only DataFrame functions run. Defined cases: a null domain, language or source counts as
``none``; tokens are runs of characters other than white space, and a text without them (null
and empty ones too) takes no part; rows that agree in id and text are taken together or not at
all; weights that are not named are ``default_weight``, and a weight of 0 takes nothing; no rows
give no rows; further columns are carried by :func:`mixed_rows`.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window, functions as F

from riskloom.llm.common import keep

LEVELS = ("domain", "lang", "source")
LEAF = ["_domain", "_lang", "_source"]
DIGITS, DIGIT_BITS = 3, 8


def _weight(level: str, weights: Mapping[str, Mapping[str, float]], default: float) -> Column:
    weight = F.lit(float(default))
    for name, value in weights.get(level, {}).items():
        weight = F.when(F.col(f"_{level}") == name, F.lit(float(value))).otherwise(weight)
    return weight


def _shared(nodes: DataFrame, parent: list[str], key: str) -> DataFrame:
    """Replace ``_budget`` of the parent by the child's own share of it.

    ``nodes`` has a row per child: parent keys, ``key``, ``_weight``, ``_cap``, ``_budget``.
    """
    order = Window.partitionBy(*parent).orderBy("_ratio", key)
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    weighted = nodes.filter("_weight > 0").withColumn("_ratio", F.col("_cap") / F.col("_weight"))
    level = weighted.withColumn(
        "_level",
        (F.col("_budget") - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))) / F.sum("_weight").over(after),
    ).withColumn("_short", F.col("_ratio") <= F.col("_level"))
    family = Window.partitionBy(*parent)
    rest = F.col("_budget") - F.sum(F.when(F.col("_short"), F.col("_cap")).otherwise(0.0)).over(family)
    wanting = F.sum(F.when(F.col("_short"), 0.0).otherwise(F.col("_weight"))).over(family)
    return level.withColumn(
        "_budget", F.when(F.col("_short"), F.col("_cap")).otherwise(rest * F.col("_weight") / wanting)
    ).drop("_ratio", "_level", "_short")


def leaf_budgets(
    leaves: DataFrame, budget: float, weights: Mapping[str, Mapping[str, float]], max_epochs: int,
    default_weight: float = 1.0,
) -> DataFrame:
    """``leaves`` (leaf keys, ``_tokens``) with ``_budget``, the tokens each leaf gives.

    The tables here have a row per node of the tree.
    """
    given = leaves.withColumn("_cap", (F.col("_tokens") * F.lit(max_epochs)).cast("double"))
    named = [f"_{level}" for level in LEVELS]
    shares = None
    for depth, level in enumerate(LEVELS):
        keys, parent = named[: depth + 1], named[:depth]
        # A weight of 0 closes a branch, so its capacity is no help to the levels above.
        nodes = _open(given, weights, default_weight).groupBy(*keys).agg(F.sum("_cap").alias("_cap"))
        nodes = nodes.withColumn("_weight", _weight(level, weights, default_weight))
        if shares is None:
            whole = Window.partitionBy()
            nodes = nodes.withColumn("_budget", F.least(F.lit(float(budget)), F.sum("_cap").over(whole)))
        else:
            nodes = nodes.join(shares.select(*parent, "_budget"), parent)
        shares = _shared(nodes, parent, keys[-1])
    return given.join(shares.select(*named, "_budget"), named).drop("_cap")


def _open(leaves: DataFrame, weights: Mapping[str, Mapping[str, float]], default: float) -> DataFrame:
    for level in LEVELS:
        leaves = leaves.filter(_weight(level, weights, default) > 0)
    return leaves


def _keyed(docs: DataFrame, domain: Column, id_col: str, text_col: str) -> DataFrame:
    label = lambda c: F.coalesce(c.cast("string"), F.lit("none"))
    return docs.withColumns(
        {
            "_domain": label(domain), "_lang": label(F.col("lang")), "_source": label(F.col("source")),
            "_row": F.xxhash64(F.col(id_col), F.col(text_col)),
        }
    )


def _order(seed: int) -> Column:
    """The row's key in its leaf's last epoch, as 63 bits."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col("_epochs"), F.col("_row")), 1)


def plan_mix(
    docs: DataFrame, domain: Column, weights: Mapping[str, Mapping[str, float]], budget_share: float = 0.5,
    max_epochs: int = 2, seed: int = 6, default_weight: float = 1.0, id_col: str = "doc_id", text_col: str = "text",
) -> tuple[DataFrame, DataFrame]:
    """The slim rows with their tokens, and a row per leaf with its epochs and last key."""
    tokens = F.regexp_count(F.coalesce(F.col(text_col), F.lit("")), F.lit(r"\S+")).cast("long")
    rows = keep(
        _keyed(docs, domain, id_col, text_col)
        .select(F.col(id_col).alias("doc_id"), *LEAF, "_row", tokens.alias("_n"))
        .filter("_n > 0"),
        "mix-rows",
    )
    leaves = rows.groupBy(*LEAF).agg(F.sum("_n").alias("_tokens"))
    total = leaves.agg(F.coalesce(F.sum("_tokens"), F.lit(0))).first()[0]
    budgets = leaf_budgets(leaves, total * budget_share, weights, max_epochs, default_weight)
    state = keep(
        budgets.withColumn("_epochs", F.floor((F.col("_budget") + 1e-6) / F.col("_tokens")).cast("int"))
        .withColumn("_rest", F.floor(F.col("_budget") + 1e-6) - F.col("_epochs") * F.col("_tokens"))
        .withColumns({"_prefix": F.lit(0).cast("long"), "_left": F.col("_rest")}),
        "mix-leaves",
    )
    for digit in range(1, DIGITS + 1):
        low = 63 - digit * DIGIT_BITS
        near = rows.join(state, LEAF).withColumn("_here", F.shiftright(_order(seed), low))
        sums = (
            near.filter(F.shiftright("_here", DIGIT_BITS) == F.col("_prefix"))
            .groupBy(*LEAF, "_here")
            .agg(F.sum("_n").alias("_sum"), F.first("_left").alias("_left"))
        )
        run = Window.partitionBy(*LEAF).orderBy("_here")
        # The first digit whose rows do not all fit; a leaf whose rest fits all keeps none.
        ends = (
            sums.withColumn("_cum", F.sum("_sum").over(run))
            .filter(F.col("_cum") > F.col("_left"))
            .groupBy(*LEAF)
            .agg(F.min_by(F.struct("_here", (F.col("_left") - F.col("_cum") + F.col("_sum")).alias("_l")), "_here").alias("_end"))
            .select(*LEAF, "_end.*")
        )
        state = keep(
            state.drop("_prefix", "_left").join(
                ends.withColumnsRenamed({"_here": "_prefix", "_l": "_left"}), LEAF
            ),
            "mix-leaves",
        )
    low = 63 - DIGITS * DIGIT_BITS
    near = rows.join(state, LEAF).withColumn("_key", _order(seed))
    run = Window.partitionBy(*LEAF).orderBy("_key")
    fits = (
        near.filter(F.shiftright("_key", low) == F.col("_prefix"))
        .groupBy(*LEAF, "_key")
        .agg(F.sum("_n").alias("_sum"), F.first("_left").alias("_left"))
        .withColumn("_cum", F.sum("_sum").over(run))
        .filter(F.col("_cum") <= F.col("_left"))
        .groupBy(*LEAF)
        .agg(F.max("_key").alias("_fits"))
    )
    # Without a fitting row, the prefix ends ahead of the last digit's rows.
    last = F.coalesce("_fits", F.shiftleft("_prefix", low) - 1)
    cuts = state.join(fits, LEAF, "left").select(*LEAF, "_tokens", "_budget", "_epochs", last.alias("_last"))
    return rows, keep(cuts, "mix-cuts")


def _repeated(rows: DataFrame, cuts: DataFrame, seed: int) -> DataFrame:
    """One row per epoch in which a row is taken."""
    taken = rows.join(cuts, LEAF).withColumn(
        "_times", F.col("_epochs") + (_order(seed) <= F.col("_last")).cast("int")
    )
    return taken.filter("_times > 0").withColumn("epoch", F.explode(F.sequence(F.lit(0), F.col("_times") - 1)))


def mix(docs: DataFrame, domain: Column, weights: Mapping[str, Mapping[str, float]], seed: int = 6, **settings) -> DataFrame:
    """``doc_id, domain, lang, source, tokens, epoch, leaf_tokens, leaf_budget`` of what is taken."""
    rows, cuts = plan_mix(docs, domain, weights, seed=seed, **settings)
    return _repeated(rows, cuts, seed).select(
        "doc_id", F.col("_domain").alias("domain"), F.col("_lang").alias("lang"),
        F.col("_source").alias("source"), F.col("_n").alias("tokens"), "epoch",
        F.col("_tokens").alias("leaf_tokens"), F.col("_budget").alias("leaf_budget"),
    )


def mixed_rows(
    docs: DataFrame, domain: Column, weights: Mapping[str, Mapping[str, float]], seed: int = 6,
    id_col: str = "doc_id", text_col: str = "text", **settings,
) -> DataFrame:
    """The taken rows of ``docs`` with all their columns, one for each epoch."""
    rows, cuts = plan_mix(docs, domain, weights, seed=seed, id_col=id_col, text_col=text_col, **settings)
    some = F.regexp_like(F.coalesce(F.col(text_col), F.lit("")), F.lit(r"\S"))
    keyed = _keyed(docs.select(F.struct("*").alias("_doc"), id_col, text_col, "lang", "source"), domain, id_col, text_col)
    return _repeated(keyed.filter(some), cuts, seed).select("_doc.*")
