"""Remove repeated runs of lines: a suffix array over line ids by distributed prefix doubling.

Documents are numbered in the order of their ids and become sequences of line ids. Level ``h``
ranks the suffixes by their first ``h`` lines; level ``2h`` sorts the pairs of ranks at ``p`` and
``p + h``. Only suffixes that share their rank with another one are kept, since only those have
a common prefix of that length, and doubling ends when none is left. Distinct pairs are sorted,
not suffixes, so a line that a third of all documents hold is one row of the sort.

Longest-common-prefix intervals are then walked from long to short. An interval holds the
suffixes with one prefix of some length; within it, at level ``h``, those with one rank behind
that prefix form an interval that is longer by ``h``, and every member that is not its first
occurrence has an earlier copy of that length. Each suffix so reaches its longest run that
occurs earlier in the corpus. Intervals are tables joined and summed by key, never a group
gathered in a task.

Every run that occurs earlier is a copy, of a single short or empty line too, and its lines are
deleted; the first occurrence always stays. A caller may spare runs below ``min_words`` words,
which are what U+0020 separates, so it must know its texts to do so.

Defined cases: rows that agree in id and text count as one document and get one result; null ids
sort first; a null text has no lines and stays null; an empty text is one empty line; lines are
split at line feeds and compared exactly; runs end with their document; no rows give no rows;
other columns are carried unread.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from riskloom.llm.common import keep, slices
from riskloom.llm.sharding import numbered

MIN_WORDS = 0  # all runs
LINE_BITS = 30  # a position is the document's number and 30 bits for the line


def _line_tables(docs: DataFrame) -> DataFrame:
    """``(_id, _hash, lines, words, row)`` of every distinct document with a text."""
    # Word counts are sums over single characters that open a word; no regular expression.
    slim = docs.filter("_text IS NOT NULL").select(
        "_id", "_hash",
        F.transform(F.split("_text", "\n"), lambda x: F.xxhash64(x)).alias("lines"),
        F.transform(
            F.split("_text", "\n"),
            lambda x: F.when(F.trim(x) == "", 0).otherwise(F.size(F.split(F.trim(x), " +"))),
        ).alias("words"),
    )
    table, _ = numbered(slim.dropDuplicates(["_id", "_hash"]), ["_id", "_hash"], "row")
    return keep(table, "line-tables")


def _shared(pairs: DataFrame, keys: list[str]) -> DataFrame:
    """``(at, r)``: the rank by ``keys`` of every position that shares it with another one."""
    groups = pairs.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").drop("_n")
    ranks, _ = numbered(groups, keys, "_rank")
    return keep(pairs.join(ranks, keys).select("at", F.col("_rank").alias("r")), "ranks")


def suffix_ranks(lines: DataFrame) -> list[DataFrame]:
    """Rank tables ``(at, r)`` for 1, 2, 4, ... lines, as far as ranks are shared."""
    levels, h = [], 1
    level = _shared(lines, ["id"])
    while not level.isEmpty():
        levels.append(level)
        ahead = level.select((F.col("at") - h).alias("at"), F.col("r").alias("r2"))
        level = _shared(level.join(ahead, "at"), ["r", "r2"])
        h *= 2
    return levels


def longest_earlier(levels: list[DataFrame]) -> DataFrame | None:
    """``(at, length)``: the longest run of lines at ``at`` that also starts earlier.

    Rows of ``live`` say that ``at`` lies in interval ``key`` of prefix length ``o``; ``own``
    marks the interval that a suffix has reached as its longest so far.
    """
    live, reached = None, None
    for level in reversed(range(len(levels))):
        h, ranks = 1 << level, levels[level]
        fresh = ranks.select("at", F.lit(0).cast("long").alias("o"), F.lit(0).cast("long").alias("key"), "r")
        if live is None:
            steps = fresh.withColumn("own", F.lit(True))
        else:
            fresh = fresh.join(reached, "at", "left").withColumn("own", F.col("_any").isNull()).drop("_any")
            behind = ranks.select(F.col("at").alias("_to"), "r")
            steps = (
                live.withColumn("_to", F.col("at") + F.col("o")).join(behind, "_to")
                .select("at", "o", "key", "r", "own").unionByName(fresh)
            )
        steps = keep(steps.withColumn("key", F.xxhash64("o", "key", "r", F.lit(h))).drop("r"), "interval-steps")
        # A step matters where a suffix whose longest run this extends has an earlier member.
        groups = (
            steps.groupBy("key").agg(F.min("at").alias("_first"), F.max(F.when(F.col("own"), F.col("at"))).alias("_last"))
            .filter("_last > _first").drop("_last")
        )
        longer = keep(
            steps.join(groups, "key").select(
                "at", (F.col("o") + h).alias("o"), "key", (F.col("own") & (F.col("at") > F.col("_first"))).alias("own")
            ),
            "intervals",
        )
        won = longer.filter("own").select("at", F.lit(True).alias("_won"))
        if live is not None:
            older = live.join(won, "at", "left").withColumn("own", F.col("own") & F.col("_won").isNull()).drop("_won")
            needed = older.groupBy("key").agg(F.max("own").alias("_needed")).filter("_needed").drop("_needed")
            longer = older.join(needed, "key").select("at", "o", "key", "own").unionByName(longer)
        live = keep(longer, "intervals")
        reached = live.filter("own").select("at", F.lit(True).alias("_any"))
    return None if live is None else live.filter("own").select("at", F.col("o").alias("length"))


def _deleted(min_words: int):
    """The deleted lines of each document from its runs."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            gone = []
            for words, runs in zip(batch.column("words"), batch.column("runs")):
                words = np.asarray(words.values, dtype=np.int64)
                runs = runs.as_py()
                first = np.array([r["line"] for r in runs], np.int64)
                past = first + np.array([r["length"] for r in runs], np.int64)
                sums = np.concatenate(([0], np.cumsum(words)))
                ok = sums[past] - sums[first] >= min_words
                edge = np.zeros(len(words) + 1, np.int64)
                np.add.at(edge, first[ok], 1)
                np.add.at(edge, past[ok], -1)
                gone.append(np.flatnonzero(np.cumsum(edge[:-1]) > 0).tolist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), batch.column("_hash"), pa.array(gone, pa.list_(pa.int64()))],
                names=["_id", "_hash", "_gone"],
            )

    return run


def repeated_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``(_id, _hash, _gone)``: numbers of the deleted lines, for documents that have any."""
    tables = _line_tables(docs)
    lines = tables.select("row", F.posexplode("lines").alias("line", "id")).select(
        (F.shiftleft("row", LINE_BITS) + F.col("line")).alias("at"), "id"
    )
    runs = longest_earlier(suffix_ranks(lines))
    if runs is None:
        return tables.select("_id", "_hash", F.lit(None).cast("array<long>").alias("_gone")).limit(0)
    per_doc = runs.groupBy(F.shiftright("at", LINE_BITS).alias("row")).agg(
        F.collect_list(
            F.struct(F.col("at").bitwiseAND(F.lit((1 << LINE_BITS) - 1)).alias("line"), "length")
        ).alias("runs")
    )
    kind = dict(tables.dtypes)["_id"]
    return keep(
        tables.select("row", "_id", "_hash", "words").join(per_doc, "row").select("_id", "_hash", "words", "runs")
        .mapInArrow(_deleted(min_words), f"_id {kind}, _hash long, _gone array<long>").filter(F.size("_gone") > 0),
        "deleted-lines",
    )


def _cut(name: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text"):
            texts = []
            for text, gone in zip(batch.column("_text").to_pylist(), batch.column("_gone").to_pylist()):
                drop = set(gone)
                texts.append("\n".join(x for i, x in enumerate(text.split("\n")) if i not in drop))
            yield batch.set_column(batch.schema.get_field_index("_text"), "_text", pa.array(texts, pa.string()))

    return run


def without_repeated_lines(
    docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """The other columns in a struct ``doc``, the shortened ``text``, ``n_lines`` and ``n_removed``."""
    others = [F.col(f"`{c}`") for c in docs.columns if c != text_col]
    marked = docs.select(
        F.struct(*others).alias("doc"), F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"),
        F.xxhash64(F.col(text_col).cast("string")).alias("_hash"),
    )
    gone = repeated_lines(marked.select("_id", "_text", "_hash"), min_words)
    joined = marked.join(
        gone.withColumnsRenamed({"_id": "_gone_id", "_hash": "_gone_hash"}),
        F.col("_id").eqNullSafe(F.col("_gone_id")) & (F.col("_hash") == F.col("_gone_hash")), "left",
    ).select("doc", "_text", "_gone").withColumn("n_lines", F.coalesce(F.size(F.split("_text", "\n")), F.lit(0)))
    cut = joined.filter("_gone IS NOT NULL")
    shorter = cut.mapInArrow(_cut("_text"), cut.schema)
    return shorter.unionByName(joined.filter("_gone IS NULL")).select(
        "doc", F.col("_text").alias("text"), F.when(F.col("_text").isNull(), 0).otherwise(F.col("n_lines")).cast("long").alias("n_lines"),
        F.coalesce(F.size("_gone"), F.lit(0)).cast("long").alias("n_removed"),
    )
