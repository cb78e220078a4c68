"""Benchmark decontamination: hash windows of test items, scan texts for them, verify, remove.

Texts are cut into words after A-Z were lower-cased. A window is ``width`` words in a row of an
item, or all words of a shorter item. The windows form a table with a row per hash: which word
rows it stands for, and which items hold them. It is broadcast, and every position of every
text is looked up by the hash of the words that start there, once for each length that occurs
among the windows. A match counts only if the words themselves are equal.

The scan is one narrow stage: words are exploded next to their array, hashed, joined and
filtered without leaving it. Only a row per text and one per hit reach the shuffle, keyed by the
text's id and 128-bit digest, so neither a frequent window nor a repeated text is a hot key: the
rows of each task are merged ahead of it.

The broadcast is bounded: the windows' bytes are summed first, and beyond ``broadcast_bytes``
they are dealt by hash into slices below it, each of which scans the texts once.

Only DataFrame functions run. Defined cases: a null or empty text, or one without words, has no
words and no hit; an item without words (or null) has no window; items of one id are one item;
the windows of an item without id mark words but the item is neither counted nor listed; equal
rows each get their row; windows never span two texts; no texts give no rows, no items no hits;
further columns are not read by :func:`scan` and are carried by :func:`remove`.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from riskloom.llm.common import keep

# ---- fixed values: words and what stands between them -------------------------
LOWER_WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORDS_OR_GAPS = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+|[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
STARTS_WITH_WORD = r"^[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# ---- end of fixed values -----------------------------------------------------

WIDTH = 10
BROADCAST_BYTES = 64 << 20
# A row of the broadcast table beyond its strings: headers, lengths and offsets of its arrays.
ROW_BYTES, WORD_BYTES = 128, 24


def words(text: Column) -> Column:
    """Words of a text, A-Z lower-cased; a null text has none."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    # Letters beyond A-Z keep their case, so only a text of ASCII alone may be lower-cased at once.
    ascii_only = F.octet_length(text) == F.char_length(text)
    lower = F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return F.regexp_extract_all(lower, F.lit(LOWER_WORDS), F.lit(0))


def windows(items: DataFrame, width: int = WIDTH, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``_len, _hash, _found``: a row per window hash, with the windows it stands for and their items."""
    cut = items.select(F.col(id_col).cast("string").alias("_item"), words(F.col(text_col)).alias("_words")).filter(
        F.size("_words") > 0
    )
    size = F.least(F.size("_words"), F.lit(width))
    starts = F.sequence(F.lit(1), F.size("_words") - size + 1)
    each = cut.select("_item", F.explode(F.transform(starts, lambda s: F.slice("_words", s, size))).alias("_window"))
    held = each.groupBy("_window").agg(F.array_sort(F.collect_set("_item")).alias("_items"))
    return (
        # Hashed as the scan does it: a chain over the words, not over the array.
        held.withColumn("_len", F.size("_window"))
        .withColumn("_hash", F.xxhash64(*[F.get("_window", F.lit(k)) for k in range(width)]))
        .groupBy("_len", "_hash")
        .agg(F.collect_list(F.struct("_window", "_items")).alias("_found"))
    )


def _slices(table: DataFrame, broadcast_bytes: int) -> tuple[list[int], list[DataFrame]]:
    """The lengths among the windows, and the table in parts that are small enough to broadcast."""
    per_window = lambda f: (
        F.aggregate(f["_window"], F.lit(0).cast("long"), lambda n, w: n + F.octet_length(w) + F.lit(WORD_BYTES))
        + F.aggregate(f["_items"], F.lit(0).cast("long"), lambda n, i: n + F.octet_length(i) + F.lit(WORD_BYTES))
    )
    size = F.aggregate("_found", F.lit(ROW_BYTES).cast("long"), lambda n, f: n + per_window(f))
    # A row per length, of which there are at most ``width``.
    sizes = table.groupBy("_len").agg(F.sum(size).alias("bytes")).collect()
    parts = max(1, math.ceil(sum(r["bytes"] for r in sizes) / broadcast_bytes))
    lengths = sorted(r["_len"] for r in sizes)
    if parts == 1:
        return lengths, [table]
    number = F.pmod(F.xxhash64(F.lit("slice"), "_hash"), F.lit(parts))
    return lengths, [table.filter(number == p) for p in range(parts)]


def scan(
    docs: DataFrame, items: DataFrame, width: int = WIDTH, broadcast_bytes: int = BROADCAST_BYTES,
    id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """One row per document: ``doc_id, text_md5, n_words, n_hit, spans, items``.

    ``spans`` are the hit runs of words as ``(from, to)``, the first word being 0 and ``to``
    exclusive; ``items`` are the sorted ids of the items found.
    """
    table = keep(windows(items, width, item_id_col, item_text_col), "benchmark-windows")
    lengths, parts = _slices(table, broadcast_bytes)
    text = F.col(text_col).cast("string")
    cut = docs.select(
        F.col(id_col).alias("_id"), F.md5(F.coalesce(text, F.lit("")).cast("binary")).alias("_md5"),
        words(F.col(text_col)).alias("_words"),
    )
    placed = cut.select("_id", "_md5", "_words", F.posexplode_outer("_words").alias("_pos", "_word")).drop("_word")
    keys = [
        F.struct(
            F.lit(n).alias("_len"), F.xxhash64(*[F.get("_words", F.col("_pos") + k) for k in range(n)]).alias("_hash")
        )
        for n in lengths
    ]
    # The first row of a text stands for it, hit or not.
    first = F.coalesce(F.col("_pos") == 0, F.lit(True))
    if not keys:
        keys = [F.struct(F.lit(0).alias("_len"), F.lit(None).cast("long").alias("_hash"))]
    looked = placed.select("_id", "_md5", "_words", "_pos", F.inline(F.array(*keys)))
    rows = None
    for number, part in enumerate(parts):
        # No function with a lambda here: the words would leave the compiled stage at every position.
        found = looked.join(F.broadcast(part), ["_len", "_hash"], "left").select(
            "_id", "_md5", "_words", "_pos", "_len", F.posexplode_outer("_found").alias("_nth", "_each")
        )
        same = F.coalesce(F.col("_each._window") == F.slice("_words", F.col("_pos") + 1, F.col("_len")), F.lit(False))
        stands = first & (F.col("_len") == (lengths or [0])[0]) & (F.coalesce("_nth", F.lit(0)) == 0) & F.lit(number == 0)
        hits = found.filter(same | stands).select(
            "_id", "_md5", F.size("_words").alias("_n"), stands.alias("_first"),
            F.when(same, F.struct(F.col("_pos").alias("from"), (F.col("_pos") + F.col("_len")).alias("to"))).alias("_span"),
            F.when(same, F.col("_each._items")).alias("_items"),
        )
        rows = hits if rows is None else rows.unionAll(hits)
    merged = (
        rows.groupBy("_id", "_md5")
        .agg(
            F.max("_n").alias("_n"), F.sum(F.col("_first").cast("int")).alias("_copies"),
            F.array_sort(F.collect_set("_span")).alias("_spans"), F.collect_set("_items").alias("_items"),
        )
        .withColumn("_spans", _joined("_spans"))
    )
    return merged.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int")))).select(
        F.col("_id").alias("doc_id"), F.col("_md5").alias("text_md5"), F.col("_n").cast("long").alias("n_words"),
        F.aggregate("_spans", F.lit(0).cast("long"), lambda n, s: n + s["to"] - s["from"]).alias("n_hit"),
        F.col("_spans").alias("spans"),
        F.array_sort(F.array_distinct(F.flatten("_items"))).alias("items"),
    )


def _joined(spans: str) -> Column:
    """Sorted spans with those that touch or overlap made one."""
    empty = F.array().cast("array<struct<from:int,to:int>>")
    state = F.struct(empty.alias("done"), F.lit(None).cast("struct<from:int,to:int>").alias("open"))

    def step(at, span):
        apart = at["open"].isNotNull() & (span["from"] > at["open"]["to"])
        done = F.when(apart, F.concat(at["done"], F.array(at["open"]))).otherwise(at["done"])
        begin = F.when(at["open"].isNull() | apart, span["from"]).otherwise(at["open"]["from"])
        end = F.when(at["open"].isNull() | apart, span["to"]).otherwise(F.greatest(at["open"]["to"], span["to"]))
        return F.struct(done.alias("done"), F.struct(begin.alias("from"), end.alias("to")).alias("open"))

    last = lambda at: F.when(at["open"].isNull(), at["done"]).otherwise(F.concat(at["done"], F.array(at["open"])))
    return F.aggregate(spans, state, step, last)


def remove(
    docs: DataFrame, items: DataFrame, what: str = "spans", id_col: str = "doc_id", text_col: str = "text", **settings
) -> DataFrame:
    """``docs`` without contaminated ``"documents"``, or without the hit ``"spans"`` of their texts.

    A span goes from its first word to its last, with what stands between them. All columns are kept.
    """
    if what not in ("spans", "documents"):
        raise ValueError("what is removed is 'spans' or 'documents'")
    found = scan(docs, items, id_col=id_col, text_col=text_col, **settings).filter("n_hit > 0")
    hit = found.select(F.col("doc_id").alias("_id"), F.col("text_md5").alias("_md5"), F.col("spans").alias("_spans"))
    hit = hit.dropDuplicates(["_id", "_md5"])
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    whole = docs.select(F.struct("*").alias("_doc"), F.col(id_col).alias("_own"), text.alias("_text"))
    whole = whole.withColumn("_digest", F.md5(F.col("_text").cast("binary")))
    same = F.col("_own").eqNullSafe(F.col("_id")) & (F.col("_digest") == F.col("_md5"))
    if what == "documents":
        return whole.join(hit, same, "left_anti").select("_doc.*")
    # Words and gaps take turns, so word k is token 2k, or 2k + 1 where a gap comes first.
    tokens = F.regexp_extract_all("_text", F.lit(WORDS_OR_GAPS), F.lit(0))
    ahead = F.when(F.regexp_like("_text", F.lit(STARTS_WITH_WORD)), 0).otherwise(1)
    both = whole.join(hit, same, "left").withColumns({"_tokens": F.when(F.col("_spans").isNotNull(), tokens), "_ahead": ahead})
    begins = F.concat(F.array(F.lit(0)), F.transform("_spans", lambda s: F.col("_ahead") + s["to"] * 2 - 1))
    ends = F.concat(F.transform("_spans", lambda s: F.col("_ahead") + s["from"] * 2), F.array(F.size("_tokens")))
    parts = F.zip_with(begins, ends, lambda a, b: F.array_join(F.slice("_tokens", a + 1, F.greatest(b - a, F.lit(0))), ""))
    clean = F.when(F.col("_spans").isNull(), F.col("_doc")[text_col]).otherwise(F.array_join(parts, ""))
    return both.withColumn("_doc", F.col("_doc").withField(f"`{text_col}`", clean)).select("_doc.*")
