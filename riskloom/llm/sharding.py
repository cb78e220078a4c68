"""A reproducible shuffle into shards: a Feistel permutation of global row numbers.

Rows are numbered in the order of (id, size, checksum), whatever files they come from. A keyed
Feistel network permutes the numbers below a power of two, and numbers that leave the table are
sent through it again until they fall inside (cycle walking), so the table's own numbers are
permuted. Place ``p`` belongs to shard ``p mod shards`` at slot ``p div shards``: shard sizes
differ by one row at most, and a place can be computed, and undone, from the number alone.

Only ids, sizes and checksums are shuffled, never texts. The range keys end in the row's scan
position, so a repeated id, or a row repeated without end, spreads over several ranges. One row
per partition is broadcast to turn positions in a partition into global numbers.

Defined cases: a null text has size 1 and the checksum of no bytes; null ids sort first; rows
that agree in id, size and checksum are interchangeable; no rows give no rows; further columns
are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from riskloom.llm.common import keep, text_bytes

ROUNDS = 6
PRIME = (1 << 31) - 1
# At least half of the numbers lie inside, so a row is still outside after all walks with
# probability 2**-137; nearly all rows end in the first few.
FEW_WALKS, MORE_WALKS = 8, 128


def round_keys(seed: int) -> list[tuple[int, int]]:
    """A multiplier and an addend below the prime for each round."""
    keys, state = [], (seed * 2 + 1) % PRIME
    for _ in range(ROUNDS):
        pair = []
        for _ in range(2):
            state = (state * 48271 + 11) % PRIME
            pair.append(state or 1)
        keys.append(tuple(pair))
    return keys


def half_bits(rows: int) -> tuple[int, int]:
    """Bits of the upper and lower half of the smallest power of two that holds all rows."""
    bits = max(2, (max(rows, 1) - 1).bit_length())
    return bits - bits // 2, bits // 2


def _with(value: Column, body) -> Column:
    """``body(value)``, where ``value`` is computed once however often it is used."""
    return F.element_at(F.transform(F.array(value), body), 1)


def feistel(x: Column, rows: int, seed: int) -> Column:
    """One pass of the network. A round squares modulo a prime, which stays below 2**62."""
    upper_bits, lower_bits = half_bits(rows)
    keys = round_keys(seed)

    def step(i: int, upper: Column, lower: Column) -> Column:
        if i == len(keys):
            return F.shiftleft(upper, lower_bits).bitwiseOR(lower)
        factor, plus = keys[i]
        source, target, bits = (lower, upper, upper_bits) if i % 2 == 0 else (upper, lower, lower_bits)
        t = (source * F.lit(factor) + F.lit(plus)) % F.lit(PRIME)
        mixed = lambda t: F.shiftright((t * t) % F.lit(PRIME), 3).bitwiseAND(F.lit((1 << bits) - 1))
        changed = _with(t, lambda t: target.bitwiseXOR(mixed(t)))
        if i % 2 == 0:
            return _with(changed, lambda new: step(i + 1, new, lower))
        return _with(changed, lambda new: step(i + 1, upper, new))

    return _with(
        F.shiftright(x, lower_bits),
        lambda upper: _with(x.bitwiseAND(F.lit((1 << lower_bits) - 1)), lambda lower: step(0, upper, lower)),
    )


def _walked(p: Column, rows: int, seed: int, most: int) -> Column:
    return F.aggregate(
        F.sequence(F.lit(1), F.lit(most)), p,
        lambda at, _: F.when(at < F.lit(rows), at).otherwise(feistel(at, rows, seed)),
    )


def permuted(df: DataFrame, number: str, rows: int, seed: int, out: str) -> DataFrame:
    """Add ``out``: the place of row ``number`` under the permutation of ``rows`` numbers."""
    inside = F.col(out) < F.lit(rows)
    df = df.withColumn(out, feistel(F.col(number), rows, seed))
    for most in (FEW_WALKS, MORE_WALKS):
        df = df.withColumn(out, F.when(inside, F.col(out)).otherwise(_walked(F.col(out), rows, seed, most)))
    return df.withColumn(
        out, F.when(inside, F.col(out)).otherwise(F.raise_error(F.lit("the walk did not end")))
    )


def numbered(df: DataFrame, keys: list[str], out: str) -> tuple[DataFrame, int]:
    """Rows with their global number in the order of ``keys``, and how many there are."""
    placed = keep(
        df.withColumn("_scan", F.monotonically_increasing_id())
        .repartitionByRange(*keys, "_scan")
        .sortWithinPartitions(*keys)
        .drop("_scan")
        .withColumn("_at", F.monotonically_increasing_id()),
        "numbered",
    )
    part = F.shiftright("_at", 33)
    counts = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("_part", "_n", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    rows = counts.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
    joined = placed.withColumn("_part", part).join(F.broadcast(bases.drop("_n")), "_part")
    local = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return joined.withColumn(out, F.col("_base") + local).drop("_part", "_base", "_at"), rows


def shard(
    docs: DataFrame, shards: int = 8, seed: int = 20, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """``doc_id, size, text_crc32, law, row, shard, slot, grown_shard`` of every document."""
    slim = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text_bytes(text_col)) + 1).cast("long").alias("size"),
        F.crc32(text_bytes(text_col)).alias("text_crc32"),
    )
    rows_in_order, rows = numbered(slim, ["doc_id", "size", "text_crc32"], "row")
    placed = permuted(rows_in_order, "row", rows, seed, "_place")
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "row",
        (F.col("_place") % F.lit(shards)).cast("int").alias("shard"),
        F.expr(f"_place div {shards}").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
