"""Exact top-k inner products by norm-bucketed retrieval.

Distinct vectors are range-partitioned by descending length and cut into buckets of bounded
size; queries are cut into blocks. The longest buckets give each query a first k-th score. A
query then needs a cosine of at least ``score / (|query| * longest in the bucket)`` in another
bucket: above 1 the bucket is skipped; above ``coordinate_from`` the query's largest coordinates
bound those of any partner, and vectors outside the bounds are dropped; below it only vectors
long enough for the score are kept. What is left is verified with exact integer products.

Query blocks meet buckets by an equality join on the partition of the bucket, and only
partitions whose longest vector can still reach the block's lowest score take part. Bounded
pieces meet in a task: one block and one bucket. Only the longest vector of each partition comes
to the driver.

Defined cases: vectors that are null, empty or hold a null or non-finite component take no part,
nor do those with a scaled component of 2**27 or more, whose score may not fit a long; vectors
are compared with vectors of the same dimension; repeated rows of one id and vector count once;
zero vectors score 0; an empty table or query set gives no rows; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from riskloom.llm.common import keep, row_batch
from riskloom.llm.vectors import best, classes, usable

BUCKET_ROWS, BLOCK_ROWS = 2048, 256
COORDINATE_FROM, COORDINATES = 0.35, 8
# Doubles at or above this are whole numbers.
WHOLE_FROM = float(1 << 53)
LOWEST, HIGHEST = -(1 << 63), (1 << 63) - 1
_SLACK = 1e-9

_BUCKETS = "part long, bucket long, dim int, longest double, vectors binary, counts binary, members binary"
_BUCKET_ROWS = pa.schema(
    [("part", pa.int64()), ("bucket", pa.int64()), ("dim", pa.int32()), ("longest", pa.float64()),
     ("vectors", pa.binary()), ("counts", pa.binary()), ("members", pa.binary())]
)
_FOUND = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(-1, dim)


def _by_dim(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    dims = np.asarray(batch.column("_dim"))
    for dim in np.unique(dims):
        yield int(dim), batch.filter(pa.array(dims == dim))


def _buckets(size: int):
    """Rows in descending length to one row per bucket of at most ``size`` vectors."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, n = TaskContext.get().partitionId(), 0
        for batch in batches:
            for dim, rows in _by_dim(batch):
                for at in range(0, rows.num_rows, size):
                    piece = rows.slice(at, size)
                    members = piece.column("_members")
                    yield row_batch(
                        _BUCKET_ROWS, [part], [(part << 32) + n], [dim],
                        [max(piece.column("_length").to_pylist())],
                        [_matrix(piece.column("_v"), dim).astype("<f8").tobytes()],
                        [np.asarray(pc.list_value_length(members)).astype("<i4").tobytes()],
                        [np.asarray(members.flatten()).astype("<i8").tobytes()],
                    )
                    n += 1

    return run


_BLOCKS = "block long, dim int, asked long, norm double, ids binary, queries binary"
_BLOCK_ROWS = pa.schema(
    [("block", pa.int64()), ("dim", pa.int32()), ("asked", pa.int64()), ("norm", pa.float64()),
     ("ids", pa.binary()), ("queries", pa.binary())]
)


def _blocks(size: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, n = TaskContext.get().partitionId(), 0
        for batch in batches:
            for dim, rows in _by_dim(batch):
                for at in range(0, rows.num_rows, size):
                    piece = rows.slice(at, size)
                    queries = _matrix(piece.column("_v"), dim)
                    norm = float(np.sqrt((queries.astype(np.float64) ** 2).sum(1)).max())
                    yield row_batch(
                        _BLOCK_ROWS, [(part << 32) + n], [dim], [piece.num_rows], [norm],
                        [np.asarray(piece.column("_id")).astype("<i8").tobytes()],
                        [queries.astype("<f8").tobytes()],
                    )
                    n += 1

    return run


def candidates(
    query: np.ndarray, norm: float, least: float, vectors: np.ndarray, lengths: np.ndarray,
    units: np.ndarray, coordinate_from: float = COORDINATE_FROM,
) -> np.ndarray | None:
    """Rows of a bucket that may reach ``least``; None stands for all of them."""
    longest = lengths[0] if len(lengths) else 0.0
    if not np.isfinite(least) or least <= 0 or norm == 0 or longest == 0:
        # A zero query or bucket scores 0 throughout, so only a positive bound excludes it.
        return None if not least > 0 else np.empty(0, np.int64)
    cosine = least / (norm * longest) * (1 - _SLACK)
    if cosine > 1:
        return np.empty(0, np.int64)
    if cosine < coordinate_from:
        reach = np.searchsorted(-lengths, -(least / norm) * (1 - _SLACK), "right")
        return None if reach == len(lengths) else np.arange(reach)
    unit = query / norm
    ok = np.ones(len(vectors), bool)
    for f in np.argsort(-np.abs(unit))[:COORDINATES]:
        spread = np.sqrt((1 - cosine * cosine) * max(0.0, 1 - unit[f] * unit[f])) + _SLACK
        ok &= np.abs(units[:, f] - unit[f] * cosine) <= spread if abs(unit[f]) < cosine else (
            (units[:, f] >= unit[f] * cosine - spread) if unit[f] > 0 else (units[:, f] <= unit[f] * cosine + spread)
        )
    return np.flatnonzero(ok)


def products(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Exact products of doubles that hold whole numbers.

    In doubles while every partial sum is below 2**53, in longs while it fits one, and as whole
    numbers of any size beyond that.
    """
    top = float(np.abs(queries).max(initial=0)) * float(np.abs(vectors).max(initial=0)) * queries.shape[-1]
    if top < 2.0**53:
        return (queries @ vectors.T).astype(np.int64)
    if top < 2.0**62:
        return queries.astype(np.int64) @ vectors.T.astype(np.int64)
    whole = [np.array([int(x) for x in m.ravel().tolist()], object).reshape(m.shape) for m in (queries, vectors)]
    return whole[0] @ whole[1].T


def _fitting(scores: np.ndarray) -> list[int]:
    """Scores as longs. One that is too large is an error, one that is too low is the lowest long."""
    found = scores.tolist()
    if any(s > HIGHEST for s in found):
        raise OverflowError("a score does not fit a long")
    return [max(s, LOWEST) for s in found]


def _search(k: int):
    """Each row is a block of queries, their bounds and a bucket."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i].as_py() for name in batch.schema.names}
                dim = row["dim"]
                ids = np.frombuffer(row["ids"], "<i8")
                queries = np.frombuffer(row["queries"], "<f8").reshape(-1, dim)
                vectors = np.frombuffer(row["vectors"], "<f8").reshape(-1, dim)
                bounds = dict(zip(row["bound_ids"] or (), row["bounds"] or ()))
                out = _top(
                    k, ids, queries, bounds, vectors, np.frombuffer(row["counts"], "<i4"),
                    np.frombuffer(row["members"], "<i8"),
                )
                yield row_batch(_FOUND, *out)

    return run


def _top(k, ids, queries, bounds, vectors, counts, members):
    wide = vectors.astype(np.float64)
    lengths = np.sqrt((wide * wide).sum(1))
    units = wide / np.where(lengths == 0, 1, lengths)[:, None]
    norms = np.sqrt((queries.astype(np.float64) ** 2).sum(1))
    starts = np.concatenate(([0], np.cumsum(counts)))
    found: list[list] = [[], [], []]
    for own, query, norm in zip(ids.tolist(), queries, norms.tolist()):
        rows = candidates(query, norm, float(bounds.get(own, -np.inf)), vectors, lengths, units)
        if rows is not None and not len(rows):
            continue
        rows = np.arange(len(vectors)) if rows is None else rows
        scores = products(query[None], vectors[rows])[0]
        if len(scores) > k + 1:  # one of the classes may hold nothing but the query itself
            order = np.sort(scores) if scores.dtype == object else np.partition(scores, len(scores) - k - 1)
            near = scores >= order[len(scores) - k - 1]
            rows, scores = rows[near], scores[near]
        n = counts[rows]
        flat = np.concatenate([members[starts[r] : starts[r + 1]] for r in rows.tolist()])
        scores = np.repeat(scores, n)
        other = flat != own
        flat, scores = flat[other], scores[other]
        if scores.dtype == object:
            pick = np.array(sorted(range(len(flat)), key=lambda i: (-scores[i], flat[i]))[:k], np.int64)
        else:
            pick = np.lexsort((flat, -scores))[:k]
        found[0] += [own] * len(pick)
        found[1] += flat[pick].tolist()
        found[2] += _fitting(scores[pick])
    return found


def search(
    vectors: DataFrame, is_query: Column, k: int = 10, scale: int = 1024, first_buckets: int = 2,
    id_col: str = "vec_id", vector_col: str = "embedding", bucket_rows: int = BUCKET_ROWS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` highest integer scores of every query."""
    def whole(x: Column) -> Column:
        y = x.cast("double") * scale
        return F.when(F.abs(y) < WHOLE_FROM, F.floor(y).cast("double")).otherwise(y)

    scaled = F.transform(F.col(vector_col), whole)
    rows = (
        vectors.filter(usable(F.col(vector_col)))
        .select(F.col(id_col).cast("long").alias("_id"), scaled.alias("_v"), is_query.alias("_asked"))
        .filter(F.col("_id").isNotNull())
    )
    length = F.sqrt(F.aggregate("_v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    buckets = keep(
        classes(rows, k + 1)
        .withColumns({"_length": length, "_dim": F.size("_v"), "_tie": F.xxhash64("_v")})
        .repartitionByRange(F.desc("_length"), "_tie")
        .sortWithinPartitions("_dim", F.desc("_length"), "_tie")
        .select("_v", "_members", "_length", "_dim")
        .mapInArrow(_buckets(bucket_rows), _BUCKETS),
        "norm-buckets",
    )
    asked = keep(rows.filter("_asked").select("_id", "_v").distinct().withColumn("_dim", F.size("_v")), "queries")
    groups = max(1, -(-asked.count() // block_rows))
    blocks = keep(
        asked.repartition(F.pmod(F.xxhash64("_id"), F.lit(groups)))
        .sortWithinPartitions("_dim", "_id", "_v")
        .mapInArrow(_blocks(block_rows), _BLOCKS),
        "query-blocks",
    )
    # The buckets with the longest vectors of each dimension give the first bounds.
    firsts = buckets.select("bucket", "dim", "longest").orderBy(F.desc("longest"), "bucket").limit(first_buckets)
    names = [r["bucket"] for r in firsts.collect()]
    unbounded = {"bound_ids": F.lit(None).cast("array<long>"), "bounds": F.lit(None).cast("array<long>")}
    openers = blocks.withColumn("bucket", F.explode(F.lit(names).cast("array<long>")))
    first = keep(_found(openers.join(buckets, ["bucket", "dim"]).withColumns(unbounded), k), "first-found")
    kth = best(first, k).filter(F.col("rank") == k)
    bounds = (
        kth.join(_owners(blocks), "query_id")
        .groupBy("block")
        .agg(F.collect_list(F.struct("query_id", "score")).alias("_b"))  # at most a block of them
    )
    bounded = blocks.join(bounds, "block", "left").withColumns(
        {"bound_ids": F.col("_b.query_id"), "bounds": F.col("_b.score")}
    )
    # Partitions the block's lowest bound rules out are left before anything is joined.
    parts = buckets.groupBy("part").agg(F.max("longest").alias("longest")).collect()
    reach = F.array(*[F.struct(F.lit(r["part"]).alias("part"), F.lit(r["longest"]).alias("longest")) for r in parts])
    least = F.when(F.size("bounds") == F.col("asked"), F.array_min("bounds"))
    near = F.filter(
        reach, lambda p: least.isNull() | (F.col("norm") * p["longest"] * (1 + _SLACK) >= least)
    ) if parts else F.array().cast("array<struct<part:bigint,longest:double>>")
    later = buckets.filter(~F.col("bucket").isin(names)).drop("longest")
    rest = bounded.withColumn("part", F.explode(near["part"])).join(later, ["part", "dim"])
    lowest = F.raise_error(F.lit("a score does not fit a long")).cast("long")
    return best(first.unionByName(_found(rest, k)), k).withColumn(
        "score", F.when(F.col("score") == LOWEST, lowest).otherwise(F.col("score"))
    )


def _owners(blocks: DataFrame) -> DataFrame:
    """``(query_id, block)`` of every query."""
    shape = pa.schema([("query_id", pa.int64()), ("block", pa.int64())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, ids in zip(batch.column("block").to_pylist(), batch.column("ids").to_pylist()):
                ids = np.frombuffer(ids, "<i8")
                yield row_batch(shape, ids, np.full(len(ids), block))

    return blocks.select("block", "ids").mapInArrow(run, "query_id long, block long").distinct()


def _found(pairs: DataFrame, k: int) -> DataFrame:
    columns = ["dim", "ids", "queries", "vectors", "counts", "members", "bound_ids", "bounds"]
    return pairs.select(*columns).mapInArrow(_search(k), "query_id long, vec_id long, score long")
