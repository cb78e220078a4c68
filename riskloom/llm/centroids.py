"""Centroid clustering on bit planes: exact distances from popcounts of 64-bit words.

The components of a vector become integers, ``floor(scale * x)``. Written in two's complement,
bit ``b`` of all 64 components is one 64-bit word, the plane ``b``, which weighs ``2^b`` (the
last one ``-2^b``). A dot product is then the sum over pairs of planes of their weights times
the number of ones in their AND, and a squared distance is ``v.v - 2 v.c + c.c``: integers, no
rounding. Planes are packed once and stored; each round is one narrow pass over them, in which
a task adds up its members per centroid, so only a row per centroid, component and limb of the
sums is shuffled and ``k * 64`` rows reach the driver, which divides them with floor.

Memory is bounded by a slice of rows times ``k``. As many planes are used as the largest
component needs: up to ``NARROW`` of them a distance fits a long and 64-bit arithmetic is used,
beyond them counts are combined as whole numbers of any size.

Defined cases: a vector that is null, has not 64 components, or holds a null or non-finite one
takes no part; equal vectors and repeated ids are rows of their own; a centroid that loses its
rows stays where it is; ties go to the smaller number; fewer vectors than ``k`` give as many
centroids; rows without id are clustered and become seeds only when no others are left; no
vectors give no rows; a distance or inertia that does not fit a long is an error; further
columns are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from riskloom.llm.common import keep, row_batch
from riskloom.llm.vectors import usable

DIM = 64
NARROW = 28
LIMB_BITS = 20
ROWS = 4096
LONGEST = (1 << 63) - 1

_SUMS = pa.schema(
    [("cluster", pa.int32()), ("component", pa.int32()), ("limb", pa.int32()), ("n", pa.int64()), ("total", pa.int64())]
)


def scaled(x: np.ndarray, scale: int, bits: int) -> np.ndarray:
    """``floor(scale * x)`` of doubles, as longs where they fit and as whole numbers elsewhere."""
    if bits <= 62:
        return np.floor(x * scale).astype(np.int64)
    whole = [math.floor(Fraction(v) * scale) for v in x.ravel().tolist()]
    return np.array(whole, object).reshape(x.shape)


def planes_of(q: np.ndarray, bits: int) -> np.ndarray:
    """Bit planes ``(n, bits)`` of integers ``(n, 64)``, the sign in the last one."""
    out = np.empty((len(q), bits), "<u8")
    for b in range(bits):
        ones = ((q >> b) & 1).astype(np.uint8)
        out[:, b] = np.packbits(ones, axis=1, bitorder="little").view("<u8")[:, 0]
    return out


def weights_of(bits: int) -> list[int]:
    return [1 << b for b in range(bits - 1)] + [-(1 << (bits - 1))]


def dots(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Dot products of planes that broadcast against each other but for their last axis."""
    bits = left.shape[-1]
    weights = weights_of(bits)
    shape = np.broadcast_shapes(left.shape[:-1], right.shape[:-1])
    total = np.zeros(shape, np.int64 if bits <= NARROW else object)
    for i in range(bits):
        # Pairs of planes with one weight are counted together: 64 * bits fits a small integer.
        for j in range(bits):
            ones = np.bitwise_count(left[..., i] & right[..., j]).astype(np.int64)
            total += (ones if bits <= NARROW else ones.astype(object)) * (weights[i] * weights[j])
    return total


def nearest(rows: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid of each row, and its squared distance."""
    own, other = dots(rows, rows), dots(centroids, centroids)
    squared = own[:, None] - 2 * dots(rows[:, None, :], centroids[None, :, :]) + other[None, :]
    best = np.argmin(squared, axis=1)
    return best, squared[np.arange(len(rows)), best]


def member_sums(rows: np.ndarray, cluster: np.ndarray, k: int) -> np.ndarray:
    """Sums of limbs ``(k, 64, limbs)``: counts of ones per plane, weighted within each limb."""
    bits = rows.shape[1]
    member = np.zeros((k, len(rows)), np.float32)
    member[cluster, np.arange(len(rows))] = 1
    out = np.zeros((k, DIM, -(-bits // LIMB_BITS)), np.int64)
    for b in range(bits):
        ones = np.unpackbits(rows[:, b].copy().view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        # Exact: a slice has far fewer rows than a float has whole numbers.
        counts = (member @ ones.astype(np.float32)).astype(np.int64)
        sign = -1 if b == bits - 1 else 1
        out[:, :, b // LIMB_BITS] += sign * (counts << (b % LIMB_BITS))
    return out


def _planes(column: pa.Array, bits: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u8").reshape(-1, bits)


def _slices(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            yield batch.slice(at, ROWS)


def packed(vectors: DataFrame, scale: int, seed: str, id_col: str, vector_col: str) -> tuple[DataFrame, int]:
    """The usable vectors as ``_id, _seed, _planes``, stored, and their number of planes."""
    vector = F.col(vector_col).cast("array<double>")
    used = vectors.select(F.col(id_col).alias("_id"), vector.alias("_v")).filter(
        usable(F.col("_v")) & (F.size("_v") == DIM)
    )
    largest = used.agg(F.max(F.array_max(F.transform("_v", F.abs)))).first()[0]
    bits = math.ceil(Fraction(largest or 0.0) * scale).bit_length() + 1

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            x = np.asarray(pc.list_flatten(batch.column("_v")), np.float64).reshape(-1, DIM)
            rows = planes_of(scaled(x, scale, bits), bits)
            ids = batch.column("_id")
            binary = pa.array([r.tobytes() for r in rows], pa.binary())
            yield pa.RecordBatch.from_arrays([ids, batch.column("_seed"), binary], ["_id", "_seed", "_planes"])

    keyed = used.withColumn("_seed", F.sha2(F.concat(F.lit(f"{seed}:"), F.col("_id").cast("string")), 256))
    kind = dict(used.dtypes)["_id"]
    return keep(keyed.mapInArrow(pack, f"_id {kind}, _seed string, _planes binary"), "planes"), bits


def _round(rows: DataFrame, centroids: np.ndarray) -> dict[int, tuple[int, list[int]]]:
    """Members and component sums of every centroid that has members."""
    k, bits = centroids.shape

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = None, np.zeros(k, np.int64)
        for batch in _slices(batches):
            own = _planes(batch.column("_planes"), bits)
            cluster, _ = nearest(own, centroids)
            part = member_sums(own, cluster, k)
            sums = part if sums is None else sums + part
            counts += np.bincount(cluster, minlength=k)
        if sums is not None:
            held = np.flatnonzero(counts)
            c, d, limb = (a.ravel() for a in np.meshgrid(held, range(DIM), range(sums.shape[2]), indexing="ij"))
            yield row_batch(_SUMS, c, d, limb, counts[c], sums[c, d, limb])

    totals = rows.select("_planes").mapInArrow(add, "cluster int, component int, limb int, n long, total long")
    out: dict[int, tuple[int, list[int]]] = {}
    for r in totals.groupBy("cluster", "component", "limb").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect():
        _, sums = out.setdefault(r["cluster"], (r["n"], [0] * DIM))
        sums[r["component"]] += r["total"] << (LIMB_BITS * r["limb"])
    return out


def cluster(
    vectors: DataFrame, k: int = 40, rounds: int = 5, scale: int = 256, seed: str = "2", id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> tuple[DataFrame, DataFrame]:
    """Assigned rows ``(vec_id, cluster, distance)`` and the table of centroids.

    The latter has ``(cluster, centroid, n, cluster_inertia, inertia, centroid_sha256)``,
    a centroid being its components as decimal integers joined by commas.
    """
    rows, bits = packed(vectors, scale, seed, id_col, vector_col)
    spark = vectors.sparkSession
    first = rows.orderBy(F.asc_nulls_last("_seed"), "_planes").select("_planes").limit(k).collect()
    planes = np.array([np.frombuffer(r["_planes"], "<u8") for r in first], "<u8").reshape(-1, bits)
    weights = weights_of(bits)
    centroids = [[0] * DIM for _ in first]
    for c, own in zip(centroids, planes.tolist()):
        for w, plane in zip(weights, own):
            for d in range(DIM):
                c[d] += w * (plane >> d & 1)
    for _ in range(rounds if centroids else 0):
        for c, (n, sums) in _round(rows, planes).items():
            centroids[c] = [s // n for s in sums]
        planes = planes_of(np.array(centroids, object), bits)

    def assign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            number, squared = nearest(_planes(batch.column("_planes"), bits), planes)
            if len(squared) and max(squared) > LONGEST:
                raise OverflowError("a squared distance does not fit a long")
            columns = [batch.column("_id"), pa.array(number, pa.int32()), pa.array(squared.tolist(), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "cluster", "distance"])

    schema = f"vec_id {dict(rows.dtypes)['_id']}, cluster int, distance long"
    assigned = keep(rows.select("_id", "_planes").mapInArrow(assign, schema), "assigned") if centroids else (
        spark.createDataFrame([], schema)
    )
    found = assigned.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")
    )
    held = {r["cluster"]: (r["n"], int(r["total"])) for r in found.collect()}
    inertia = sum(total for _, total in held.values())
    if inertia > LONGEST:
        raise OverflowError("the inertia does not fit a long")
    spelled = [",".join(map(str, c)) for c in centroids]
    table = [
        (i, text, *held.get(i, (0, 0)), inertia, hashlib.sha256(text.encode()).hexdigest())
        for i, text in enumerate(spelled)
    ]
    return assigned, spark.createDataFrame(
        table, "cluster int, centroid string, n long, cluster_inertia long, inertia long, centroid_sha256 string"
    )
