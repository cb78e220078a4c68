"""Exact similarity join of documents on word shingles, by token-combination prefixes.

Texts with the same set of shingles are one node. Shingles are ordered by frequency class, then
by hash. Two sets with a Jaccard similarity of at least ``percent`` share all but ``e`` of the
shingles of either, so it suffices to index a prefix that is longer than ``e``:

* a shingle of the rare class is a key by itself and adds one to what the prefix covers;
* shingles of a frequent class are dealt to cells by hash. A cell with ``n`` shingles of the
  prefix has all its combinations of ``k`` as keys, and adds ``n - (k - 1)``, for a pair without
  a common combination shares fewer than ``k`` of them.

The prefix ends once its coverage exceeds ``e``. Of two similar sets, the one whose prefix ends
first in the order has all shared shingles of that prefix in the other's too, so one rare
shingle or one combination is common to both. The number of cells follows the size of a set; a
set has keys for its own size band and the next, and similar sets share one of the two.

Classes come from counts of all shingles of all documents, as hashed cells; ``rare_below`` rises
with their total so that at most ``most_frequent`` cells are frequent, which bounds what is sent
to the tasks. Any class is right as long as it depends on the shingle alone.

Keys shared by several sets are buckets. In rounds, every member is compared with the bucket's
most connected one, and what links is one component; pairs inside a component need no more
comparison, and buckets that one component covers are closed. When rounds link hardly more,
pairs of different components are filtered inside their bucket by sizes and bit sketches, which
bound an overlap from above, and only what passes becomes rows. Exact sets decide every pair. So
a group of copies costs a few comparisons per member, and no link between components is missed.

Defined cases: a text that is null or without words has no shingles and is linked with nothing;
rows of one id that differ in text are documents of their own; a null id never names a
component; no rows give no rows; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from riskloom.llm.common import keep, slices
from riskloom.llm.components import components
from riskloom.llm.shingles import as_long, mix, set_key, word_shingles

WORDS, PERCENT = 5, 80
CELL_BITS = 30
RARE_BELOW, MOST_FREQUENT = 32, 1 << 22
STEP = 64  # a class starts at this many times the count of the one before it
MOST_COMBINED = 3
CELL_LOAD = 4  # expected shingles of a set per cell of a frequent class
SMALL_BAND = 5  # sets below 2**6 shingles are indexed by single shingles only
SKETCH_BITS = 4096
BLOCK = 2048  # members of a bucket that are compared in one task
COUNT_RANGES, RANGE_SHINGLES = 64, 1 << 22  # cells are counted in ranges of about so many shingles
PIECE = 2_000_000
HASHED = 500_000  # bytes of text whose shingles are hashed at a time


def cell_of(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - CELL_BITS)).astype(np.uint32)


def _sets(docs: DataFrame, function, schema: str, only: "_Filter | None" = None) -> DataFrame:
    """Run ``function(ids, sets)`` on pieces of the documents; it yields record batches."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", PIECE):
            if only is not None:
                batch = batch.filter(only.hits(batch.column("doc_id")))
            # Shingles are hashed a part at a time, whose arrays are many times its text.
            parts = (part.column("text").to_pylist() for part in slices([batch], "text", HASHED))
            sets = [s for texts in parts for s in word_shingles(texts, WORDS)]
            yield from function(batch.column("doc_id"), sets)

    return docs.mapInArrow(run, schema)


def _described(ids: pa.Array, sets: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    sketches = []
    for s in sets:
        bits = np.zeros(SKETCH_BITS, bool)
        bits[(s & np.uint64(SKETCH_BITS - 1)).astype(np.int64)] = True
        sketches.append(np.packbits(bits).tobytes())
    yield pa.RecordBatch.from_arrays(
        [
            ids, pa.array([len(s) for s in sets], pa.int64()),
            pa.array([set_key(s) if len(s) else None for s in sets], pa.int64()), pa.array(sketches, pa.binary()),
        ],
        names=["doc_id", "n", "node", "sketch"],
    )


def _counted(ranges: int):
    """Cells of all shingles, by ranges of cells: byte planes of sorted differences."""
    share = (1 << CELL_BITS) // ranges

    def run(_: pa.Array, sets: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        cells = np.sort(cell_of(np.concatenate(sets)))
        at = (cells // share).astype(np.int64)
        kept, first = np.unique(at, return_index=True)
        planes = []
        for k, a, b in zip(kept.tolist(), first.tolist(), [*first[1:].tolist(), len(cells)]):
            steps = np.diff(cells[a:b], prepend=np.uint32(k * share)).astype("<u4")
            planes.append(np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 4).T).tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(kept), pa.array(planes, pa.binary())], names=["range", "cells"])

    return run


def _often(ranges: int, rare_below: int):
    """Cells of a range that at least ``rare_below`` documents have."""
    share = (1 << CELL_BITS) // ranges

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            for k, planes in zip(batch.column("range").to_pylist(), batch.column("cells").to_pylist()):
                steps = np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(4, -1).T).view("<u4").ravel()
                held.setdefault(k, []).append(np.uint32(k * share) + np.cumsum(steps, dtype=np.uint32))
        while held:
            cells, n = np.unique(np.concatenate(held.popitem()[1]), return_counts=True)
            many = n >= rare_below
            yield pa.RecordBatch.from_arrays([pa.array(cells[many].astype(np.int64)), pa.array(n[many])], names=["cell", "n"])

    return run


def _class_table(frequent: pa.Table, rare_below: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted frequent cells and the combination size of each."""
    cells = np.asarray(frequent.column("cell")).astype(np.uint32)
    counts = np.asarray(frequent.column("n"))
    order = np.argsort(cells)
    size = 2 + np.floor(np.log(counts[order] / rare_below) / np.log(STEP) + 1e-9)
    return cells[order], np.minimum(size, MOST_COMBINED).astype(np.int8)


def sizes_of(hashes: np.ndarray, table: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The combination size of each shingle: 1 for a rare one."""
    cells, size = table
    if not len(cells):
        return np.ones(len(hashes), np.int8)
    own = cell_of(hashes)
    at = np.minimum(np.searchsorted(cells, own), len(cells) - 1)
    return np.where(cells[at] == own, size[at], 1).astype(np.int8)


def bands(n: int) -> list[int]:
    """The size band of a set and the next one, which a similar set may be in."""
    own = n.bit_length() - 1
    return [SMALL_BAND] if own < SMALL_BAND else [own, own + 1]


def keys_of(hashes: np.ndarray, sizes: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """The index keys of a set of sorted distinct hashes."""
    n = len(hashes)
    spare = n - -(-percent * n // 100)  # how many shingles a similar set may lack
    order = np.lexsort((hashes, sizes))
    hashes, sizes = hashes[order], sizes[order]
    rare = hashes[sizes == 1]
    if len(rare) > spare:
        return rare[: spare + 1]
    out = [rare]
    for band in bands(n):
        single = band <= SMALL_BAND
        out += _frequent_keys(hashes[len(rare) :], sizes[len(rare) :], spare + 1 - len(rare), band, single)
    return np.unique(np.concatenate(out))


def _frequent_keys(hashes: np.ndarray, sizes: np.ndarray, wanted: int, band: int, single: bool) -> list[np.ndarray]:
    salt = np.uint64(band + 1)
    if single:
        return [mix(hashes[:wanted] ^ salt)]
    cells = (mix(hashes + salt) % np.uint64(max(1, (1 << band) // CELL_LOAD))).tolist()
    held: dict[tuple[int, int], list[int]] = {}
    covered = 0
    for h, k, cell in zip(hashes.tolist(), sizes.tolist(), cells):
        if covered >= wanted:
            break
        own = held.setdefault((k, cell), [])
        own.append(h)
        covered += len(own) >= k
    out = []
    if covered < wanted:
        # Too few cells hold enough of them: every shingle is a key, in either set of a pair.
        out.append(mix(hashes ^ salt))
    for (k, _), own in held.items():
        if len(own) >= k:
            groups = np.array(list(combinations(own, k)), np.uint64)
            key = np.full(len(groups), salt)
            for i in range(k):
                key = mix(key ^ groups[:, i]) + np.uint64(k)
            out.append(key)
    return out


def _paired(nodes: DataFrame, pairs: DataFrame, columns: list[str]) -> DataFrame:
    """Pairs ``(a, b)`` with both nodes' ``columns``, as ``a_c`` and ``b_c``."""
    for side in ("a", "b"):
        own = nodes.select(F.col("node").alias(side), *[F.col(c).alias(f"{side}_{c}") for c in columns])
        pairs = pairs.join(own, side)
    return pairs


def most_common(sketch: np.ndarray, size: int, sketches: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Upper bounds of the overlap of one set with others, from sketches of 64-bit words.

    Common shingles have common bits, and a set loses ``size`` less its bits to collisions.
    """
    common = np.bitwise_count(sketch & sketches).sum(1, dtype=np.int64)
    lost = sizes - np.bitwise_count(sketches).sum(1, dtype=np.int64)
    own = size - int(np.bitwise_count(sketch).sum())
    return np.minimum(np.minimum(size, sizes), common + np.minimum(own, lost))


def _words(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint64).reshape(-1, SKETCH_BITS // 64)


def _possible(percent: int):
    """Drop pairs whose sizes or sketches rule out the similarity."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = []
            sizes = [np.asarray(batch.column(c)).astype(np.int64) for c in ("a_n", "b_n")]
            x, y = (_words(batch.column(c)) for c in ("a_sketch", "b_sketch"))
            for i in range(batch.num_rows):
                overlap = most_common(x[i], sizes[0][i], y[i : i + 1], sizes[1][i : i + 1])[0]
                ok.append((100 + percent) * overlap >= percent * (sizes[0][i] + sizes[1][i]))
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return run


def _crossing(percent: int):
    """Members of a bucket, or of two blocks of one, to those of other components they may match.

    Rows come sorted by their group; a group has a few thousand members at most.
    """

    def compare(nodes, parts, sizes, sketches) -> tuple[list, list]:
        names, count = np.unique(parts, return_counts=True)
        rest = np.flatnonzero(parts != names[count.argmax()])
        out: tuple[list, list] = ([], [])
        for i in rest.tolist():
            other = parts != parts[i]
            other[rest[rest <= i]] = False  # a pair of two such members is tried once
            fit = 100 * np.minimum(sizes[i], sizes) >= percent * np.maximum(sizes[i], sizes)
            at = np.flatnonzero(other & fit)
            overlap = most_common(sketches[i], int(sizes[i]), sketches[at], sizes[at])
            at = at[(100 + percent) * overlap >= percent * (sizes[i] + sizes[at])]
            if len(at):
                out[0].append(int(nodes[i]))
                out[1].append(nodes[at].tolist())
        return out

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, group = [], None
        for batch in batches:
            keys = np.asarray(batch.column("group"))
            cuts = np.flatnonzero(np.diff(keys)) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(keys)]):
                if a == b:
                    continue
                if keys[a] != group and held:
                    yield decide(held)
                    held = []
                group = keys[a]
                held.append(batch.slice(a, b - a))
        if held:
            yield decide(held)

    def decide(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(parts).combine_chunks()
        plain = [np.asarray(rows.column(c)).astype(np.int64) for c in ("node", "component", "n")]
        found = compare(*plain, _words(rows.column("sketch")))
        return pa.RecordBatch.from_arrays([pa.array(found[0], pa.int64()), pa.array(found[1], pa.list_(pa.int64()))], names=["a", "others"])

    return run


def _linked(percent: int):
    """Keep pairs whose exact sets reach the similarity."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = []
            for x, y in zip(batch.column("a_set").to_pylist(), batch.column("b_set").to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                common = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(100 * common >= percent * (len(x) + len(y) - common))
            yield batch.select(["a", "b"]).filter(pa.array(ok))

    return run


class _Filter:
    """A fixed number of bits that says which ids may be wanted; never misses one."""

    BITS = 1 << 24

    def __init__(self, ids: DataFrame):
        def mark(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            bits = np.zeros(self.BITS // 8, np.uint8)
            for batch in batches:
                at = self.places(np.asarray(batch.column(0)))
                np.bitwise_or.at(bits, at >> 3, (1 << (at & 7)).astype(np.uint8))
            yield pa.RecordBatch.from_arrays([pa.array([bits.tobytes()], pa.binary())], names=["bits"])

        parts = ids.repartition(8).mapInArrow(mark, "bits binary").toLocalIterator()
        total = np.zeros(self.BITS // 8, np.uint8)
        for row in parts:
            total |= np.frombuffer(row["bits"], np.uint8)
        self.shared = ids.sparkSession.sparkContext.broadcast(total)  # 2 MB at any size

    @classmethod
    def places(cls, ids: np.ndarray) -> np.ndarray:
        return (mix(ids.astype(np.int64).view(np.uint64)) % np.uint64(cls.BITS)).astype(np.int64)

    def hits(self, ids: pa.Array) -> pa.Array:
        at = self.places(np.asarray(ids.fill_null(0)))
        return pa.array((self.shared.value[at >> 3] >> (at & 7)) & 1 == 1)


def _sets_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``(node, set)`` of the wanted nodes, read once more from the texts of one document each."""
    maybe = _Filter(wanted.select(F.coalesce("least", F.lit(0))))

    def run(ids: pa.Array, sets: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_arrays(
            [
                ids, pa.array([set_key(s) if len(s) else None for s in sets], pa.int64()),
                pa.array([s.tobytes() for s in sets], pa.binary()),
            ],
            names=["doc_id", "node", "set"],
        )

    found = _sets(docs, run, "doc_id long, node long, set binary", maybe).select("node", "set", "doc_id")
    asked = wanted.select(F.col("node").alias("_node"), "least")
    return (
        found.join(asked, (F.col("node") == F.col("_node")) & F.col("doc_id").eqNullSafe(F.col("least")))
        .select("node", "set").dropDuplicates(["node"])
    )


def _verified(docs: DataFrame, nodes: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """The pairs of ``(a, b)`` whose sets are similar."""
    possible = keep(
        _paired(nodes, pairs, ["n", "sketch"])
        .filter((100 * F.col("a_n") >= percent * F.col("b_n")) & (100 * F.col("b_n") >= percent * F.col("a_n")))
        .mapInArrow(_possible(percent), "a long, b long"),
        "possible-pairs",
    )
    ends = possible.select(F.col("a").alias("node")).unionByName(possible.select(F.col("b").alias("node"))).distinct()
    wanted = keep(nodes.join(ends, "node").select("node", "least"), "wanted-sets")
    sets = keep(_sets_of(docs, wanted), "sets")
    return keep(_paired(sets, possible, ["set"]).mapInArrow(_linked(percent), "a long, b long"), "links")


def _links(docs: DataFrame, nodes: DataFrame, shared: DataFrame, percent: int) -> DataFrame:
    """Links ``(a, b)`` that connect what all similar pairs of the buckets connect.

    In a round the member of a bucket that shares most keys is compared with the members of
    other components, and then leaves the bucket: its pairs are decided or inside a component.
    Buckets of one component are closed. When a round links fewer than one in a hundred of its
    pairs, all pairs that are left are filtered by their sketches, a bucket or two blocks of one
    at a time.
    """
    weight = shared.groupBy("node").agg(F.count(F.lit(1)).alias("weight"))
    open_ = keep(shared.join(weight, "node").withColumn("component", F.col("node")), "open-buckets")
    links = tried = None
    while True:
        hubs = open_.groupBy("sig").agg(
            F.max_by(F.struct("node", "component"), F.struct("weight", "node")).alias("hub")
        )
        met = open_.join(hubs, "sig").filter(F.col("component") != F.col("hub.component"))
        pairs = _ordered(met, F.col("hub.node"), F.col("node"))
        found, tried, compared = _tried(docs, nodes, pairs, tried, percent)
        links = found if links is None else keep(links.unionByName(found), "links")
        ended = found.count() * 100 < compared
        groups = keep(components(links), "components")
        left = keep(
            open_.join(hubs, "sig").filter(F.col("node") != F.col("hub.node"))
            .select("sig", "node", "weight").join(groups, "node", "left")
            .withColumn("component", F.coalesce("component", "node")),
            "open-buckets",
        )
        spans = left.groupBy("sig").agg(
            F.min("component").alias("_low"), F.max("component").alias("_high"), F.count(F.lit(1)).alias("members")
        ).filter("_low != _high").select("sig", "members")
        open_ = keep(left.join(spans, "sig"), "open-buckets")
        if ended or open_.isEmpty():
            break
        open_ = open_.drop("members")
    return keep(links.unionByName(_tried(docs, nodes, _crossed(open_, nodes, percent), tried, percent)[0]), "links")


def _crossed(open_: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Pairs of different components in a bucket that sizes and sketches do not rule out."""
    blocks = F.ceil(F.col("members") / F.lit(BLOCK)).cast("long")
    # Each member meets every block of its bucket: one, unless the bucket is a very large one.
    blocked = (
        open_.withColumn("_own", F.pmod(F.xxhash64("node"), blocks))
        .withColumn("_other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
        .withColumn("group", F.xxhash64("sig", F.least("_own", "_other"), F.greatest("_own", "_other")))
        .select("group", "node", "component")
    )
    met = (
        blocked.join(nodes.select("node", "n", "sketch"), "node").select("group", "node", "component", "n", "sketch")
        .repartition("group").sortWithinPartitions("group", "component", "node")
        .mapInArrow(_crossing(percent), "a long, others array<long>")
    )
    # A pair may meet in many buckets; it is listed once.
    once = met.groupBy("a").agg(F.array_distinct(F.flatten(F.collect_list("others"))).alias("others"))
    return _ordered(once.select("a", F.explode("others").alias("b")), F.col("a"), F.col("b"))


def _ordered(met: DataFrame, one: Column, other: Column) -> DataFrame:
    return met.select(F.least(one, other).alias("a"), F.greatest(one, other).alias("b")).distinct()


def _tried(docs, nodes, pairs, tried, percent) -> tuple[DataFrame, DataFrame, int]:
    """The links among ``pairs`` that were not compared before, all compared pairs, new ones."""
    fresh = keep(pairs if tried is None else pairs.join(tried, ["a", "b"], "left_anti"), "pairs")
    compared = fresh if tried is None else keep(tried.unionByName(fresh), "tried")
    return _verified(docs, nodes, fresh, percent), compared, fresh.count()


def near_duplicates(
    docs: DataFrame, percent: int = PERCENT, rare_below: int = RARE_BELOW, most_frequent: int = MOST_FREQUENT,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every document."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = keep(_sets(docs, _described, "doc_id long, n long, node long, sketch binary"), "shingle-sets")
    nodes = keep(
        rows.filter("node IS NOT NULL").groupBy("node")
        .agg(F.min("doc_id").alias("least"), F.first("n").alias("n"), F.first("sketch").alias("sketch")),
        "nodes",
    )
    total = rows.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    rare_below = max(rare_below, -(-total // most_frequent))
    ranges = max(COUNT_RANGES, 1 << (total // RANGE_SHINGLES).bit_length())
    frequent = (
        _sets(docs, _counted(ranges), "range long, cells binary").repartition("range")
        .mapInArrow(_often(ranges, rare_below), "cell long, n long")
    )
    # At most ``most_frequent`` cells, since their counts add up to no more than the total.
    table = docs.sparkSession.sparkContext.broadcast(_class_table(frequent.toArrow(), rare_below))

    def index(ids: pa.Array, sets: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        keys, owners, seen = [np.empty(0, np.uint64)], [np.empty(0, np.int64)], set()
        for s in sets:
            node = set_key(s) if len(s) else None
            if node is not None and node not in seen:  # copies in one piece send their keys once
                seen.add(node)
                own = keys_of(s, sizes_of(s, table.value), percent)
                keys.append(own)
                owners.append(np.full(len(own), node))
        yield pa.RecordBatch.from_arrays(
            [pa.array(as_long(np.concatenate(keys))), pa.array(np.concatenate(owners))], names=["sig", "node"]
        )

    bucket = Window.partitionBy("sig")
    shared = keep(
        _sets(docs, index, "sig long, node long").repartition("sig")
        .withColumns({"_low": F.min("node").over(bucket), "_top": F.max("node").over(bucket)})
        .filter("_low != _top").select("sig", "node").distinct(),
        "buckets",
    )
    links = _links(docs, nodes, shared, percent)
    final = keep(components(links), "components")
    named = nodes.join(final, "node", "left").withColumn("component", F.coalesce("component", "node"))
    smallest = named.groupBy("component").agg(F.min("least").alias("_id"))
    names = named.join(smallest, "component").select("node", "_id")
    # Rows without a set stay out of the join, where they would all meet under one key.
    alone = rows.filter("node IS NULL").withColumn("_id", F.col("doc_id"))
    return rows.filter("node IS NOT NULL").join(names, "node").unionByName(alone).select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("_id", "doc_id")).alias("component_id"),
    )
