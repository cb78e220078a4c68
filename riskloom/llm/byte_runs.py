"""Remove repeated byte strings, found by suffix arrays over shards of the corpus.

A window of ``length`` bytes is dealt by its anchor, the ``gram`` bytes in it that hash lowest
(the leftmost of them): equal windows have equal anchors, so a shard that holds all windows of
an anchor decides them alone. Consecutive windows with one anchor travel as one piece.

1. Anchors are counted. Those that too many different pieces share are barred, and windows
   choose among the others; windows left without a choice, and anchors that are crowded even
   then, are dealt window by window. So no shard depends on one frequent passage.
2. Pieces that occur unchanged more than once are repeated as a whole. Where pieces with one
   anchor differ, one copy of each goes to a shard. There, pieces that agree with no other one in
   nearly a window around the anchor share no window and are set aside; of the others a suffix
   array is built by induced sorting, and the permuted common prefixes mark the windows
   that occur twice.
3. Marked windows become byte ranges per document, and their union is removed.

Texts are read in segments, so a task holds a few megabytes of a long text. Pieces are named by
128 bits of hash. A fixed-size bit filter spares pieces that no other one resembles; what passes
it is joined exactly.

Defined cases: a null text is empty; texts shorter than ``length`` lose nothing; rows that agree
in id and text repeat each other; null ids are carried along; no rows give no rows; further
columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from riskloom.llm.common import keep, slices
from riskloom.llm.shingles import _power_table, _TABLE, mix, span_hashes
from riskloom.llm.suffix_array import repeated_windows

LENGTH, GRAM = 400, 24
CROWD = 64  # different pieces per anchor that a shard takes as they are
MOST_BARRED = 1 << 22
SEGMENT = 1 << 19
SHARD_BYTES = 1 << 19
STEPS = 24  # how finely the places of an anchor in a window are told apart
FILTER_BITS = 1 << 25
_HIGH = np.uint64(0xFFFFFFFF00000000)
_LOW = np.uint64(0xFFFFFFFF)
_SALT = np.uint64(0x5851F42D4C957F2D)


class Known:
    """Membership in a sorted array of hashes; most others fail a look at a few bits."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = np.sort(hashes.astype(np.uint64))
        self.bits = np.zeros(1 << 20, bool)
        self.bits[(self.hashes >> np.uint64(44)).view(np.int64)] = True

    def has(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.hashes):
            return np.zeros(len(hashes), bool)
        out = self.bits.take((hashes >> np.uint64(44)).view(np.int64))
        some = np.flatnonzero(out)
        at = np.minimum(np.searchsorted(self.hashes, hashes[some]), len(self.hashes) - 1)
        out[some] = self.hashes[at] == hashes[some]
        return out


def _least(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours."""
    step, m = 1, x
    while step * 2 <= width:
        m = np.minimum(m[:-step], m[step:])
        step *= 2
    return np.minimum(m[: len(x) - width + 1], m[width - step : width - step + len(x) - width + 1])


def pieces(data: np.ndarray, room: np.ndarray, length: int, gram: int, barred: Known, single: Known):
    """Pieces of ``data``: first window, number of windows, anchor and name of each.

    ``room`` says for each window start whether the window lies inside its document.
    """
    n = len(data)
    if n < length or not room.any():
        none = np.empty(0, np.int64)
        return none, none, none.view(np.uint64), none.view(np.uint64)
    up, down = _power_table(n + 1)
    with np.errstate(over="ignore"):
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_TABLE[data] * up[:n])))
        grams = mix((sums[gram:] - sums[:-gram]) * down[: n - gram + 1])
        ranked = grams & _HIGH
        ranked |= np.arange(len(grams), dtype=np.uint64)
        if len(barred.hashes):
            ranked[barred.has(grams)] |= _HIGH
        least = _least(ranked, length - gram + 1)  # differs wherever the place of the anchor does
        fresh = np.ones(len(least), bool)
        np.not_equal(least[1:], least[:-1], out=fresh[1:])
        fresh[1:] |= room[1:] != room[:-1]
        # Windows from one fresh place to the next have one anchor, and all or none have room.
        changes = np.flatnonzero(fresh)
        until = np.append(changes[1:], len(least))
        fits = room[changes]
        first, until = changes[fits], until[fits]
        anchor = grams[(least[first] & _LOW).view(np.int64)]
        alone = (least[first] >= _HIGH) | single.has(anchor)
        count = until - first
        if alone.any():  # these go window by window
            times = np.where(alone, count, 1)
            nth = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            first, count = np.repeat(first, times) + nth, np.repeat(np.where(alone, 1, count), times)
            anchor, alone = np.repeat(anchor, times), np.repeat(alone, times)
        past = first + count - 1 + length
        whole = (sums[past] - sums[first]) * down[first]
        name = mix(whole ^ _SALT)
        key = np.where(alone, mix(whole + _SALT), anchor)
    return first, count, key, name


def _segments(batches: Iterable[pa.RecordBatch], length: int) -> Iterator[tuple]:
    """Joined texts of some documents, or a segment of one: data, room, owners, shifts, batch."""
    for batch in slices(batches, "text", SEGMENT):
        raw = batch.column("text").cast(pa.binary()).fill_null(b"").to_pylist()
        sizes = np.array([len(r) for r in raw], np.int64)
        if len(raw) == 1 and sizes[0] > 2 * SEGMENT:
            whole = np.frombuffer(raw[0], np.uint8)
            for at in range(0, len(whole) - length + 1, SEGMENT):
                data = whole[at : at + SEGMENT + length - 1]
                yield batch, data, np.ones(len(data) - length + 1, bool), np.array([-at]), at
            continue
        data = np.frombuffer(b"".join(raw), np.uint8)
        ends = np.cumsum(sizes)
        starts = np.arange(max(0, len(data) - length + 1))
        room = starts + length <= np.repeat(ends, sizes)[: len(starts)]
        yield batch, data, room, ends - sizes, 0


def _place(ids: np.ndarray, hashes: np.ndarray, start: np.ndarray) -> np.ndarray:
    """A name for an occurrence of a piece."""
    with np.errstate(over="ignore"):
        return mix(mix(ids.view(np.uint64) ^ _SALT) + hashes.view(np.uint64) + mix(start.astype(np.uint64)))


def _occurrences(docs: DataFrame, length: int, gram: int, barred: Known, single: Known, extra=None) -> DataFrame:
    """A row per piece: ``key, name, place``; with ``extra`` also where it lies, and some bytes.

    ``extra`` holds two bit filters: over keys that are needed, and over places whose bytes are.
    """
    shared = docs.sparkSession.sparkContext.broadcast((barred, single))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, room, begins, _ in _segments(batches, length):
            first, count, key, name = pieces(data, room, length, gram, *shared.value)
            owner = np.searchsorted(begins, first, "right") - 1 if len(begins) > 1 else np.zeros(len(first), np.int64)
            if len(begins) > 1:  # empty documents share their start with the next one
                start = first - begins[owner]
            else:
                start = first - begins[0]
            ids, hashes = batch.column("doc_id"), np.asarray(batch.column("hash"))
            plain = np.asarray(ids.fill_null(0)).astype(np.int64)
            place = _place(plain[owner], hashes[owner], start)
            if extra is None:
                columns = [key.view(np.int64), name.view(np.int64), place.view(np.int64)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["key", "name", "place"])
                continue
            want = np.flatnonzero(extra[0].has(key))
            bytes_of = extra[1].has(place[want])
            first, count, owner, start = first[want], count[want], owner[want], start[want]
            text = [
                data[a : a + c - 1 + length].tobytes() if b else None
                for a, c, b in zip(first.tolist(), count.tolist(), bytes_of.tolist())
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(key[want].view(np.int64)), pa.array(name[want].view(np.int64)),
                    pa.array(place[want].view(np.int64)), ids.take(pa.array(owner)), pa.array(hashes[owner]),
                    pa.array(start), pa.array(count), pa.array(text, pa.binary()),
                ],
                names=["key", "name", "place", "doc_id", "hash", "start", "count", "bytes"],
            )

    schema = "key long, name long, place long"
    if extra is not None:
        schema += ", doc_id long, hash long, start long, count long, bytes binary"
    return docs.mapInArrow(run, schema)


class Bits:
    """A bit filter of fixed size over 64-bit names; it never misses one."""

    def __init__(self, names: DataFrame, bits: int = FILTER_BITS):
        def mark(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = np.zeros(bits, bool)
            for batch in batches:
                held[(mix(np.asarray(batch.column(0)).view(np.uint64)) % np.uint64(bits)).astype(np.int64)] = True
            yield pa.RecordBatch.from_arrays([pa.array([np.packbits(held).tobytes()], pa.binary())], names=["bits"])

        total = np.zeros(bits // 8, np.uint8)
        for row in names.repartition(4).mapInArrow(mark, "bits binary").toLocalIterator():
            total |= np.frombuffer(row["bits"], np.uint8)
        self.bits = bits
        self.shared = names.sparkSession.sparkContext.broadcast(total)

    def has(self, names: np.ndarray) -> np.ndarray:
        at = (mix(names.view(np.uint64)) % np.uint64(self.bits)).astype(np.int64)
        return (self.shared.value[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1


def alike(keys: np.ndarray, texts: list[bytes], length: int, gram: int) -> np.ndarray:
    """Which pieces may share a window with another piece of their key; it never misses one.

    Equal windows have their anchor at the same place, with some ``d`` bytes left of it and the
    rest right of it. So for the step ``low <= d <= high``, two pieces that share a window agree in
    ``low`` bytes on the left and in all but ``high`` on the right. A piece may hold its anchor
    again, as text that repeats a few bytes does; then the first place counts, if every window of
    the piece has it and so has it leftmost. Where it does not, its key is kept whole.
    """
    rest = length - gram
    steps = [(rest * i // STEPS, rest * (i + 1) // STEPS) for i in range(STEPS)]
    data = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(sizes)
    begins = ends - sizes
    up, down = _power_table(len(data) + 1)
    with np.errstate(over="ignore"):
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_TABLE[data] * up[: len(data)])))
        grams = mix((sums[gram:] - sums[:-gram]) * down[: len(data) - gram + 1])
        spots = np.flatnonzero(grams == np.repeat(keys, sizes)[: len(grams)])
        owner = np.searchsorted(ends, spots, "right")
        inside = spots + gram <= ends[owner]
        spots, owner = spots[inside], owner[inside]
        times = np.bincount(owner, minlength=len(keys))
        leading = np.ones(len(owner), bool)
        leading[1:] = owner[1:] != owner[:-1]
        spots, owner = spots[leading], owner[leading]
        at = spots - begins[owner]
        sure = (times[owner] == 1) | (at >= sizes[owner] - length) & (at <= rest)
        spots, owner = spots[sure], owner[sure]
        out = np.isin(keys, np.delete(keys, owner))
        for low, high in steps:
            a, b = spots - low, spots + gram + rest - high
            whole = (a >= begins[owner]) & (b <= ends[owner])
            a, b, own = a[whole], b[whole], owner[whole]
            around = mix(keys[own] + (sums[b] - sums[a]) * down[a])
            order = np.argsort(around)
            same = np.flatnonzero(around[order[1:]] == around[order[:-1]])
            out[own[order[same]]] = out[own[order[same + 1]]] = True
    return out


def _marked(length: int, gram: int):
    """Sorted pieces of one key after another to the windows in them that occur twice."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, int, bytes]] = []
        left: list[tuple[int, int, bytes]] = []
        size = 0
        for batch in batches:
            for row in zip(*[batch.column(c).to_pylist() for c in ("key", "name", "bytes")]):
                if size >= SHARD_BYTES and row[0] != held[-1][0]:
                    left += possible(held)
                    held, size = [], 0
                    if sum(len(r[2]) for r in left) >= SHARD_BYTES:
                        yield decide(left)
                        left = []
                held.append(row)
                size += len(row[2])
        left += possible(held)
        if left:
            yield decide(left)

    def possible(rows: list[tuple[int, int, bytes]]) -> list[tuple[int, int, bytes]]:
        if not rows:
            return []
        keys = np.array([r[0] for r in rows], np.int64).view(np.uint64)
        return [rows[i] for i in np.flatnonzero(alike(keys, [r[2] for r in rows], length, gram)).tolist()]

    def decide(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
        marks = repeated_windows([r[2] for r in rows], length)
        return pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
             pa.array([_runs(m) for m in marks], pa.list_(pa.int64()))],
            names=["key", "name", "runs"],
        )

    return run


def _runs(starts: np.ndarray) -> list[int]:
    """First and last of each run of consecutive numbers, in a row."""
    if not len(starts):
        return []
    cut = np.flatnonzero(np.diff(starts) > 1)
    return np.column_stack((starts[np.append(0, cut + 1)], starts[np.append(cut, len(starts) - 1)])).ravel().tolist()


def _removed(length: int):
    """Texts and the marked windows of each to its spans, its kept bytes and their digest."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            columns: list[list] = [[], [], [], [], []]
            texts = batch.column("text").cast(pa.binary()).fill_null(b"").to_pylist()
            marks = list(zip(*(x.to_numpy().tolist() for x in batch.column("marks").flatten().flatten())))
            ends = np.cumsum(batch.column("marks").value_lengths().fill_null(0).to_numpy()).tolist()
            for raw, begin, end in zip(texts, [0, *ends], ends):
                spans = union_of(marks[begin:end], length)
                kept, at = [], 0
                for a, b in spans:
                    kept.append(raw[at:a])
                    at = b
                kept = b"".join([*kept, raw[at:]])
                for column, value in zip(
                    columns, (len(raw), len(raw) - len(kept), spans, kept, hashlib.sha256(kept).hexdigest())
                ):
                    column.append(value)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()),
                    pa.array(columns[2], pa.list_(pa.list_(pa.int64()))), pa.array(columns[3], pa.binary()),
                    pa.array(columns[4], pa.string()),
                ],
                names=["doc_id", "n_bytes", "n_removed", "spans", "kept", "kept_sha256"],
            )

    return run


def union_of(marks: list[tuple[int, int]], length: int) -> list[tuple[int, int]]:
    """Maximal byte ranges covered by windows that start from ``first`` to ``last``."""
    out: list[list[int]] = []
    for first, last in sorted(marks):
        if out and first <= out[-1][1]:
            out[-1][1] = max(out[-1][1], last + length)
        else:
            out.append([first, last + length])
    return [tuple(x) for x in out]


def _crowded(rows: DataFrame, crowd: int) -> np.ndarray:
    """Anchors with at least ``crowd`` different pieces."""
    found = (
        rows.groupBy("key", "name").agg(F.lit(1).alias("_one"))
        .groupBy("key").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= crowd).select("key").toArrow()
    )
    return np.asarray(found.column("key")).astype(np.int64).view(np.uint64)


def remove_repeats(
    docs: DataFrame, length: int = LENGTH, gram: int = GRAM, crowd: int = CROWD, id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, n_bytes, n_removed, spans, kept, kept_sha256`` of every document."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    docs = docs.withColumn("hash", F.xxhash64(F.coalesce("text", F.lit(""))))
    none = Known(np.empty(0, np.uint64))
    gram = min(gram, length)
    # At most ``MOST_BARRED`` anchors can be that crowded: a piece has about as many windows as
    # half a window has bytes, and every crowded anchor takes ``crowd`` pieces.
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    crowd = max(crowd, -(-2 * size // (length - gram + 2)) // MOST_BARRED)
    barred = Known(_crowded(_occurrences(docs, length, gram, none, none), crowd))
    single = none
    if len(barred.hashes):
        single = Known(_crowded(_occurrences(docs, length, gram, barred, none), crowd))
    names = keep(
        _occurrences(docs, length, gram, barred, single).groupBy("key", "name")
        .agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("place")),
        "piece-names",
    )
    kinds = names.groupBy("key").agg(F.count(F.lit(1)).alias("_kinds"), F.sum("n").alias("_all")).filter("_all > 1").drop("_all")
    wanted = keep(names.join(kinds, "key"), "wanted-pieces")
    several = wanted.filter("_kinds > 1")
    found = keep(
        _occurrences(
            docs, length, gram, barred, single,
            (Bits(wanted.select("key").distinct()), Bits(several.select("place"))),
        ),
        "pieces",
    )
    shards = (
        found.filter("bytes IS NOT NULL").join(several.select("key", "name", "place"), ["key", "name", "place"])
        .dropDuplicates(["key", "name"]).select("key", "name", "bytes")
        .repartition("key").sortWithinPartitions("key", "name")
    )
    marks = keep(shards.mapInArrow(_marked(length, gram), "key long, name long, runs array<long>"), "marks")
    # A piece that occurs twice is repeated from its first to its last window.
    decided = keep(
        wanted.select("key", "name", "n").join(marks, ["key", "name"], "left")
        .withColumn("runs", F.when(F.col("n") > 1, F.array(F.lit(0).cast("long"), F.lit(-1).cast("long"))).otherwise(F.col("runs")))
        .filter(F.size("runs") > 0).select("key", "name", "runs"),
        "decided",
    )
    windows = (
        found.drop("bytes", "place").join(decided, ["key", "name"])
        .withColumn("_i", F.explode(F.sequence(F.lit(0), F.size("runs") - 1, F.lit(2))))
        .withColumn("_last", F.get("runs", F.col("_i") + 1))
        .select(
            "doc_id", "hash", (F.col("start") + F.get("runs", F.col("_i"))).alias("first"),
            (F.col("start") + F.when(F.col("_last") < 0, F.col("count") - 1).otherwise(F.col("_last"))).alias("last"),
        )
    )
    per_doc = windows.groupBy(F.col("doc_id").alias("_id"), F.col("hash").alias("_hash")).agg(
        F.collect_list(F.struct("first", "last")).alias("marks")
    )
    joined = docs.join(
        per_doc, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("hash") == F.col("_hash")), "left"
    ).select("doc_id", "text", "marks")
    return joined.mapInArrow(
        _removed(length),
        "doc_id long, n_bytes long, n_removed long, spans array<array<long>>, kept binary, kept_sha256 string",
    )
