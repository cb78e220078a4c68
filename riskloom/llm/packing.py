"""Pack documents into token sequences of bounded length, in order, by dynamic programming.

Every scan partition is packed as it stands, without a shuffle: its documents form one stream
of ids, in which a cut may follow a document (free), a sentence (``sentence_penalty``) or, only
inside long stretches without either, any ``free_step``-th id (``free_penalty``). With

    f(j) = min over i, b_j - b_i <= L, of  f(i) + (L - (b_j - b_i)) + penalty_j

the cuts minimise padding plus penalties; the part that depends on ``i`` alone is
``f(i) + b_i``, so a monotone queue yields each minimum in constant amortised time. The stream
is cut into blocks of about ``block`` ids; what lies past the best cut near the end of a block
opens the next one. The last sequence of a partition is split at powers of two, which need no
padding.

Memory is bounded by a block and one document. A task that runs again reads the same split and
gives the same rows. Defined cases: a null or empty text is a document of the end id alone;
null and repeated ids are carried along; no rows give no pieces; further columns are not read.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from riskloom.llm.common import row_batch, slices
from riskloom.llm.tokens import encoder, sentence_ends

_PIECES = pa.schema(
    [
        ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
        ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()),
        ("ids", pa.binary()),
    ]
)
SLICE = 1_500_000  # bytes of text that are cut into words at a time
PIECES = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


def best_cuts(at: np.ndarray, penalty: np.ndarray, length: int, last: bool) -> list[int]:
    """Positions of the chosen cuts, in order.

    ``at`` are the allowed positions, ascending and never more than ``length`` apart. With
    ``last`` the final position is always cut; else the best position within the last
    ``length`` ids ends the block.
    """
    spots, costs = [0, *at.tolist()], [0, *penalty.tolist()]
    total, back, key = [0] * len(spots), [0] * len(spots), [0] * len(spots)
    queue = deque([0])
    for j in range(1, len(spots)):
        here = spots[j]
        while here - spots[queue[0]] > length:
            queue.popleft()
        i = queue[0]
        back[j] = i
        total[j] = key[i] + length - here + costs[j]
        key[j] = k = total[j] + here
        while queue and key[queue[-1]] >= k:
            queue.pop()
        queue.append(j)
    end = len(spots) - 1
    if not last:
        near = [j for j in range(1, len(spots)) if spots[j] > spots[-1] - length]
        end = min(near, key=lambda j: (total[j], -j))
    elif end:
        # The rest of a partition pays no padding, only the cuts between powers of two.
        open_ = [i for i in range(end) if spots[end] - spots[i] <= length]
        back[end] = min(open_, key=lambda i: (total[i], -i))
    cuts = []
    while end:
        cuts.append(spots[end])
        end = back[end]
    return cuts[::-1]


def allowed_cuts(
    ids: np.ndarray, doc_ends: np.ndarray, ends: np.ndarray, costs: tuple[int, int], step: int
) -> tuple[np.ndarray, np.ndarray]:
    """Positions after documents, sentences and, in long stretches, every ``step`` ids."""
    closes = np.flatnonzero(ends[np.minimum(ids, len(ends) - 1)]) + 1
    spots = np.union1d(closes, doc_ends)
    gaps = np.diff(spots, prepend=0)
    wide = np.flatnonzero(gaps > step)
    if len(wide):
        more = [np.arange(spots[k] - gaps[k] + step, spots[k], step) for k in wide]
        spots = np.union1d(spots, np.concatenate(more))
    penalty = np.full(len(spots), costs[1])
    penalty[np.isin(spots, closes, assume_unique=True)] = costs[0]
    penalty[np.isin(spots, doc_ends, assume_unique=True)] = 0
    return spots, penalty


class _Stream:
    """Documents of one partition that are not packed yet."""

    def __init__(self, part: int, length: int, costs: tuple[int, int], step: int, ends: np.ndarray):
        self.part, self.length, self.costs, self.step, self.ends = part, length, costs, step, ends
        self.docs: list[tuple] = []  # id, ids left, ids before them, all ids
        self.held, self.sequences = 0, 0

    def add(self, doc_id, ids: np.ndarray) -> None:
        self.docs.append((doc_id, ids, 0, len(ids)))
        self.held += len(ids)

    def pack(self, last: bool) -> pa.RecordBatch | None:
        if not self.docs:
            return None
        ids = np.concatenate([d[1] for d in self.docs])
        stops = np.cumsum([len(d[1]) for d in self.docs])
        cuts = best_cuts(*allowed_cuts(ids, stops, self.ends, self.costs, self.step), self.length, last)
        if last:
            begin = cuts[-2] if len(cuts) > 1 else 0
            rest, tail = cuts.pop() - begin, begin
            for bit in reversed(range(rest.bit_length())):
                if rest >> bit & 1:
                    tail += 1 << bit
                    cuts.append(tail)
        done = cuts[-1]
        marks = np.union1d(stops[stops < done], cuts)
        begins = np.concatenate(([0], marks[:-1]))
        doc = np.searchsorted(stops, begins, "right")
        window = np.searchsorted(cuts, begins, "right")
        window_starts = np.concatenate(([0], cuts))[window]
        doc_starts = np.concatenate(([0], stops))[doc]
        before = np.array([d[2] for d in self.docs])[doc]
        out = row_batch(
            _PIECES,
            [self.docs[k][0] for k in doc.tolist()],
            before + begins - doc_starts,
            marks - begins,
            [self.docs[k][3] for k in doc.tolist()],
            (self.part << 32) + self.sequences + window,
            begins - window_starts,
            [ids[a:b].tobytes() for a, b in zip(begins.tolist(), marks.tolist())],
        )
        self.sequences += len(cuts)
        first = int(np.searchsorted(stops, done, "right"))
        left = self.docs[first:]
        if left:
            used = done - (int(stops[first - 1]) if first else 0)
            key, own, ahead, whole = left[0]
            left[0] = (key, own[used:], ahead + used, whole)
        self.docs, self.held = left, len(ids) - done
        return out


def pack(
    docs: DataFrame, tokenizer: str, length: int = 4096, end_id: int = 2, sentence_penalty: int = 4,
    free_penalty: int = 32, free_step: int = 128, block: int = 1 << 18, id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per piece: where it lies in its document and in its sequence, and its ids.

    ``ids`` are little-endian unsigned 32-bit integers. Sequences are numbered within each
    partition, whose number stands in the upper 32 bits.
    """
    step = min(free_step, length)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, ends = encoder(tokenizer), sentence_ends(tokenizer)
        end = np.array([end_id], "<u4").tobytes()
        stream = _Stream(
            TaskContext.get().partitionId(), length, (sentence_penalty, free_penalty), step, ends
        )
        for batch in slices(batches, "text", SLICE):
            keys = batch.column("doc_id").to_pylist()
            for key, ids in zip(keys, encode.encode(batch.column("text").to_pylist())):
                stream.add(key, np.frombuffer(ids + end, "<u4"))
                if stream.held >= block + length:
                    yield stream.pack(False)
        rest = stream.pack(True)
        if rest is not None:
            yield rest

    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")
    ).mapInArrow(run, PIECES)
