"""Language proportions of each document by expectation maximisation over n-gram likelihoods.

Learning counts the three-byte grams of all labelled texts per language, summed on the
executors; grams are hashed to ``buckets`` cells, so the model holds buckets x languages
numbers. A text is a mixture: each of its words was drawn from one language, with the
probability of the word's grams there. Expectation maximisation estimates the proportions;
then, for the one, two, ... most likely languages, it is run on these alone, for as long as the
likelihood less ``log(words) / 2`` for each further language rises; the last set it rose for is kept.

Texts are handled a few megabytes at a time, all documents of such a piece at once. A text that
is longer than a piece is a piece of its own.

Defined cases: a text that is null or has no letter is ``und`` with score 0, and so is every text
when nothing was learned; rows without text or label teach nothing; ties between languages go to
the name that sorts first; columns named in ``keep`` are carried, others are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from riskloom.llm.common import slices

BUCKETS = 1 << 16
SMOOTHING = 0.5
ROUNDS, SET_ROUNDS = 12, 5
PIECE_BYTES = 1_000_000
UNKNOWN = "und"

_LETTER = re.compile(r"[^\W\d_]")
# Bytes other than ASCII letters and parts of longer characters separate words.
_PLAIN = np.array([b if b >= 128 or chr(b).isalpha() else 32 for b in range(256)], np.uint8)


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    log_p: np.ndarray  # bucket x language


def grams(texts: list[str], buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket of each gram, where each word's grams begin, and how many words each text has.

    A gram belongs to the word that holds its middle byte; the space around a word counts.
    """
    raw = [t.lower().encode() for t in texts]
    joined = np.frombuffer(b" " + b"  ".join(raw) + b"  ", np.uint8)
    plain = _PLAIN[joined]
    middle = plain[1:-1] != 32
    wide = plain.astype(np.uint32)
    code = (wide[:-2] << 16 | wide[1:-1] << 8 | wide[2:])[middle]
    cell = (code * np.uint32(2654435761)) >> np.uint32(32 - (buckets - 1).bit_length())
    opens = middle & (plain[:-2] == 32)
    words = np.flatnonzero(opens[middle])
    ends = np.cumsum([len(r) + 2 for r in raw])  # in positions of ``middle``
    before = np.concatenate(([0], np.cumsum(opens)))
    counts = np.diff(before[np.concatenate(([0], np.minimum(ends, len(opens))))])
    return cell.astype(np.int64), words, counts


def learn(
    docs: DataFrame, text_col: str = "text", label_col: str = "lang", buckets: int = BUCKETS,
    smoothing: float = SMOOTHING,
) -> Model:
    """Gram probabilities per language from all labelled rows."""
    shape = pa.schema([("lang", pa.string()), ("cell", pa.int64()), ("n", pa.int64())])

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in slices(batches, "text", PIECE_BYTES):
            labels = np.array(batch.column("lang").to_pylist(), object)
            texts = np.array(batch.column("text").to_pylist(), object)
            for name in set(labels.tolist()):
                cells, _, _ = grams(texts[labels == name].tolist(), buckets)
                if name not in totals:
                    totals[name] = np.zeros(buckets, np.int64)
                totals[name] += np.bincount(cells, minlength=buckets)
        for name, total in totals.items():
            seen = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(seen), pa.string()), pa.array(seen), pa.array(total[seen])], schema=shape
            )

    rows = (
        docs.select(F.col(label_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
        .dropna()
        .mapInArrow(count, "lang string, cell long, n long")
        .groupBy("lang", "cell")
        .agg(F.sum("n").alias("n"))
        .toArrow()
    )
    languages = sorted(set(rows.column("lang").to_pylist()))
    n = np.zeros((buckets, len(languages)))
    column = np.array([languages.index(x) for x in rows.column("lang").to_pylist()], np.int64)
    n[np.asarray(rows.column("cell"), dtype=np.int64), column] = np.asarray(rows.column("n"))
    log_p = np.log((n + smoothing) / (n.sum(0) + smoothing * buckets))
    return Model(tuple(languages), log_p.astype(np.float32))


def _maximise(likely: np.ndarray, share: np.ndarray, starts: np.ndarray, owner: np.ndarray, rounds: int):
    """Expectation maximisation of each document's ``share``; languages at 0 stay there."""
    n = np.diff(np.append(starts, len(likely)))[:, None]
    for _ in range(rounds):
        drawn = likely * share[owner]
        drawn /= drawn.sum(1, keepdims=True)
        share = np.add.reduceat(drawn, starts, axis=0) / n
    return share


def proportions(log_words: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Document x language shares of the chosen language sets; every count is positive."""
    starts = np.concatenate(([0], np.cumsum(counts)[:-1]))
    owner = np.repeat(np.arange(len(counts)), counts)
    top = log_words.max(1, keepdims=True)
    # Far below the likeliest language a word's own share no longer matters.
    likely = np.exp(np.maximum(log_words - top, -60.0)).astype(np.float64)
    languages = likely.shape[1]
    free = _maximise(likely, np.full((len(counts), languages), 1.0 / languages), starts, owner, ROUNDS)
    order = np.argsort(-free, axis=1, kind="stable")
    fit = np.full(len(counts), -np.inf)
    chosen = np.zeros_like(free)
    # The documents whose penalised likelihood still rises, and their words.
    rising = np.arange(len(counts))
    for size in range(1, languages + 1):
        share = np.zeros((len(rising), languages))
        taken = order[rising, :size]
        # A language the free run has emptied may still be part of the set it starts from.
        np.put_along_axis(share, taken, np.maximum(np.take_along_axis(free[rising], taken, 1), 1e-6), 1)
        share /= share.sum(1, keepdims=True)
        if size > 1:
            share = _maximise(likely, share, starts, owner, SET_ROUNDS)
        value = np.add.reduceat(np.log((likely * share[owner]).sum(1)), starts)
        value -= (size - 1) * np.log(counts[rising] + 1.0) / 2
        better = value > fit[rising] + 1e-9
        fit[rising[better]], chosen[rising[better]] = value[better], share[better]
        if not better.any():
            break
        likely, rising = likely[better[owner]], rising[better]
        starts = np.concatenate(([0], np.cumsum(counts[rising])[:-1]))
        owner = np.repeat(np.arange(len(rising)), counts[rising])
    return chosen


def identify(
    docs: DataFrame, model: Model, keep: Iterable[str] = (), text_col: str = "text",
) -> DataFrame:
    """The columns in ``keep``, ``lang_pred``, its share ``score``, and ``lang_shares`` by language."""
    keep = list(keep)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # buckets x languages numbers
    buckets = len(model.log_p)
    out = T.StructType(
        [docs.schema[c] for c in keep]
        + [
            T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
            T.StructField("lang_shares", T.MapType(T.StringType(), T.DoubleType())),
        ]
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        languages, log_p = shared.value.languages, shared.value.log_p
        for batch in slices(batches, "_text", PIECE_BYTES):
            texts = batch.column("_text").to_pylist()
            names: list = [UNKNOWN] * len(texts)
            scores, shares = [0.0] * len(texts), [[] for _ in texts]
            rows = [i for i, t in enumerate(texts) if t and _LETTER.search(t)] if languages else []
            if rows:
                cells, words, counts = grams([texts[i] for i in rows], buckets)
                own = np.add.reduceat(log_p[cells], words, axis=0) if len(words) else np.zeros((0, len(languages)))
                some = np.flatnonzero(counts)
                found = proportions(own, counts[some]) if len(some) else []
                for k, share in zip(some.tolist(), found):
                    best = int(share.argmax())
                    names[rows[k]], scores[rows[k]] = languages[best], min(1.0, float(share[best]))
                    shares[rows[k]] = [(l, float(s)) for l, s in zip(languages, share) if s > 0]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in keep]
                + [
                    pa.array(names, pa.string()), pa.array(scores, pa.float64()),
                    pa.array(shares, pa.map_(pa.string(), pa.float64())),
                ],
                names=[*keep, "lang_pred", "score", "lang_shares"],
            )

    columns = [F.col(c) for c in keep]
    return docs.select(*columns, F.col(text_col).cast("string").alias("_text")).mapInArrow(run, out)
