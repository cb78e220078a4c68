"""Cross-tokenizer alignment: which tokens of one vocabulary share bytes with which of another.

Both tokenizers cut the same bytes (a space and the text) into tokens. Offsets at which tokens
of both end cut them into groups; a link is a pair of token occurrences whose byte ranges
overlap. Between two neighbouring offsets at which a token of either ends lies exactly one
token of each, so the links of a text are those offsets.

Neither vocabulary has a token that reaches from a non-space character into the white space
after it, so both end a token there and a word with the white space in front of it aligns alone.
Each distinct word is encoded and aligned once per worker; its counts, groups and links are
rows of flat arrays, and a text adds up those of its words. White space that tokens of the
second vocabulary do cross does not end a word.

An id pair's count is the number of texts that hold it linked. An array made ahead maps an id of
the first vocabulary to that of the second with the same bytes. Links of such a pair, which is
what a group of one token each nearly always is, are counted in a vector as long as the
vocabulary, one per task, and the vectors are added up. Only other pairs are shuffled, summed
per task beforehand.

:func:`align` stores a row per text, with its distinct links and how often each occurs.
:func:`pair_counts` counts from that table, and :func:`scored` reads it a second time: the
vector and the most frequent other pairs (at most ``most_shared``) are broadcast, and links of
all rarer pairs are joined with their counts. A pair that a large part of the texts hold is
always among the frequent ones, so the join has no hot key.

Defined cases: a text that is null or empty, or whose tokens' bytes differ from a space and the
text in either vocabulary (as U+2581 makes it), has no tokens and zeros; strings of special
tokens are plain text; null, equal and repeated ids are rows of their own; one text of any
length is held by one task; no texts give no rows; further columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from riskloom.llm.common import keep, row_batch, slices
from riskloom.llm.tokens import _SPACES, Numbers, WordEncoder, as_is, byte_letters, crowded, cut_words, spelled

CACHED_WORDS = 500_000
HELD_PAIRS = 2_000_000
MOST_SHARED = 1 << 19
# A pair of ids is one number: the first above, the second in the lower bits.
SECOND_BITS = 20
_LOW = (1 << SECOND_BITS) - 1
SPACE_PIECE = "▁"

_ROWS = pa.schema(
    [
        ("row", pa.int64()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
        ("n_links", pa.int64()), ("groups_sha256", pa.string()), ("links", pa.binary()), ("times", pa.binary()),
    ]
)
ROWS = (
    "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "links binary, times binary"
)


def first_bytes(tokenizer) -> list[bytes]:
    """Bytes of every entry of a byte-level vocabulary."""
    letters = {ord(c): b for b, c in byte_letters().items()}
    vocabulary = tokenizer.get_vocab()
    out = [b""] * (max(vocabulary.values()) + 1)
    for entry, i in vocabulary.items():
        known = all(ord(c) in letters for c in entry)
        out[i] = bytes(letters[ord(c)] for c in entry) if known else entry.encode()
    return out


def second_bytes(pieces) -> list[bytes]:
    """Bytes of every piece: U+2581 stands for a space, a byte piece for its byte."""
    names = [pieces.id_to_piece(i) for i in range(pieces.get_piece_size())]
    return [
        bytes([int(n[3:5], 16)]) if pieces.is_byte(i) else n.replace(SPACE_PIECE, " ").encode()
        for i, n in enumerate(names)
    ]


def identity_map(first: list[bytes], second: list[bytes], pieces) -> np.ndarray:
    """Per first id the second id with the same bytes, or -1. Of two, the one that is no byte piece."""
    by_bytes = {b: i for i, b in enumerate(second) if pieces.is_byte(i)}
    plain = (i for i in range(len(second)) if not (pieces.is_byte(i) or pieces.is_control(i) or pieces.is_unknown(i)))
    by_bytes |= {second[i]: i for i in plain}
    return np.array([by_bytes.get(b, -1) if b else -1 for b in first], np.int64)


class Aligner:
    """Words aligned so far, as flat arrays, and the alignment of texts from them."""

    def __init__(self, first_path: str, second_path: str, cached_words: int = CACHED_WORDS):
        import sentencepiece

        self.first = WordEncoder(first_path, cached_words, plain=True)
        self.second = sentencepiece.SentencePieceProcessor(model_file=second_path)
        self.first_bytes, self.second_bytes = first_bytes(self.first.tokenizer), second_bytes(self.second)
        if max(len(self.second_bytes), 1) > 1 << SECOND_BITS:
            raise ValueError(f"the second vocabulary has more than {1 << SECOND_BITS} ids")
        self.first_sizes = np.array([len(b) for b in self.first_bytes], np.int64)
        self.second_sizes = np.array([len(b) for b in self.second_bytes], np.int64)
        self.same = identity_map(self.first_bytes, self.second_bytes, self.second)
        self.space = self.second.piece_to_id(SPACE_PIECE)
        self.words = self._word_pattern()
        most = max(len(self.first_bytes), len(self.second_bytes))
        self.signed = {sign: np.array([f"{i}{sign}" for i in range(most)], object) for sign in ",|;"}
        self.cached_words = cached_words
        self.forget()

    def _word_pattern(self) -> re.Pattern:
        """Words cut in front of white space, but for characters that pieces hold behind others."""
        inside = set()
        for i in range(len(self.second_bytes)):
            piece = self.second.id_to_piece(i).replace(SPACE_PIECE, " ")
            inside |= {c for at, c in enumerate(piece) if at and c in _SPACES and piece[at - 1] != c}
        crossed = "".join(c for c in _SPACES if c in inside or c not in " \n\t")
        if " " in crossed:
            raise ValueError("pieces of the second vocabulary reach over spaces")
        more = f"(?:[{re.escape(crossed)}][{_SPACES}]*[^{_SPACES}]*)*" if crossed else ""
        return re.compile(f"[{_SPACES}]*[^{_SPACES}]+{more}|[{_SPACES}]+")

    def forget(self) -> None:
        self.index = Numbers()
        self.groups: list[str] = []
        self.sizes = np.zeros((0, 5), np.int64)  # first tokens, second tokens, groups, links, whether bytes agree
        self.codes, self.starts = np.zeros(0, np.int64), np.zeros(1, np.int64)

    def _second_ids(self, words: list[str]) -> list[list[int]]:
        """Pieces of each word. The tokenizer puts a space ahead, which only some words want."""
        spaced = [w[0] == " " for w in words]
        found = self.second.encode([w[1:] if s else w for w, s in zip(words, spaced)], num_threads=1)
        return [(ids or [self.space]) if s else ids[1:] for ids, s in zip(found, spaced)]

    def learn(self, words: list[str]) -> None:
        """Align new words, all at once, and append them to the arrays."""
        firsts, seconds = self.first.ids_of(words), self._second_ids(words)
        n_a, n_b = np.fromiter(map(len, firsts), np.int64) // 4, np.fromiter(map(len, seconds), np.int64)
        a = np.frombuffer(b"".join(firsts), "<u4").astype(np.int64)
        b = np.fromiter(chain.from_iterable(seconds), np.int64, int(n_b.sum()))
        agree = self._agreeing(words, a, b, n_a, n_b)
        sizes = np.zeros((len(words), 5), np.int64)
        sizes[:, 4] = agree
        a, b, n_a, n_b = a[np.repeat(agree, n_a)], b[np.repeat(agree, n_b)], n_a[agree], n_b[agree]
        # One row of bytes for all words: every word's end is an end of both its tokens.
        a_ends, b_ends = np.cumsum(self.first_sizes[a]), np.cumsum(self.second_sizes[b])
        shared, every = np.intersect1d(a_ends, b_ends, True), np.union1d(a_ends, b_ends)
        codes = a[np.searchsorted(a_ends, every)] << SECOND_BITS | b[np.searchsorted(b_ends, every)]
        word_ends = a_ends[np.cumsum(n_a) - 1]
        last_link, last_group = np.searchsorted(every, word_ends, "right"), np.searchsorted(shared, word_ends, "right")
        sizes[agree, 0], sizes[agree, 1] = n_a, n_b
        sizes[agree, 2], sizes[agree, 3] = np.diff(last_group, prepend=0), np.diff(last_link, prepend=0)
        spelled_out = self._spelled_out(a, b, a_ends, b_ends, shared)
        texts, cuts = [""] * len(words), np.cumsum(n_a + n_b).tolist()
        for k, at, end in zip(np.flatnonzero(agree).tolist(), [0, *cuts], cuts):
            texts[k] = "".join(spelled_out[at:end])
        self.groups += texts
        self.sizes = np.concatenate((self.sizes, sizes))
        self.codes = np.concatenate((self.codes, codes))
        self.starts = np.concatenate((self.starts, self.starts[-1] + np.cumsum(sizes[:, 3])))

    def _agreeing(self, words: list[str], a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
        """Whether the bytes of the tokens of each word are the word's, in both vocabularies."""
        raw = list(map(str.encode, words))
        sizes = np.fromiter(map(len, raw), np.int64)
        agree = np.ones(len(words), bool)
        for ids, n, known in ((a, n_a, self.first_sizes), (b, n_b, self.second_sizes)):
            ends = np.concatenate(([0], np.cumsum(known[ids])))[np.concatenate(([0], np.cumsum(n)))]
            agree &= np.diff(ends) == sizes
        for ids, n, known in ((a, n_a, self.first_bytes), (b, n_b, self.second_bytes)):
            found = list(map(known.__getitem__, ids[np.repeat(agree, n)].tolist()))
            own = np.flatnonzero(agree).tolist()
            if b"".join(found) != b"".join([raw[k] for k in own]):
                # Words of equal sizes that differ: found one by one.
                at = 0
                for k, size in zip(own, n[agree].tolist()):
                    agree[k] = b"".join(found[at : at + size]) == raw[k]
                    at += size
        return agree

    def _spelled_out(
        self, a: np.ndarray, b: np.ndarray, a_ends: np.ndarray, b_ends: np.ndarray, shared: np.ndarray
    ) -> list[str]:
        """Ids of all groups in a row, each with the sign behind it: the first ids of a group, then its second."""
        a_group, b_group = np.searchsorted(shared, a_ends), np.searchsorted(shared, b_ends)
        row = np.empty(len(a) + len(b), object)
        for ids, group, other, end, last in (
            (a, a_group, np.searchsorted(b_group, a_group), "|", np.isin(a_ends, shared, True)),
            (b, b_group, np.searchsorted(a_group, b_group, "right"), ";", np.isin(b_ends, shared, True)),
        ):
            row[np.arange(len(ids)) + other] = np.where(last, self.signed[end][ids], self.signed[","][ids])
        return row.tolist()

    def align(self, texts: list[str | None]) -> list[tuple]:
        """Per text its counts, groups, and distinct links with the times each occurs."""
        if len(self.index) > self.cached_words:
            self.forget()
        # Cut text by text: the new words are aligned together once all are numbered.
        numbered = []
        for text in texts:
            row = " " + text if text else ""
            # The first of the words of a row that is cut at spaces is an empty one.
            words = [] if not text else as_is(self.words.findall(row)) if crowded(row) else cut_words(row)[1:]
            numbered.append(np.fromiter(map(self.index.__getitem__, words), np.int64, len(words)))
        if self.index.new:
            new, self.index.new = self.index.new, []
            self.learn(list(map(spelled, new)))
        out = []
        for at in numbered:
            if not len(at) or not self.sizes[at, 4].all():
                out.append((0, 0, 0, 0, None, at[:0], at[:0]))
                continue
            sizes = self.sizes[at, 3]
            # The words' runs of links behind each other.
            ends = np.cumsum(sizes)
            places = np.arange(ends[-1]) + np.repeat(self.starts[at] - (ends - sizes), sizes)
            links, times = np.unique(self.codes[places], return_counts=True)
            counts = self.sizes[at, :4].sum(axis=0).tolist()
            out.append((*counts, "".join(map(self.groups.__getitem__, at.tolist()))[:-1], links, times))
        return out


@lru_cache(maxsize=2)
def aligner(first_path: str, second_path: str) -> Aligner:
    """The aligner of this worker process."""
    return Aligner(first_path, second_path)


def align(
    docs: DataFrame, first_path: str, second_path: str, id_col: str = "doc_id", text_col: str = "text",
    with_groups: bool = False,
) -> DataFrame:
    """One stored row per text: counts, the digest of its groups, its links and their times.

    ``links`` are 64-bit pairs of ids in ascending order, ``times`` 32-bit counts of them. With
    ``with_groups`` the groups themselves are kept as ``groups``: ``a1,a2|b1;a3|b2``.
    """
    schema = pa.schema([*_ROWS, *([("groups", pa.string())] if with_groups else [])])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = aligner(first_path, second_path)
        row = TaskContext.get().partitionId() << 40
        for batch in slices(batches, "text"):
            done = own.align(batch.column("text").to_pylist())
            groups = [d[4] for d in done]
            columns = [
                np.arange(row, row + len(done)), batch.column("doc_id"), *([d[k] for d in done] for k in range(4)),
                ["" if g is None else hashlib.sha256(g.encode()).hexdigest() for g in groups],
                [d[5].astype("<u8").tobytes() for d in done], [d[6].astype("<u4").tobytes() for d in done],
            ]
            row += len(done)
            yield row_batch(schema, *columns, *([[g or "" for g in groups]] if with_groups else []))

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return keep(texts.mapInArrow(run, ROWS + (", groups string" if with_groups else "")), "aligned")


def _flat(batch: pa.RecordBatch, column: str, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(batch.column(column).to_pylist()), kind).astype(np.int64)


def _own_and_other(codes: np.ndarray, same: np.ndarray) -> np.ndarray:
    """Whether each pair is one of the identity map."""
    return same[codes >> SECOND_BITS] == codes & _LOW


def pair_counts(aligned: DataFrame, first_path: str, second_path: str) -> tuple[np.ndarray, DataFrame]:
    """Texts per pair: a vector over first ids for pairs of the identity map, a table for the others.

    The table is ``(code, n)``, stored; ``code`` is the first id times ``2^SECOND_BITS`` plus the
    second.
    """
    table = pa.schema([("code", pa.int64()), ("n", pa.int64()), ("vector", pa.binary())])

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        same = aligner(first_path, second_path).same
        vector = np.zeros(len(same), np.int64)
        held, size, rows = [], 0, False
        for batch in slices(batches, "links"):
            rows = True
            codes = _flat(batch, "links", "<u8")
            own = _own_and_other(codes, same)
            vector += np.bincount(codes[own] >> SECOND_BITS, minlength=len(same))
            found, n = np.unique(codes[~own], return_counts=True)
            held.append((found, n))
            size += len(found)
            if size > HELD_PAIRS:
                held = [_summed(held)]
                size = len(held[0][0])
                if size > HELD_PAIRS // 2:
                    yield row_batch(table, *held[0], [None] * size)
                    held, size = [], 0
        for found, n in [_summed(held)] if held else []:
            yield row_batch(table, found, n, [None] * len(found))
        if rows:
            yield row_batch(table, [-1], [0], [vector.astype("<i8").tobytes()])

    parts = keep(aligned.select("links").mapInArrow(count, "code long, n long, vector binary"), "pair-parts")
    counts = keep(
        parts.filter("vector IS NULL").groupBy("code").agg(F.sum("n").alias("n")), "pair-counts"
    )
    return _added(parts.filter("vector IS NOT NULL").select("vector"), len(aligner(first_path, second_path).same)), counts


def _summed(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    codes, n = np.concatenate([c for c, _ in held]), np.concatenate([n for _, n in held])
    found, at = np.unique(codes, return_inverse=True)
    return found, np.bincount(at, weights=n, minlength=len(found)).astype(np.int64)


def _added(vectors: DataFrame, size: int, tasks: int = 16) -> np.ndarray:
    """Sum of vectors, one per task so far: a few tasks add them up, the driver adds those."""
    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for v in batch.column("vector"):
                own = np.frombuffer(v.as_py(), "<i8")
                total = own.copy() if total is None else total + own
        if total is not None:
            yield row_batch(pa.schema([("vector", pa.binary())]), [total.tobytes()])

    added = vectors.repartition(tasks).mapInArrow(add, "vector binary").collect()
    return sum((np.frombuffer(r["vector"], "<i8") for r in added), np.zeros(size, np.int64))


def frequent(counts: DataFrame, most: int) -> DataFrame:
    """The most frequent pairs, at most ``most``: all whose count reaches one limit.

    Counts are put into some hundred bins, eight for each doubling, and whole bins are taken.
    """
    level = F.floor(F.log2(F.col("n").cast("double")) * 8).cast("int")
    bins = {r["level"]: r["pairs"] for r in counts.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("pairs")).collect()}
    taken, lowest = 0, None
    for b in sorted(bins, reverse=True):
        taken += bins[b]
        if taken > most:
            break
        lowest = b
    return counts.filter(level >= lowest) if lowest is not None else counts.limit(0)


def scored(
    aligned: DataFrame, identity: np.ndarray, counts: DataFrame, first_path: str, second_path: str,
    most_shared: int = MOST_SHARED,
) -> DataFrame:
    """``aligned`` rows with ``n_best`` and ``count_sum`` over their links."""
    top = frequent(counts, most_shared).toArrow()
    codes, n = np.asarray(top["code"], np.int64), np.asarray(top["n"], np.int64)
    order = np.argsort(codes)
    codes, n = codes[order], n[order]
    # The highest count of each first id: a row per id of the vocabulary.
    highest = identity.copy()
    rows = counts.groupBy(F.shiftright("code", SECOND_BITS).alias("a")).agg(F.max("n").alias("n")).toArrow()
    np.maximum.at(highest, np.asarray(rows["a"], np.int64), np.asarray(rows["n"], np.int64))
    shared = aligned.sparkSession.sparkContext.broadcast((identity, codes, n, highest))
    out = pa.schema(
        [
            *(_ROWS.field(k) for k in range(7)), ("n_best", pa.int64()), ("count_sum", pa.int64()),
            ("rest", pa.list_(pa.struct([("code", pa.int64()), ("times", pa.int64()), ("highest", pa.int64())]))),
        ]
    )

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, known, counted, best = shared.value
        same = aligner(first_path, second_path).same
        for batch in slices(batches, "links"):
            links, times = _flat(batch, "links", "<u8"), _flat(batch, "times", "<u4")
            per_row = np.array([len(x) // 8 for x in batch.column("links").to_pylist()], np.int64)
            row = np.repeat(np.arange(len(per_row)), per_row)
            a, identical = links >> SECOND_BITS, _own_and_other(links, same)
            at = np.minimum(np.searchsorted(known, links), max(len(known) - 1, 0))
            hit = known[at] == links if len(known) else np.zeros(len(links), bool)
            number = np.where(identical, own[a], np.where(hit, counted[at] if len(known) else 0, 0))
            found = identical | hit
            sums, bests = (np.zeros(len(per_row), np.int64) for _ in range(2))
            np.add.at(sums, row[found], (number * times)[found])
            np.add.at(bests, row[found], (times * (number == best[a]))[found])
            left = np.flatnonzero(~found)
            ends = np.searchsorted(row[left], np.arange(len(per_row) + 1)).astype(np.int32)
            rest = pa.ListArray.from_arrays(
                pa.array(ends),
                pa.StructArray.from_arrays(
                    [pa.array(links[left]), pa.array(times[left]), pa.array(best[a[left]])], ["code", "times", "highest"]
                ),
            )
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in range(7)), pa.array(bests), pa.array(sums), rest], schema=out
            )

    kinds = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
    rows = keep(
        aligned.drop("groups").mapInArrow(
            score, f"{kinds}, n_best long, count_sum long, rest array<struct<code: long, times: long, highest: long>>"
        ),
        "alignment-scores",
    )
    rest = (
        rows.select("row", F.inline("rest")).join(counts, "code").groupBy("row").agg(
            F.sum(F.when(F.col("n") == F.col("highest"), F.col("times")).otherwise(0)).alias("_best"),
            F.sum(F.col("n") * F.col("times")).alias("_sum"),
        )
    )
    return rows.drop("rest").join(rest, "row", "left").withColumns(
        {
            "n_best": F.col("n_best") + F.coalesce("_best", F.lit(0)),
            "count_sum": F.col("count_sum") + F.coalesce("_sum", F.lit(0)),
        }
    ).drop("_best", "_sum", "row")


def aligned_documents(docs: DataFrame, first_path: str, second_path: str, most_shared: int = MOST_SHARED, **columns) -> DataFrame:
    """One row per text with its counts, digest, and scores by the counts of all texts."""
    aligned = align(docs, first_path, second_path, **columns)
    identity, counts = pair_counts(aligned, first_path, second_path)
    return scored(aligned, identity, counts, first_path, second_path, most_shared)


def vocabulary_map(identity: np.ndarray, counts: DataFrame, first_path: str, second_path: str) -> DataFrame:
    """``(a, b, n)``: per first id the second ids linked with it in most texts, ties included."""
    own = aligner(first_path, second_path).same
    rows = [(int(a), int(own[a]), int(identity[a])) for a in np.flatnonzero(identity)]
    every = counts.select(
        F.shiftright("code", SECOND_BITS).alias("a"), F.col("code").bitwiseAND(_LOW).alias("b"), "n"
    ).unionAll(counts.sparkSession.createDataFrame(rows, "a long, b long, n long"))
    most = every.groupBy("a").agg(F.max("n").alias("n"))
    return every.join(most, ["a", "n"]).select("a", "b", "n")
