"""Token ids of whole texts, with each distinct word encoded once per worker.

Both vocabularies split a text into words before any merge, and no token crosses from a
non-space character into the white space after it (white space as their expressions know it).
Cutting a text in front of every run of white space therefore leaves its ids unchanged, and the
ids of a text are those of its words in a row. Words are kept in a bounded cache, which when full
keeps those used most; unknown ones are encoded many at a time. Unknown words of Latin-1 characters are split by the tokenizer's own
expression, its classes spelled out, and go straight to its merges, each distinct part once; all
others pass through the whole tokenizer.

A text without white space in a row, or at its end, is cut at its spaces and line ends alone,
which leaves its other white space inside words; the same rule makes that right.

The strings of added tokens are their ids, wherever they stand: the tokenizers cut a raw text
there before anything else, and so does this module. It refuses added tokens for which that is
not all there is to it.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

BYTE_BPE = "byte_bpe_50k.json"
WORD_BPE = "word_bpe_49k.json"

# The tokenizers' white space. That of Python also holds U+001C to U+001F, which are symbols here.
_SPACES = "\t\n\v\f\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
# White space together with the word behind it, or what is left at the end of a text.
_WORDS = re.compile(f"[{_SPACES}]*[^{_SPACES}]+|[{_SPACES}]+")
# Characters whose classes and lower case no two libraries see differently.
_SIMPLE = re.compile("[\0-\x1b\x20-\x84\x86-\xff]*")
# White space that further white space or the end of the text follows.
_CROWDED = re.compile(r"[ \n](?:\s|\Z)")
_PAIRS = ("  ", " \n", "\n ", "\n\n")
_RARE_SPACES = [c for c in map(chr, range(0x110000)) if c.isspace() and c not in " \n"]
_RARE_ASCII = [c for c in _RARE_SPACES if c.isascii()]
# Ahead of a word that is taken as it stands; others follow a space, or begin with a line end.
_AS_IS = "\n "
_CACHED_WORDS = 500_000
_GATHERED = 1_000_000
_CHUNK_CHARS = 1_000_000
_TESTED = 32
_PARTS_SHARE = 8  # of the cached words, how many parts are kept beside them

# ---- fixed values: how the tokenizers split a text ---------------------------
BYTE_LEVEL_PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
WORD_NORMALIZERS = ["NFC", "Replace", "Lowercase"]
# ---- end of fixed values -----------------------------------------------------


def byte_letters() -> dict[int, str]:
    """Byte to the character that stands for it in a byte-level vocabulary.

    Printable characters other than spaces stand for themselves, the rest for those from 256 on.
    """
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = sorted(set(range(256)).difference(printable))
    return {b: chr(b) for b in printable} | {b: chr(256 + k) for k, b in enumerate(others)}


def _own_split(tokenizer) -> tuple[re.Pattern, bool] | None:
    """The expression a tokenizer splits by and whether it lowers case, if it is of a known kind."""
    config = json.loads(tokenizer.to_str())
    steps = config["pre_tokenizer"] or {}
    steps = steps.get("pretokenizers", [steps])
    normal = config["normalizer"] or {"normalizers": []}
    normal = [n["type"] for n in normal.get("normalizers", [normal])]
    last = steps[-1]
    if config["model"]["type"] != "BPE" or last.get("type") != "ByteLevel" or last["add_prefix_space"]:
        return None
    if len(steps) == 1 and last["use_regex"] and not normal:
        return latin(BYTE_LEVEL_PATTERN), False
    first = steps[0]
    if (
        len(steps) == 2 and not last["use_regex"] and normal == WORD_NORMALIZERS
        and first.get("type") == "Split" and first["behavior"] == "Removed" and first["invert"]
    ):
        return latin(first["pattern"]["Regex"] + r"|\s+"), True
    return None


def crowded(text: str) -> bool:
    """Whether the text has white space in a row or at its end."""
    if text[-1:] in (" ", "\n") or any(pair in text for pair in _PAIRS):
        return True
    # Only other white space behind a space is left, which hardly any text has.
    rare = _RARE_ASCII if text.isascii() else _RARE_SPACES
    return any(c in text for c in rare) and _CROWDED.search(text) is not None


def cut_words(text: str) -> list[str]:
    """Names of the words of a text that is not crowded: it is cut at spaces and line ends alone."""
    words = text.replace("\n", " \n").split(" ")
    words[0] = _AS_IS + words[0]
    return words


def as_is(words: list[str]) -> list[str]:
    """Names of words that are taken as they stand."""
    return [_AS_IS + w for w in words]


def spelled(name: str) -> str:
    """The word of a name."""
    return name[2:] if name.startswith(_AS_IS) else name if name.startswith("\n") else " " + name


def first_and_rest(text: str) -> tuple[str, str | None]:
    """Name of the first word of such a text, and the others' names with spaces between them."""
    first, space, rest = text.replace("\n", " \n").partition(" ")
    return _AS_IS + first, rest if space else None


def latin(pattern: str) -> re.Pattern:
    """The same expression for texts of Latin-1 characters, whose classes are spelled out."""
    def spelled_out(kind: str, other: bool = False) -> str:
        holds = regex.compile(kind).fullmatch
        return "".join(f"\\x{i:02x}" for i in range(256) if bool(holds(chr(i))) != other)

    inner = {kind: spelled_out(kind) for kind in (r"\p{L}", r"\p{N}", r"\s")} | {r"\S": spelled_out(r"\s", True)}
    out, inside = [], False
    for part in re.findall(r"\\p\{\w+\}|\\.|.", pattern, re.S):
        inside = part == "[" or inside and part != "]"
        out.append(part if part not in inner else inner[part] if inside else f"[{inner[part]}]")
    return re.compile("".join(out))


class Numbers(dict):
    """Numbers words in the order they come, and lists those it has not seen."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        self.new.append(word)
        return number


class WordEncoder:
    """Ids of texts as little-endian unsigned 32-bit integers.

    ``cached_words`` bounds the memory of the cache; it never changes an id. With ``plain`` the
    strings of added tokens are ordinary text.
    """

    def __init__(self, path: str, cached_words: int = _CACHED_WORDS, plain: bool = False):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain
        self.own_split = _own_split(self.tokenizer)
        self.letters = byte_letters()
        self.parts: dict[str, bytes] = {}
        self.added: dict[str, bytes] = {}
        for i, t in ([] if plain else self.tokenizer.get_added_tokens_decoder().items()):
            if t.normalized or t.lstrip or t.rstrip or t.single_word:
                raise ValueError(f"added token {t.content!r} takes in more than its string")
            self.added[t.content] = np.array([i], "<u4").tobytes()
        longest = sorted(self.added, key=len, reverse=True)
        self.at_added = re.compile("(" + "|".join(map(re.escape, longest)) + ")") if longest else None
        self.cached_words = cached_words
        self.forget()

    def _split(self, text: str) -> list[str]:
        """Words and strings of added tokens in a row."""
        if not self.at_added or not self.at_added.search(text):
            return _WORDS.findall(text)
        parts = self.at_added.split(text)
        return [w for i, part in enumerate(parts) for w in ([part] if i % 2 else _WORDS.findall(part))]

    def _learn(self, words: list[str]) -> None:
        """Encode words and keep their ids in ``known``."""
        if self.own_split:
            simple, other = [], []
            for at in range(0, len(words), _TESTED):
                some = words[at : at + _TESTED]
                if _SIMPLE.fullmatch("".join(some)):
                    simple += some
                    continue
                for w in some:
                    (simple if _SIMPLE.fullmatch(w) else other).append(w)
            for at in range(0, len(simple), 100_000):
                self._merge(simple[at : at + 100_000])
            words = other
        self._encode_rest(words)

    def _merge(self, words: list[str]) -> None:
        """Split simple words as the tokenizer does and merge each distinct part once.

        A word starts with white space or is taken alone, so no part reaches over its end.
        """
        pattern, lower = self.own_split
        joined = [w for w in words if w[0] in _SPACES and w[-1] not in _SPACES]
        split = [pattern.findall(w.lower() if lower else w) for w in words if w[0] not in _SPACES or w[-1] in _SPACES]
        row = "".join(joined)
        found = pattern.findall(row.lower() if lower else row)
        new = list(set(found).union(*split).difference(self.parts))
        if lower:
            self.parts.update((part, b"") for part in new if part.isspace())
            new = [part for part in new if not part.isspace()]
        tokenize = self.tokenizer.model.tokenize
        # No byte of a text is spelled as a zero, so zeros keep the parts apart.
        apart = "\0".join(new)
        if apart.count("\0") < len(new):
            spelled_out = apart.encode().decode("latin-1").translate(self.letters | {0: "\0"}).split("\0")
        else:
            spelled_out = [part.encode().decode("latin-1").translate(self.letters) for part in new]
        for part, letters in zip(new, spelled_out):
            self.parts[part] = array("I", [t.id for t in tokenize(letters)]).tobytes()
        ids = self.parts.__getitem__
        ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)))
        cuts = np.searchsorted(ends, np.cumsum([len(w) for w in joined], dtype=np.int64)) + 1
        done = list(map(ids, found))
        for w, a, b in zip(joined, [0, *cuts.tolist()], cuts.tolist()):
            self.known[w] = b"".join(done[a:b])
        alone = (w for w in words if w[0] not in _SPACES or w[-1] in _SPACES)
        for w, parts in zip(alone, split):
            self.known[w] = b"".join(map(ids, parts))

    def _encode_rest(self, words: list[str]) -> None:
        """Encode words that start with white space in a row, the others alone."""
        joined = [w for w in words if w[0] in _SPACES and w[-1] not in _SPACES]
        alone = [w for w in words if w[0] not in _SPACES or w[-1] in _SPACES]
        for w, e in zip(alone, self.tokenizer.encode_batch(alone, add_special_tokens=False)):
            self.known[w] = np.array(e.ids, "<u4").tobytes()
        at = 0
        while at < len(joined):
            size, end = 0, at
            while end < len(joined) and size < _CHUNK_CHARS:
                size += len(joined[end])
                end += 1
            part = joined[at:end]
            starts = np.cumsum([0] + [len(w) for w in part[:-1]])
            done = self.tokenizer.encode("".join(part), add_special_tokens=False)
            ids = np.array(done.ids, "<u4")
            first = np.array([o[0] for o in done.offsets], np.int64)
            cuts = np.searchsorted(first, starts).tolist() + [len(ids)]
            for w, a, b in zip(part, cuts, cuts[1:]):
                self.known[w] = ids[a:b].tobytes()
            at = end

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text; a null text has none."""
        if len(self.numbers) > self.cached_words:
            self._keep_used()
        at, sizes = self._numbered(texts)
        if self.numbers.new:
            self._number_new()
        self.uses += np.bincount(at, minlength=len(self.uses))
        ids = np.concatenate([*self._gathered(at), self.ids[:0]])
        ends = np.concatenate(([0], np.cumsum(self.lengths[at])))[np.concatenate(([0], np.cumsum(sizes)))].tolist()
        return [ids[a:b].tobytes() for a, b in zip(ends, ends[1:])]

    def _numbered(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the words of all texts in a row, and how many words each text has.

        Arrow cuts the texts that are not crowded and finds their distinct words, so the cache
        is asked once for each of these; it names their first words apart.
        """
        begin: list[list[str]] = []  # the first word of a plain text, all words of another
        rest: list[str | None] = []
        for t in texts:
            if t and not crowded(t) and not (self.at_added and self.at_added.search(t)):
                first, others = first_and_rest(t)
                begin.append([first])
                rest.append(others)
            else:
                begin.append(as_is(self._split(t)) if t else [])
                rest.append(None)
        number = self.numbers.__getitem__
        ahead = np.array([len(words) for words in begin], np.int64)
        behind = np.array([0 if r is None else r.count(" ") + 1 for r in rest], np.int64)
        sizes = ahead + behind
        at = np.empty(int(sizes.sum()), np.int64)
        # Of each text the words in ``begin`` come first, then those of ``rest``.
        is_begin = np.repeat(np.tile([True, False], len(texts)), np.column_stack((ahead, behind)).ravel())
        at[is_begin] = np.fromiter(map(number, chain.from_iterable(begin)), np.int64, int(ahead.sum()))
        joined = pa.array([" ".join(r for r in rest if r is not None)], pa.large_string())
        if behind.any():
            words = pc.split_pattern(joined, " ").flatten().dictionary_encode()
            names = words.dictionary.to_numpy(zero_copy_only=False)  # much faster than a list
            distinct = np.fromiter(map(number, names), np.int64, len(names))
            at[~is_begin] = distinct[np.asarray(words.indices)]
        return at, sizes

    def _number_new(self) -> None:
        """Encode the words that were numbered last and append their ids."""
        new, self.numbers.new = self.numbers.new, []
        found = self.ids_of(list(map(spelled, new)))
        lengths = np.array([len(i) // 4 for i in found], np.int64)
        self.starts = np.concatenate((self.starts, len(self.ids) + np.cumsum(lengths) - lengths))
        self.lengths = np.concatenate((self.lengths, lengths))
        self.uses = np.concatenate((self.uses, np.zeros(len(new), np.int64)))
        self.ids = np.concatenate((self.ids, np.frombuffer(b"".join(found), "<u4")))

    def _keep_used(self) -> None:
        """Keep the words used most, of those used more than once; few new words ever come back."""
        kept = np.flatnonzero(self.uses > 1)
        most = self.cached_words // 2
        if len(kept) > most:
            kept = np.sort(kept[np.argsort(-self.uses[kept], kind="stable")[:most]])
        marked = np.zeros(len(self.uses), bool)
        marked[kept] = True
        numbers = Numbers()
        numbers.update(zip(compress(self.numbers, marked.tolist()), range(len(kept))))
        ids = np.concatenate([*self._gathered(kept), self.ids[:0]])
        self.numbers, self.ids, self.lengths = numbers, ids, self.lengths[kept]
        self.starts, self.uses = np.cumsum(self.lengths) - self.lengths, self.uses[kept] // 2

    def ids_of(self, words: list[str]) -> list[bytes]:
        """Ids of words, which are not kept; only the parts they share with others are."""
        self._learn([w for w in words if w and w not in self.known])
        found = [self.known[w] if w else b"" for w in words]
        self.known = dict(self.added)
        if len(self.parts) > self.cached_words // _PARTS_SHARE:
            self.parts = {}
        return found

    def _gathered(self, at: np.ndarray) -> Iterator[np.ndarray]:
        """Ids of numbered words in a row."""
        for begin in range(0, len(at), _GATHERED):
            words = at[begin : begin + _GATHERED]
            lengths = self.lengths[words]
            ends = np.cumsum(lengths)
            yield self.ids[np.arange(ends[-1]) + np.repeat(self.starts[words] - (ends - lengths), lengths)]

    def forget(self) -> None:
        """Empty the cache."""
        self.numbers, self.parts, self.known = Numbers(), {}, dict(self.added)
        self.ids, self.lengths, self.starts = np.zeros(0, "<u4"), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.uses = np.zeros(0, np.int64)


@lru_cache(maxsize=4)
def encoder(path: str) -> WordEncoder:
    """The encoder of this worker process; the path is a parameter of every caller."""
    return WordEncoder(path)


@lru_cache(maxsize=4)
def sentence_ends(path: str) -> np.ndarray:
    """Per id, whether its token closes a sentence."""
    vocabulary = encoder(path).tokenizer.get_vocab()
    ends = np.zeros(max(vocabulary.values()) + 1, bool)
    for token, i in vocabulary.items():
        ends[i] = token.removesuffix("</w>").endswith((".", "!", "?"))
    return ends
