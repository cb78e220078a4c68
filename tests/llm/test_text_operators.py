"""Text operators against plain versions, on ordinary and on odd rows."""

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import brute
from riskloom.llm import (
    byte_runs, components, jaccard_join, language, line_runs, mixing, packing, sharding, suffix_array, token_files,
)
from riskloom.llm.tokens import WordEncoder

WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
ODD_TEXTS = [
    None, "", " ", "\n\n x\ty ", "a  b", "it's I'LL  é ́x", "a b　c d", "x\x1c y\x85 z", "12 345 ..?! ☃😀😀",
    "ΣΣ aΣ", "\x00 b", "a  b   c", "Á̀ İ ß ﬁ", "of </w> a</w>", "<|endoftext|> hi", "one two three four",
]
# Names that the operators use themselves must not disturb them.
EXTRA = {"node": "'n'", "sig": "1", "_text": "int(null)", "key": "2.0D", "length": "'x'"}


def table(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return df.withColumns({name: F.expr(sql) for name, sql in EXTRA.items()}).repartition(3)


def odd_rows():
    rows = [(i, t, "en" if i % 2 else None, f"s{i % 3}" if i % 4 else None, 1) for i, t in enumerate(ODD_TEXTS)]
    twice = (7, ODD_TEXTS[7], "en", "s1", 1)
    return [*rows, twice, (None, "no id here at all", None, None, None), (3, "another text of document three", "de", "s0", 2),
            (99, "long words and more of them. " * 6000, "en", "s9", 3)]


def words(rng, n, size=30):
    return [f"w{rng.randrange(size)}" for _ in range(n)]


# ---- ids, files, packing ---------------------------------------------------------------

@pytest.mark.parametrize("path", [WORDS, BYTES])
def test_cached_words_give_the_tokenizers_ids(path):
    encoder = WordEncoder(path, cached_words=5)
    for part in (ODD_TEXTS[:6], ODD_TEXTS[6:], ODD_TEXTS):
        for text, ids in zip(part, encoder.encode(part)):
            plain = encoder.tokenizer.encode(text or "", add_special_tokens=False).ids
            assert np.frombuffer(ids, "<u4").tolist() == plain


@pytest.mark.parametrize("path", [WORDS, BYTES])
def test_a_full_cache_keeps_the_words_used_most(path):
    encoder, whole = WordEncoder(path, cached_words=60), Tokenizer.from_file(path)
    for k in range(12):
        texts = [f"the often used words {k}x{i} often the" for i in range(20)]
        for text, ids in zip(texts, encoder.encode(texts)):
            assert np.frombuffer(ids, "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids
        assert len(encoder.numbers) == len(encoder.lengths) <= 60 + 25
        # Those seen once go when the cache is full, the frequent ones have their first numbers still.
        assert [encoder.numbers[w] for w in ("\n the", "often", "used", "words")] == [0, 1, 2, 3]


@pytest.mark.parametrize("path", [WORDS, BYTES])
def test_words_are_cut_at_the_tokenizers_white_space(path):
    odd = [chr(c) for c in range(0x3100) if chr(c).isspace()] + ["\u180e", "\u200b", "\ufeff"]
    texts = [f"{a}{c}{b}" for c in odd for a in (" hello!", "a!", "x") for b in ("!x", "!b", "y")] + [" hello!"]
    whole = Tokenizer.from_file(path)
    for text, ids in zip(texts, WordEncoder(path).encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids, repr(text)


def test_joined_words_do_not_merge():
    for path in (WORDS, BYTES):
        encoder, whole = WordEncoder(path), Tokenizer.from_file(path)
        encoder._learn([" hello!", *[f"{chr(c)}!x" for c in range(0x1C, 0x20)], " hi"])
        for word, ids in encoder.known.items():
            assert np.frombuffer(ids, "<u4").tolist() == whole.encode(word, add_special_tokens=False).ids, repr(word)


ADDED_TEXTS = [
    "foo <|endoftext|> bar", "<|endoftext|>", "a<|endoftext|>b", "x  <|endoftext|>  y\n", "<|startoftext|><|endoftext|>.",
    "<|endoftext|", "<|EndOfText|> <|endoftext|><|endoftext|>", "e\u0301<|endoftext|>\u0301 é", "plain words",
]


@pytest.mark.parametrize("path", [WORDS, BYTES])
def test_added_tokens_have_their_ids(path):
    whole, encoder = Tokenizer.from_file(path), WordEncoder(path, cached_words=3)
    for texts in (ADDED_TEXTS, ADDED_TEXTS[::-1], ODD_TEXTS):
        for text, ids in zip(texts, encoder.encode(texts)):
            assert np.frombuffer(ids, "<u4").tolist() == whole.encode(text or "", add_special_tokens=False).ids, repr(text)


def test_token_files_hold_added_tokens(spark, tmp_path):
    path, whole = str(tmp_path / "added"), Tokenizer.from_file(BYTES)
    docs = spark.createDataFrame(list(enumerate(ADDED_TEXTS)), "doc_id long, text string")
    token_files.write_token_files(docs, path, BYTES)
    got = token_files.read_token_files(spark, path).orderBy("doc_id").collect()
    for r, text in zip(got, ADDED_TEXTS, strict=True):
        ids = np.array(whole.encode(text, add_special_tokens=False).ids + [2], "<u4")
        assert (r["n_tokens"], r["ids_crc32"]) == (len(ids), zlib.crc32(ids.tobytes())), repr(text)


def plain_ids(path, text):
    return WordEncoder(path).tokenizer.encode(text or "", add_special_tokens=False).ids + [2]


def test_token_files_hold_all_ids_in_order(spark, tmp_path):
    rows = odd_rows()
    path = str(tmp_path / "ids")
    token_files.write_token_files(table(spark, rows), path, BYTES)
    got = token_files.read_token_files(spark, path).orderBy("start").collect()
    keys = [r["doc_id"] for r in got]
    assert keys[0] is None and keys[1:] == sorted(r[0] for r in rows if r[0] is not None)
    start, left = 0, [(r[0], plain_ids(BYTES, r[1])) for r in rows]
    for r in got:
        same = [x for x in left if x[0] == r["doc_id"] and zlib.crc32(np.array(x[1], "<u4").tobytes()) == r["ids_crc32"]]
        assert same and r["start"] == start and r["n_tokens"] == len(same[0][1])
        left.remove(same[0])
        start += r["n_tokens"]
    assert not left


def test_token_files_of_no_rows(spark, tmp_path):
    token_files.write_token_files(table(spark, odd_rows()).limit(0), str(tmp_path / "none"), BYTES)
    assert token_files.read_token_files(spark, str(tmp_path / "none")).count() == 0


def test_token_files_need_a_mounted_folder(spark):
    with pytest.raises(ValueError):
        token_files.write_token_files(table(spark, odd_rows()), "store://bucket/x", BYTES)


def best_by_trying(at, penalty, length):
    least = {0: 0}
    for j, (here, cost) in enumerate(zip(at, penalty)):
        least[here] = min(
            least[i] + length - (here - i) + cost for i in [0, *at[:j]] if here - i <= length and i in least
        )
    return least


def test_cuts_are_optimal():
    rng = random.Random(3)
    for _ in range(200):
        length = rng.randint(2, 12)
        at = np.cumsum([rng.randint(1, length) for _ in range(rng.randint(1, 20))]).tolist()
        penalty = [rng.choice([0, 1, 5]) for _ in at]
        cuts = packing.best_cuts(np.array(at), np.array(penalty), length, False)
        assert all(b - a <= length for a, b in zip([0, *cuts], cuts))
        cost, before = 0, 0
        for c in cuts:
            cost += length - (c - before) + penalty[at.index(c)]
            before = c
        assert cost == best_by_trying(at, penalty, length)[cuts[-1]]


def test_pieces_cover_every_id_once(spark):
    rows = odd_rows()
    pieces = packing.pack(table(spark, rows), WORDS, length=64, block=300, free_step=16).toPandas()
    assert sorted(pieces.groupby("sequence_id").length.sum())[-1] <= 64
    for _, own in pieces.sort_values("offset").groupby("sequence_id"):
        assert (own["offset"] == own["length"].cumsum() - own["length"]).all()
    short = pieces.groupby("sequence_id").length.sum()
    assert (64 * len(short) - short.sum()) / short.sum() < 0.6  # tiny texts, three partitions
    whole = sorted((str(r[0]), plain_ids(WORDS, r[1])) for r in rows)
    order = pieces.sort_values(["sequence_id", "offset"])
    joined = {}
    for p in order.itertuples():
        key = (str(None if p.doc_id != p.doc_id else int(p.doc_id)), p.doc_tokens)
        joined.setdefault(key, []).append((p.start, np.frombuffer(p.ids, "<u4").tolist()))
    got = []
    for (key, size), parts in joined.items():
        ids = [x for _, part in sorted(parts) for x in part]
        got += [(key, ids[a : a + size]) for a in range(0, len(ids), size)] if len(ids) == size else []
    singles = [w for w in whole if sum(len(x[1]) == len(w[1]) and x[0] == w[0] for x in whole) == 1]
    assert all(s in got for s in singles)
    assert sum(len(w[1]) for w in whole) == pieces["length"].sum()


def test_no_documents_no_pieces(spark):
    assert packing.pack(table(spark, odd_rows()).limit(0), WORDS).count() == 0


# ---- byte runs --------------------------------------------------------------------------

def test_suffix_arrays_and_windows_against_sorting():
    rng = np.random.default_rng(1)
    for _ in range(150):
        s = np.append(rng.integers(1, rng.integers(2, 6), rng.integers(1, 60)), 0).astype(np.int16)
        assert suffix_array.sorted_suffixes(s).tolist() == sorted(range(len(s)), key=lambda i: s[i:].tolist())
        pieces = [bytes(rng.integers(97, 100, rng.integers(0, 30)).astype(np.uint8)) for _ in range(4)]
        windows = [p[i : i + 4] for p in pieces for i in range(len(p) - 3)]
        want = [[i for i in range(len(p) - 3) if windows.count(p[i : i + 4]) > 1] for p in pieces]
        assert [x.tolist() for x in suffix_array.repeated_windows(pieces, 4)] == want


@pytest.mark.parametrize("crowd", [2, 64])
def test_repeated_bytes_against_counting(spark, crowd):
    rng = random.Random(crowd)
    common = " ".join(words(rng, 12))
    rows = []
    for i in range(60):
        text = " ".join(words(rng, rng.randint(0, 30), 400))
        text += common if i % 3 == 0 else ""
        rows.append((i, text + " ".join(words(rng, 10, 400)) if i % 7 else "aa bb " * 30, "en", "s", 1))
    rows += [(100 + i, rows[5][1], "en", "s", 1) for i in range(4)] + odd_rows()[:-1]
    got = byte_runs.remove_repeats(table(spark, rows), length=24, gram=5, crowd=crowd).collect()
    mine = [(r["doc_id"], r["n_bytes"], r["n_removed"], len(r["spans"]), bytes(r["kept"])) for r in got]
    order = lambda x: (str(x[0]), x[1:])
    assert sorted(mine, key=order) == sorted(brute.without_repeats([r[:2] for r in rows], 24), key=order)


def test_long_texts_are_read_in_segments(spark, monkeypatch):
    rng = random.Random(4)
    text = " ".join(words(rng, 400, 1000))
    rows = [(1, text, "en", "s", 1), (2, "x" + text, "en", "s", 1), (3, text[700:1500], "en", "s", 1)]
    data = np.frombuffer(text.encode(), np.uint8)
    none = byte_runs.Known(np.empty(0, np.uint64))
    whole = byte_runs.pieces(data, np.ones(len(data) - 39, bool), 40, 8, none, none)
    assert whole[1].sum() == len(data) - 39  # every window is in one piece
    got = byte_runs.remove_repeats(table(spark, rows), length=40, gram=8).collect()
    assert {r["doc_id"]: r["n_removed"] for r in got} == {1: len(text), 2: len(text), 3: 800}


def test_no_rows_lose_no_bytes(spark):
    assert byte_runs.remove_repeats(table(spark, odd_rows()).limit(0)).count() == 0


# ---- near duplicates --------------------------------------------------------------------

def near_rows(seed, n=120):
    rng = random.Random(seed)
    rows, base = [], None
    shared = words(rng, 40, 5000)
    for i in range(n):
        kind = rng.random()
        if base is None or kind < 0.4:
            base = words(rng, rng.randint(1, 160), 5000)
            own = base + (shared if kind < 0.2 else [])
        else:
            own = list(base)
            for _ in range(rng.randint(0, 6)):
                own[rng.randrange(len(own))] = f"new{rng.randrange(99)}"
        rows.append((i, " ".join(own), "en", "s", 1))
    return rows + odd_rows()


@pytest.mark.parametrize("rare_below", [2, 32])
def test_links_against_all_pairs(spark, rare_below):
    rows = near_rows(rare_below)
    got = jaccard_join.near_duplicates(table(spark, rows), rare_below=rare_below).collect()
    order = lambda x: tuple(-1 if v is None else v for v in x)
    assert sorted(map(tuple, got), key=order) == sorted(brute.jaccard_components([r[:2] for r in rows]), key=order)


def test_similar_sets_share_a_key():
    rng = np.random.default_rng(5)
    universe = np.unique(rng.integers(0, 1 << 63, 5000, dtype=np.uint64))
    table_ = (np.sort(np.unique(jaccard_join.cell_of(universe[::2]))), None)
    table_ = (table_[0], rng.integers(2, 4, len(table_[0])).astype(np.int8))
    for _ in range(400):
        n = int(rng.integers(1, 400))
        a = np.sort(rng.choice(universe, n, replace=False))
        b = np.union1d(a[rng.random(n) < 0.95], rng.choice(universe, int(rng.integers(0, 1 + n // 10))))
        both = len(np.intersect1d(a, b))
        if 100 * both < 80 * (len(a) + len(b) - both) or not len(b):
            continue
        keys = [jaccard_join.keys_of(s, jaccard_join.sizes_of(s, table_)) for s in (a, b)]
        assert len(np.intersect1d(*keys))


def test_no_rows_no_groups(spark):
    assert jaccard_join.near_duplicates(table(spark, odd_rows()).limit(0)).count() == 0


def test_components_of_long_chains(spark):
    links = [(i, i + 1) for i in range(0, 60)] + [(100, 105), (105, 103), (7, 7)]
    got = {tuple(r) for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {(i, 0) for i in range(61)} | {(100, 100), (103, 100), (105, 100)}


# ---- languages --------------------------------------------------------------------------

def test_languages_and_mixtures(spark):
    rng = random.Random(8)
    parts = {"aa": ["the", "and", "thing", "with"], "bb": ["der", "und", "nicht", "ein"], "cc": ["les", "que", "pour", "avec"]}
    text = lambda lang, n: " ".join(rng.choice(parts[lang]) + rng.choice(["", "s", "en"]) for _ in range(n))
    rows = [(i, text(lang, 40), lang, "s", 1) for i, lang in enumerate(list(parts) * 30)]
    model = language.learn(table(spark, rows + [(900, None, "aa", "s", 1), (901, "und der", None, "s", 1)]))
    assert model.languages == ("aa", "bb", "cc")
    asked = [(1, text("bb", 30), "", "", 1), (2, text("aa", 60) + ". " + text("cc", 20), "", "", 1),
             (3, None, "", "", 1), (4, " 12 ..", "", "", 1), (5, "", "", "", 1), (6, "Ж", "", "", 1), (6, "Ж", "", "", 1)]
    got = {r["doc_id"]: r for r in language.identify(table(spark, asked), model, keep=["doc_id", "source"]).collect()}
    assert got[1]["lang_pred"] == "bb" and got[1]["score"] > 0.99
    assert set(got[2]["lang_shares"]) == {"aa", "cc"} and abs(got[2]["score"] - 0.75) < 0.1
    assert all(got[i]["lang_pred"] == "und" and got[i]["score"] == 0 for i in (3, 4, 5))
    assert got[6]["lang_pred"] in model.languages
    nothing = language.learn(table(spark, rows).limit(0))
    assert {r["lang_pred"] for r in language.identify(table(spark, asked), nothing).collect()} == {"und"}
    assert language.identify(table(spark, asked).limit(0), model).count() == 0


def test_odd_rows_have_a_language(spark):
    rows = table(spark, odd_rows())
    got = language.identify(rows, language.learn(rows), keep=["doc_id"]).collect()
    assert len(got) == len(odd_rows()) and all(0 <= r["score"] <= 1 for r in got)


# ---- lines ------------------------------------------------------------------------------

def test_later_runs_of_lines_against_comparison(spark):
    rng = random.Random(6)
    pool = [" ".join(words(rng, rng.randint(0, 6))) for _ in range(12)]
    docs = [(i, "\n".join(rng.choice(pool) if rng.random() < 0.7 else f"own {i} {k}" for k in range(rng.randint(1, 14))))
            for i in range(40)]
    docs += [(40, "a b c\n" * 9), (41, docs[3][1]), (42, docs[3][1] + "\nend")]
    got = line_runs.without_repeated_lines(table(spark, [(*d, "en", "s", 1) for d in docs]), min_words=7).collect()
    assert [r["text"] for r in sorted(got, key=lambda r: r["doc"]["doc_id"])] == brute.without_later_lines(docs, 7)


def test_runs_of_any_script_and_separator_are_copies(spark):
    table_row, plain, joined = "a\tb\tc", "这是一个没有空格的段落" * 20, "x\u00a0y\u00a0z " * 3
    docs = [(1, f"{table_row}\nfirst\n"), (2, f"{table_row}\n{plain}\nHome"), (3, f"{plain}\nHome\n{joined}\nlast"),
            (4, joined), (5, f"new\n\nfirst\n{table_row}\nend")]
    got = line_runs.without_repeated_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    texts = [r["text"] for r in sorted(got, key=lambda r: r["doc"]["doc_id"])]
    assert texts == [f"{table_row}\nfirst\n", f"{plain}\nHome", f"{joined}\nlast", "", "new\nend"]
    assert texts == brute.without_later_lines(docs, 0)


def test_lines_of_odd_rows(spark):
    got = line_runs.without_repeated_lines(table(spark, odd_rows())).collect()
    assert len(got) == len(odd_rows())
    assert sorted(r["text"] is None for r in got).count(True) == 1
    assert all(r["doc"]["node"] == "n" for r in got)
    assert line_runs.without_repeated_lines(table(spark, odd_rows()).limit(0)).count() == 0
    alone = spark.createDataFrame([(1, "only one"), (2, "and two")], "doc_id long, text string")
    assert line_runs.without_repeated_lines(alone).filter("n_removed > 0").count() == 0


# ---- shards and mixtures -----------------------------------------------------------------

def test_shards_follow_the_plain_permutation(spark):
    rows = odd_rows()
    got = sharding.shard(table(spark, rows), shards=3).collect()
    assert sorted(r["row"] for r in got) == list(range(len(rows)))
    plain = lambda x: brute.feistel(x, len(rows), 20, sharding.half_bits, sharding.round_keys, sharding.PRIME)
    for r in got:
        assert (r["shard"], r["slot"]) == (plain(r["row"]) % 3, plain(r["row"]) // 3)
        assert r["law"] == "rows" and r["grown_shard"] is None
    sized = sorted((r["size"], r["text_crc32"]) for r in got)
    assert sized == sorted((len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for _, t, *_ in rows)
    again = sharding.shard(table(spark, rows[::-1]).repartition(5), shards=3)
    key = lambda rows: sorted((str(r["doc_id"]), r["text_crc32"], r["shard"], r["slot"]) for r in rows)
    assert key(again.collect()) == key(got)
    assert sharding.shard(table(spark, rows).limit(0)).count() == 0


@pytest.mark.parametrize("rows", [1, 2, 5, 1000])
def test_permutations_are_onto(rows):
    plain = lambda x: brute.feistel(x, rows, 3, sharding.half_bits, sharding.round_keys, sharding.PRIME)
    assert sorted(map(plain, range(rows))) == list(range(rows))


WEIGHTS = {"domain": {"x": 3.0, "y": 1.0}, "lang": {"en": 2.0, "zz": 0.0}}


def test_budgets_fill_siblings_first(spark):
    leaves = [("x", "en", "a", 100), ("x", "en", "b", 5), ("x", "de", "a", 10), ("y", "en", "a", 50), ("y", "zz", "a", 70),
              ("z", "de", "c", 1)]
    df = spark.createDataFrame(leaves, "_domain string, _lang string, _source string, _tokens long")
    for budget in (30, 90, 140, 10_000):
        got = {tuple(r)[:3]: r["_budget"] for r in mixing.leaf_budgets(df, budget, WEIGHTS, 1).collect()}
        weight = lambda level, name: WEIGHTS.get(level, {}).get(name, 1.0)
        open_ = [l for l in leaves if weight("lang", l[1]) > 0]
        cap = lambda *path: sum(l[3] for l in open_ if l[: len(path)] == path)
        want = {}
        domains = {d: (weight("domain", d), cap(d)) for d in {l[0] for l in open_}}
        for d, b in brute.shares(domains, budget).items():
            langs = {g: (weight("lang", g), cap(d, g)) for g in {l[1] for l in open_ if l[0] == d}}
            for g, c in brute.shares(langs, b).items():
                sources = {s: (1.0, cap(d, g, s)) for s in {l[2] for l in open_ if l[:2] == (d, g)}}
                want |= {(d, g, s): v for s, v in brute.shares(sources, c).items()}
        assert got == pytest.approx(want)


def test_leaves_give_the_longest_prefix(spark):
    rng = random.Random(2)
    rows = [(i, " ".join(words(rng, rng.randint(0, 9))), rng.choice(["en", "de"]), rng.choice("ab"), 1) for i in range(300)]
    rows += odd_rows()
    settings = dict(budget_share=0.7, max_epochs=2, seed=5)
    docs = table(spark, rows)
    got = mixing.mix(docs, F.lit("all"), {"lang": {"en": 9.0}}, **settings).toPandas()
    keyed = docs.withColumn("_row", F.xxhash64("doc_id", "text")).toPandas()
    assert (got.groupby(["doc_id", "lang", "source", "tokens"], dropna=False)["epoch"].max() <= 1).all()
    for (lang, source), own in got.groupby(["lang", "source"]):
        budget, tokens = own["leaf_budget"].iloc[0], own["leaf_tokens"].iloc[0]
        assert own["tokens"].sum() <= budget + 1e-6
        assert tokens == sum(len(t.split()) for i, t, g, s, _ in rows if t and (g or "none") == lang and (s or "none") == source
                             and all(ord(c) < 128 for c in t)) or source not in "ab"
    whole = mixing.mix(docs, F.lit("all"), {}, budget_share=1.0, max_epochs=1).count()
    assert whole == sum(bool(t and any(c not in " \t\n\x0b\x0c\r" for c in t)) for _, t, *_ in rows)
    back = mixing.mixed_rows(docs, F.lit("all"), {}, budget_share=1.0, max_epochs=1)
    assert back.count() == whole and back.columns == docs.columns and len(keyed) == len(rows)
    assert mixing.mix(docs.limit(0), F.lit("all"), {}).count() == 0


def test_the_mix_is_the_same_for_any_layout(spark):
    rows = [(i, f"text {i} " * (i % 5), "en", "s", 1) for i in range(200)]
    key = lambda df: sorted((r["doc_id"], r["epoch"]) for r in df.collect())
    a = mixing.mix(table(spark, rows), F.lit("d"), {}, budget_share=0.4)
    assert key(a) == key(mixing.mix(table(spark, rows[::-1]).repartition(7), F.lit("d"), {}, budget_share=0.4))


def test_doubling_sorts_only_what_is_still_equal(monkeypatch):
    rng = np.random.default_rng(3)
    s = np.append(np.append(rng.integers(1, 5000, 4000), [7] * 64), 0)
    sorted_sizes, argsort = [], np.argsort
    monkeypatch.setattr(np, "argsort", lambda x, *a, **k: sorted_sizes.append(len(x)) or argsort(x, *a, **k))
    got = suffix_array._doubled(s).tolist()
    assert got == sorted(range(len(s)), key=lambda i: s[i:].tolist())
    assert sum(sorted_sizes) < 3 * len(s)


def _pieces_with_one_key(rng, gram=24):
    anchor = bytes(rng.integers(97, 123, gram, dtype=np.uint8))
    word = lambda n: bytes(rng.integers(97, 123, n, dtype=np.uint8))
    left, right = word(300), word(300)
    texts = [word(300) + anchor + word(300) for _ in range(20)]  # the anchor alone
    texts += [word(200) + left[-190:] + anchor + right[:186] + word(9) for _ in range(2)]  # one window
    texts += [word(200) + left[-186:] + anchor + right[:190] + word(9) for _ in range(2)]
    texts.append(word(400) + anchor + right + word(10))
    return anchor, texts


def test_pieces_that_share_no_window_reach_no_suffix_array(monkeypatch):
    rng = np.random.default_rng(5)
    keys, texts, rows = [], [], []
    for k in range(3):
        anchor, own = _pieces_with_one_key(rng)
        if k == 2:
            own[0] = anchor + own[0]  # twice the anchor: the key is kept whole
        data = np.frombuffer(anchor, np.uint8)
        key = byte_runs.span_hashes(data, np.array([0]), np.array([len(data)]))[0]
        keys += [key] * len(own)
        texts += own
    keys = np.array(keys, np.uint64)
    kept = byte_runs.alike(keys, texts, 400, 24)
    all_ = suffix_array.repeated_windows(texts, 400)
    some = suffix_array.repeated_windows([t for t, k in zip(texts, kept) if k], 400)
    assert [m.tolist() for m, k in zip(all_, kept) if not k] == [[]] * int((~kept).sum())
    assert [m.tolist() for m, k in zip(all_, kept) if k] == [m.tolist() for m in some]
    assert not kept[:20].any() and kept[20:24].all() and not kept[24] and kept[50:].all() and any(len(m) for m in some)

    seen = []
    monkeypatch.setattr(
        byte_runs, "repeated_windows", lambda p, n: seen.append(len(p)) or suffix_array.repeated_windows(p, n)
    )
    batch = pa.RecordBatch.from_arrays(
        [pa.array(keys.view(np.int64)), pa.array(np.arange(len(keys))), pa.array(texts, pa.binary())],
        names=["key", "name", "bytes"],
    )
    list(byte_runs._marked(400, 24)([batch]))
    assert sum(seen) == kept.sum() < len(texts)


def _pieces_of_repeated_words(rng):
    """Pieces of texts that repeat one of three words between text of their own: keys and bytes."""
    none = byte_runs.Known(np.empty(0, np.uint64))
    word = lambda n: bytes(rng.integers(97, 123, n, dtype=np.uint8))
    repeated, found = [word(5) * 150, word(7) * 100, word(12) * 60], {}
    for i in range(30):
        raw = word(350) + repeated[i % 3][i % 2 :] + word(350)
        data = np.frombuffer(raw, np.uint8)
        first, count, key, name = byte_runs.pieces(data, np.ones(len(data) - 399, bool), 400, 24, none, none)
        found |= {(k, n): raw[a : a + c + 399] for a, c, k, n in zip(first, count, key, name)}
    keys = np.array([k for k, _ in found], np.uint64)
    shared = np.flatnonzero([(keys == k).sum() > 1 for k in keys])
    return keys[shared], [list(found.values())[i] for i in shared]


def test_pieces_of_repeated_words_are_set_aside_one_by_one():
    keys, texts = _pieces_of_repeated_words(np.random.default_rng(6))
    hashes = lambda t: byte_runs.span_hashes(
        np.frombuffer(t, np.uint8), np.arange(len(t) - 23), np.arange(24, len(t) + 1)
    )
    again = np.array([(hashes(t) == k).sum() > 1 for t, k in zip(texts, keys)])
    kept = byte_runs.alike(keys, texts, 400, 24)
    all_ = [len(m) > 0 for m in suffix_array.repeated_windows(texts, 400)]
    assert kept[all_].all() and (kept & again).any() and (again & ~kept).sum() > 10

    some = suffix_array.repeated_windows([t for t, k in zip(texts, kept) if k], 400)
    assert [len(m) > 0 for m in some] == [m for m, k in zip(all_, kept) if k]


def test_names_of_repeated_words_are_not_sorted_bucket_by_bucket(monkeypatch):
    rng = np.random.default_rng(8)
    s = np.append(np.concatenate([np.tile(rng.integers(1, 1500, 30), 12) for _ in range(30)]), 0)
    put, blocks = suffix_array._Passes._put, []
    monkeypatch.setattr(suffix_array._Passes, "_put", lambda self, *a: blocks.append(len(a[2])) or put(self, *a))
    assert suffix_array.sorted_suffixes(s).tolist() == sorted(range(len(s)), key=lambda i: s[i:].tolist())
    assert len(blocks) < 300


def test_doubling_starts_from_several_characters(monkeypatch):
    rng = np.random.default_rng(7)
    for largest in (1, 2, 300, 70000, 1 << 40):
        for n in (0, 1, 2, 3, 50, 700):
            s = np.append(rng.integers(1, largest + 1, n), 0)
            s[n // 2 : n] = s[: n - n // 2]
            assert suffix_array._doubled(s).tolist() == sorted(range(n + 1), key=lambda i: s[i:].tolist())
    rounds, argsort = [], np.argsort
    monkeypatch.setattr(np, "argsort", lambda x, *a, **k: rounds.append(len(x)) or argsort(x, *a, **k))
    suffix_array._doubled(np.append(np.tile(rng.integers(1, 500, 40), 100), 0))
    assert len(rounds) < 12


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_odd_words_of_many_scripts_have_the_tokenizers_ids(path):
    rng = np.random.default_rng(8)
    letters = [*"ab'sS1 ½²ªµ é\n\t\0 \x85\xa0\x1c日,.!ſ", "'s", "  ", " \n", "́", "<|endoftext|>"]
    texts = ["".join(rng.choice(letters, rng.integers(1, 30))) for _ in range(3000)]
    encode = WordEncoder(path, cached_words=200)
    wanted = encode.tokenizer.encode_batch(texts, add_special_tokens=False)
    for at in range(0, len(texts), 300):
        found = encode.encode(texts[at : at + 300])
        assert [np.frombuffer(f, "<u4").tolist() for f in found] == [w.ids for w in wanted[at : at + 300]]


def test_a_worker_hashes_shingles_and_holds_parts_within_bounds(monkeypatch):
    sizes = []
    hashes = jaccard_join.word_shingles
    monkeypatch.setattr(
        jaccard_join, "word_shingles", lambda texts, n: sizes.append(sum(map(len, texts))) or hashes(texts, n)
    )

    class Rows:
        def mapInArrow(self, function, schema):
            return function

    texts = [f"w{i} " * 20_000 for i in range(40)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(40)), pa.array(texts)], names=["doc_id", "text"])
    run = jaccard_join._sets(Rows(), lambda ids, sets: [(len(ids), len(sets))], "")
    assert sum(n for n, m in run([batch]) if n == m) == 40
    assert max(sizes) <= jaccard_join.HASHED < jaccard_join.PIECE

    encode = WordEncoder(BYTES, cached_words=800)
    for at in range(20):
        encode.encode([" ".join(f"w{chr(97 + at)}x{chr(97 + i // 10)}{chr(97 + i % 10)}" for i in range(100))])
        assert len(encode.parts) <= 100 + 2  # an eighth of the cached words
