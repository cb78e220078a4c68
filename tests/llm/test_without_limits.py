"""Vectors of any size, documents of any number of languages, words of any script."""

import random

import brute
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from riskloom.llm import language, norm_search
from riskloom.llm.tokens import WordEncoder


def search(spark, rows, k=4):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    return norm_search.search(frame, F.col("vec_id") % 2 == 0, k=k, bucket_rows=4, block_rows=2)


def scaled(rows):
    return [(i, [int(np.floor(x * 1024)) for x in v]) for i, v in rows]


def check_search(spark, rows, k=4):
    expected = brute.top(scaled(rows), lambda i: i % 2 == 0, k, lambda a, b: sum(x * y for x, y in zip(a, b)))
    assert sorted(tuple(r) for r in search(spark, rows, k).collect()) == expected


def test_large_components_take_part(spark):
    check_search(spark, [(0, [1.0, 2.0]), (1, [200_000.0, 1.0]), (2, [3.0, 1.0]), (3, [-200_000.0, 5.0]), (4, [0.5, 0.5])])


@pytest.mark.parametrize("size", [2.0**14, 2.0**20, 2.0**20.6])
def test_products_beyond_doubles_are_exact(spark, size):
    rnd = random.Random(3)
    rows = [(i, [rnd.uniform(-1, 1) * (size if i % 3 else 1.0) for _ in range(3)]) for i in range(14)]
    check_search(spark, rows, 3)


def test_a_score_that_fits_no_long_is_an_error(spark):
    # A far vector on the other side is beaten by nearer ones, so its score is never returned.
    check_search(spark, [(0, [2.0**40]), (1, [-(2.0**40)]), (3, [1.0]), (5, [2.0])], 2)
    for other in (2.0**40, -(2.0**40)):
        with pytest.raises(Exception, match="fit a long"):
            search(spark, [(0, [2.0**40]), (1, [other])], 2).collect()


def words_of(rng, letters, n):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(3, 8))) for _ in range(n))


def test_a_document_of_five_languages_keeps_all(spark):
    rng = random.Random(8)
    alphabets = {"a": "bcdfb", "b": "ghjkg", "c": "lmnpl", "d": "qrstq", "e": "vwxzv"}
    learned = [(words_of(rng, letters, 300), name) for name, letters in alphabets.items()]
    model = language.learn(spark.createDataFrame(learned, "text string, lang string"))
    mixed = " ".join(words_of(rng, letters, 80) for letters in alphabets.values())
    three = " ".join(words_of(rng, alphabets[n], k) for n, k in (("a", 80), ("b", 60), ("c", 60)))
    docs = spark.createDataFrame([(1, mixed), (2, three), (3, learned[3][0])], "doc_id long, text string")
    got = {r["doc_id"]: r["lang_shares"] for r in language.identify(docs, model, keep=["doc_id"]).collect()}
    assert set(got[1]) == set(alphabets) and all(abs(s - 0.2) < 0.05 for s in got[1].values())
    assert set(got[2]) == {"a", "b", "c"} and abs(got[2]["a"] - 0.4) < 0.05
    assert got[3] == {"d": 1.0}


def plain_shares(log_words, penalty_words):
    """The same estimate for one document, with loops."""
    languages = range(log_words.shape[1])

    def run(share, rounds):
        for _ in range(rounds):
            drawn = [[np.exp(row[k]) * share[k] for k in languages] for row in log_words]
            share = [sum(d[k] / sum(d) for d in drawn) / len(drawn) for k in languages]
        return share

    free = run([1 / len(languages)] * len(languages), language.ROUNDS)
    order = sorted(languages, key=lambda k: -free[k])
    best, fit = None, -np.inf
    for size in range(1, len(languages) + 1):
        share = [max(free[k], 1e-6) if k in order[:size] else 0.0 for k in languages]
        share = [s / sum(share) for s in share]
        if size > 1:
            share = run(share, language.SET_ROUNDS)
        value = sum(np.log(sum(np.exp(row[k]) * share[k] for k in languages)) for row in log_words)
        value -= (size - 1) * np.log(penalty_words + 1.0) / 2
        if value <= fit + 1e-9:
            break
        best, fit = share, value
    return best


def test_proportions_equal_plain_maximisation():
    rng = np.random.default_rng(2)
    counts = np.array([1, 7, 30, 2, 60])
    log_words = np.log(rng.dirichlet(np.full(5, 0.3), counts.sum()) + 1e-9)
    got = language.proportions(log_words, counts)
    at = 0
    for share, n in zip(got, counts.tolist()):
        assert np.allclose(share, plain_shares(log_words[at : at + n], n), atol=1e-9)
        at += n


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
@pytest.mark.parametrize("plain", [False, True])
def test_parts_and_numbers_give_the_tokenizers_ids(name, plain):
    path, rnd = public_tokenizers.path(name), random.Random(9)
    letters = list("abAB'sSéÉñß \t\n\r\x0b\x1c\x85\xa0²½!.,<|>_0́Σσİ漢😀µ\0") + ["'s", "'RE", "<|endoftext|>", "  ", "\n ", " a"]
    texts = ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 30))) for _ in range(1500)]
    texts += ["a b", "a\nb", "a \nb", "a\n b", "a\n\n\nb", " a", "\na", "a ", "a\n", "", None, "a\tb c", "x\n y"]
    whole = Tokenizer.from_file(path)
    whole.encode_special_tokens = plain
    own = WordEncoder(path, cached_words=300, plain=plain)
    for at in range(0, len(texts), 100):
        for text, ids in zip(texts[at : at + 100], own.encode(texts[at : at + 100])):
            assert np.frombuffer(ids, "<u4").tolist() == whole.encode(text or "", add_special_tokens=False).ids, repr(text)
