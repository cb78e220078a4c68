"""Token alignment, benchmark windows and plane centroids against plain versions."""

import hashlib
import random

import brute
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from checks.compare import compare, connection
from riskloom.llm import alignment, centroids, decontamination, queries

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")

TEXTS = [
    "The quick brown fox, it's 2024!", "the quick brown fox, it's 2024!", None, "", " ", "\n", "a", "a b",
    "two  spaces\n\n and\ttabs \r\n end \r", "né ñandú Straße 漢字 😀", "of U+2581 ▁ inside", "▁", "x\x00y\x1cz",
    "<|endoftext|> is plain, so are <s> and </s>", "trailing space ", "the the the the", "word " * 300,
    "the quick brown fox, it's 2024!", "); \r } ();\r\n {\r", "\xa0no break\xa0space 　wide",
]


def documents(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(3)


def plain_alignments(rows):
    import sentencepiece
    from tokenizers import Tokenizer

    first = Tokenizer.from_file(A)
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=B)
    return brute.alignments(
        rows, lambda t: (first.encode(" " + t, add_special_tokens=False).ids, second.encode(t)),
        alignment.first_bytes(first), alignment.second_bytes(second),
    )


def expected_rows(rows):
    return sorted(
        (
            (key, n_a, n_b, len(groups), len(links), best, total, hashlib.sha256(";".join(groups).encode()).hexdigest() if n_a else "")
            for key, n_a, n_b, groups, best, total, links in plain_alignments(rows)
        ),
        key=repr,
    )


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.mark.parametrize("most_shared", [0, 20, 1 << 19])
def test_alignment_equals_whole_texts(spark, most_shared):
    rows = [*enumerate(TEXTS), (None, TEXTS[0]), (0, TEXTS[0])]
    got = alignment.aligned_documents(documents(spark, rows), A, B, most_shared)
    assert sorted((tuple(r) for r in got.select(COLUMNS).collect()), key=repr) == expected_rows(rows)


def test_alignment_of_random_texts_with_a_small_cache():
    rnd = random.Random(11)
    letters = list("abcdeé '▁\t\n\r\xa0.,;(){}0 12 漢😀") + [" the", "ing", "  ", "\r\n", "<s>", "ß"]
    rows = [(i, "".join(rnd.choice(letters) for _ in range(rnd.randint(0, 60)))) for i in range(400)]
    own = alignment.Aligner(A, B, cached_words=50)
    got = [d for at in range(0, 400, 40) for d in own.align([t for _, t in rows[at : at + 40]])]
    for d, (_, n_a, n_b, groups, _, _, links) in zip(got, plain_alignments(rows)):
        assert d[:4] == (n_a, n_b, len(groups), len(links))
        assert (d[4] or "") == ";".join(groups)
        pairs = {}
        for a, b in links:
            pairs[a << alignment.SECOND_BITS | b] = pairs.get(a << alignment.SECOND_BITS | b, 0) + 1
        assert dict(zip(d[5].tolist(), d[6].tolist())) == pairs


def test_identity_pairs_stay_out_of_the_pair_table(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)]
    aligned = alignment.align(documents(spark, rows), A, B, with_groups=True)
    identity, counts = alignment.pair_counts(aligned, A, B)
    held = {}
    for *_, links in plain_alignments(rows):
        for pair in set(links):
            held[pair] = held.get(pair, 0) + 1
    same = alignment.aligner(A, B).same
    own = {p: n for p, n in held.items() if same[p[0]] == p[1]}
    assert {(a, int(same[a])): int(identity[a]) for a in identity.nonzero()[0].tolist()} == own
    got = {(r["code"] >> alignment.SECOND_BITS, r["code"] & 0xFFFFF): r["n"] for r in counts.collect()}
    assert got == {p: n for p, n in held.items() if p not in own}
    table = {(r["a"], r["b"]): r["n"] for r in alignment.vocabulary_map(identity, counts, A, B).collect()}
    best = {}
    for (a, _), n in held.items():
        best[a] = max(best.get(a, 0), n)
    assert table == {p: n for p, n in held.items() if n == best[p[0]]}
    groups = {r["doc_id"]: r["groups"] for r in aligned.collect()}
    assert groups[0] == ";".join(plain_alignments(rows)[0][3])


def test_alignment_of_no_rows_and_clashing_names(spark):
    none = alignment.aligned_documents(spark.createDataFrame([], "doc_id long, text string"), A, B)
    assert none.collect() == [] and none.columns[0] == "doc_id"
    more = spark.createDataFrame([(1, "a b", 5, "x", 7)], "doc_id long, text string, row long, links string, n long")
    got = alignment.aligned_documents(more, A, B).select(COLUMNS).collect()
    assert [tuple(r) for r in got] == expected_rows([(1, "a b")])


def test_alignment_query_as_registered(spark, sf_dir):
    got = queries.QUERIES["op11_token_alignment"](spark, sf_dir)
    assert got.columns == COLUMNS
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    # Counts span all texts, so all are aligned plainly, without their pairs of tokens being tried.
    first = alignment.Aligner(A, B)
    done = first.align([t for _, t in rows])
    held, best = {}, {}
    for d in done:
        for code in d[5].tolist():
            held[code] = held.get(code, 0) + 1
    for code, n in held.items():
        best[code >> alignment.SECOND_BITS] = max(best.get(code >> alignment.SECOND_BITS, 0), n)
    expected = [
        (
            key, *d[:4], sum(t for c, t in zip(d[5].tolist(), d[6].tolist()) if held[c] == best[c >> alignment.SECOND_BITS]),
            sum(held[c] * t for c, t in zip(d[5].tolist(), d[6].tolist())),
            hashlib.sha256(d[4].encode()).hexdigest() if d[4] else "",
        )
        for (key, _), d in zip(rows, done)
    ]
    assert sorted(tuple(r) for r in got.collect()) == sorted(expected)
    plain = plain_alignments(rows[:25])
    assert [(n_a, n_b, ";".join(groups)) for _, n_a, n_b, groups, *_ in plain] == [(d[0], d[1], d[4] or "") for d in done[:25]]


# ---- benchmark windows --------------------------------------------------------

ITEMS = [
    (1, "alpha beta gamma delta epsilon"), (2, "Gamma DELTA epsilon zeta"), (3, "the"), (4, ""), (5, None),
    (6, "été Été naïve"), (2, "one two"), (None, "without an id"), (7, "--- !!!"), (10, "alpha beta gamma delta epsilon"),
]
DOCS = [
    (1, "ALPHA, beta; gamma (delta) epsilon zeta eta"), (2, "nothing of that kind"), (3, None), (4, ""), (5, "..."),
    (6, "the end of the the"), (7, "été Été naïve"), (8, "Été été naïve"), (9, "one two two one two"),
    (1, "ALPHA, beta; gamma (delta) epsilon zeta eta"), (None, "alpha beta gamma delta"), (10, "without\x00an   id"),
    (11, "beta gamma delta epsilon " * 200), (12, "alpha"), (13, "one"), (14, "\U0001f600one two"),
]


@pytest.mark.parametrize("width,broadcast_bytes", [(3, 64 << 20), (3, 300), (2, 1000), (10, 64 << 20), (1, 64 << 20)])
def test_windows_equal_plain_search(spark, width, broadcast_bytes):
    docs = documents(spark, DOCS)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = decontamination.scan(docs, items, width, broadcast_bytes).collect()
    mine = [
        (r["doc_id"], r["n_words"], sorted(k for s in r["spans"] for k in range(s["from"], s["to"])), r["items"]) for r in got
    ]
    assert sorted(mine, key=repr) == sorted(brute.benchmark_hits(DOCS, ITEMS, width), key=repr)
    assert all(r["n_hit"] == sum(s["to"] - s["from"] for s in r["spans"]) for r in got)


def test_removal_of_spans_and_documents(spark):
    docs = documents(spark, DOCS).withColumns({"_spans": F.lit("own"), "n_hit": F.lit(3)})
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    hit = {i: (words, spans) for i, (_, words, spans, _) in enumerate(brute.benchmark_hits(DOCS, ITEMS, 3))}
    left = decontamination.remove(docs, items, "documents", width=3)
    assert left.columns == docs.columns
    assert sorted(((r["doc_id"], r["text"]) for r in left.collect()), key=repr) == sorted(
        (d for i, d in enumerate(DOCS) if not hit[i][1]), key=repr
    )
    cut = decontamination.remove(docs, items, "spans", width=3)
    assert cut.columns == docs.columns and cut.count() == len(DOCS)
    texts = {}
    for r in cut.collect():
        texts.setdefault(r["doc_id"], []).append(r["text"])
    assert texts[1] == [" eta"] * 2 and texts[2] == ["nothing of that kind"] and texts[3] == [None]
    assert texts[6] == [" end of "] and texts[7] == [""] and texts[10] == [""] and texts[None] == [""]
    assert texts[9] == [" two "] and texts[12] == ["alpha"] and texts[5] == ["..."]
    clean = decontamination.scan(cut, items, 3).filter("n_hit > 0").count()
    assert clean == 0
    with pytest.raises(ValueError):
        decontamination.remove(docs, items, "lines")


def test_windows_without_documents_or_items(spark):
    no_docs, no_items = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([], "item_id long, text string")
    docs, items = documents(spark, DOCS), spark.createDataFrame(ITEMS, "item_id long, text string")
    assert decontamination.scan(no_docs, items).collect() == []
    got = decontamination.scan(docs, no_items).collect()
    assert len(got) == len(DOCS) and all(r["n_hit"] == 0 and r["items"] == [] for r in got)
    assert decontamination.remove(docs, no_items).count() == len(DOCS)


def test_window_scan_has_no_python_and_one_exchange(spark, sf_dir):
    found = queries.QUERIES["op12_benchmark_windows"](spark, sf_dir)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "BroadcastHashJoin" in plan
    assert plan.count("Exchange hashpartitioning") == 1


# ---- centroids ----------------------------------------------------------------

def vectors_of(rnd, n, low=-1.0, high=1.0):
    return [[rnd.uniform(low, high) for _ in range(64)] for _ in range(n)]


def check_clusters(spark, rows, k, rounds, scale=256, seed="2", kind="double"):
    frame = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>").repartition(3)
    assigned, table = centroids.cluster(frame, k, rounds, scale, seed)
    expected, spelled = brute.lloyd(rows, k, rounds, scale, seed)
    assert sorted((tuple(r) for r in assigned.collect()), key=repr) == sorted(expected, key=repr)
    own = {r["cluster"]: r for r in table.collect()}
    assert {i: r["centroid"] for i, r in own.items()} == {i: ",".join(map(str, c)) for i, c in enumerate(spelled)}
    for i, r in own.items():
        assert r["cluster_inertia"] == sum(d for _, c, d in expected if c == i)
        assert r["n"] == sum(c == i for _, c, _ in expected)
        assert r["inertia"] == sum(d for _, _, d in expected)
        assert r["centroid_sha256"] == hashlib.sha256(r["centroid"].encode()).hexdigest()


def test_centroids_equal_plain_rounds(spark):
    rnd = random.Random(4)
    rows = list(enumerate(vectors_of(rnd, 120)))
    rows += [(500 + i, rows[7][1]) for i in range(60)] + [(7, rows[8][1])]
    check_clusters(spark, rows, 9, 5)


def test_vectors_that_take_no_part_and_few_vectors(spark):
    rnd = random.Random(5)
    good = vectors_of(rnd, 4)
    bad = [None, [], [1.0] * 63, [1.0] * 65, [None, *[0.0] * 63], [float("nan"), *[0.0] * 63], [float("inf"), *[0.0] * 63]]
    rows = [*enumerate(good), *((100 + i, v) for i, v in enumerate(bad)), (900, [0.0] * 64), (901, [-0.0] * 64)]
    check_clusters(spark, rows, 40, 3)
    check_clusters(spark, [(1, bad[0])], 40, 2)
    check_clusters(spark, [], 40, 2)


def test_large_components_are_exact(spark):
    rnd = random.Random(6)
    wide = vectors_of(rnd, 12, -(2.0**16), 2.0**16)
    check_clusters(spark, list(enumerate(wide)), 3, 3)
    far = [[2.0**90] * 64] * 3 + [[-(2.0**90)] * 64] * 2 + [[1e300, *[0.5] * 63]] * 2
    check_clusters(spark, list(enumerate(far)), 8, 3)
    apart = spark.createDataFrame([(1, [2.0**90] * 64), (2, [0.0] * 64)], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="fit a long"):
        centroids.cluster(apart, 1, 0)[0].collect()


def test_rows_without_id_are_clustered(spark):
    rnd = random.Random(7)
    rows = [(None, v) for v in vectors_of(rnd, 3)] + list(enumerate(vectors_of(rnd, 5)))
    check_clusters(spark, rows, 4, 2)


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_registered_queries_equal_sql(spark, sf_dir, name):
    assert compare(queries.QUERIES[name](spark, sf_dir), connection(sf_dir), queries.SQL[name]) == ""


def test_centroid_query_equals_plain_rounds(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").collect()]
    expected, spelled = brute.lloyd(rows, 40, 5, 256, "2")
    got = queries.QUERIES["op13_plane_centroids"](spark, sf_dir)
    shas = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in spelled]
    assert sorted(tuple(r) for r in got.select("vec_id", "cluster", "distance", "centroid_sha256").collect()) == sorted(
        (key, c, d, shas[c]) for key, c, d in expected
    )
