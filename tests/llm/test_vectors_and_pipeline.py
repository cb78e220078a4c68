"""Vector searches against all pairs, the registered queries, and the pipeline."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from riskloom.llm import graph_search, norm_search, packing


def vectors(spark, n=400, dim=8, seed=1):
    rng = np.random.default_rng(seed)
    rows = [(i, rng.normal(size=dim).astype(np.float32).astype(float).tolist()) for i in range(n)]
    rows += [(1000 + i, rows[17][1]) for i in range(30)]  # copies of one vector
    rows += [(20, rows[20][1]), (2000, [0.5] * 3), (2020, [0.25] * 3)]
    odd = [(3000, None), (3001, []), (3002, [math.nan] * dim), (3003, [math.inf] + [0.0] * (dim - 1)),
           (3004, [None] + [1.0] * (dim - 1)), (None, [1.0] * dim)]
    zero = (3020, [0.0] * dim)
    df = spark.createDataFrame([*rows, *odd, zero], "vec_id long, embedding array<float>")
    return df.withColumns({"_v": F.lit(1), "rank": F.lit("r"), "_class": F.lit(2)}).repartition(4), rows, zero


def test_exact_search_against_all_pairs(spark):
    df, rows, zero = vectors(spark)
    asked = lambda i: i % 20 == 0
    got = norm_search.search(df, F.col("vec_id") % 20 == 0, k=10, bucket_rows=32, block_rows=8)
    scaled = [(i, [math.floor(1024 * x) for x in v]) for i, v in [*rows, zero]]
    want = brute.top(scaled, asked, 10, lambda v, w: sum(a * b for a, b in zip(v, w)))
    assert sorted(map(tuple, got.collect())) == want
    assert norm_search.search(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0
    assert norm_search.search(df, F.lit(False)).count() == 0


def test_pruning_keeps_every_partner():
    rng = np.random.default_rng(2)
    for _ in range(200):
        v = rng.integers(-900, 900, (50, 6))
        v = v[np.argsort(-np.sqrt((v * v).sum(1)), kind="stable")]
        q = rng.integers(-900, 900, 6)
        lengths = np.sqrt((v.astype(float) ** 2).sum(1))
        scores = v @ q
        least = float(np.sort(scores)[rng.integers(0, 50)])
        rows = norm_search.candidates(q, float(np.sqrt(q @ q)), least, v, lengths, v / lengths[:, None])
        kept = set(range(50)) if rows is None else set(rows.tolist())
        assert set(np.flatnonzero(scores >= least).tolist()) <= kept


def test_large_components_stay_exact():
    big = np.array([[(1 << 26) - 1, 3, -(1 << 26)]])
    assert norm_search.products(big, big).tolist() == [[int((big.astype(object) ** 2).sum())]]


def test_graph_search_recall_and_scores(spark):
    df, rows, _ = vectors(spark, n=600, dim=16)
    got = sorted(map(tuple, graph_search.search(df, F.col("vec_id") % 20 == 0, k=20, shards=3).collect()))
    want = brute.top(rows, lambda i: i % 20 == 0, 20, lambda v, w: float(np.dot(v, w)))
    found = {(q, i): s for q, _, i, s in got}
    hits = [(q, i) for q, _, i, s in want if (q, i) in found]
    assert len(hits) / len(want) >= 0.95
    exact = dict(((q, i), s) for q, _, i, s in want)
    assert all(abs(found[h] - exact[h]) < 1e-9 for h in hits)
    assert {q for q, *_ in got} == {q for q, *_ in want}
    assert graph_search.search(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_every_vector_is_in_the_index(spark):
    df, rows, _ = vectors(spark)
    plain = df.select(F.col("vec_id").alias("_id"), F.col("embedding").cast("array<double>").alias("_v")).filter(
        F.col("_id").isin([i for i, _ in rows])
    )
    index, _ = graph_search.index(plain, members=100, shards=2)
    held = [i for r in index.select("_members").collect() for i in r[0]]
    assert sorted(set(held)) == sorted({i for i, _ in rows})


NAMES = ["op1", "op2", "op3", "op4", "op5", "op6", "op7", "op8", "op9", "op10"]


def test_each_operator_has_one_query():
    own = [n for n in queries() if n.startswith("op") and n.split("_")[0] in NAMES]
    assert sorted(n.split("_")[0] for n in own) == sorted(NAMES) and "pipeline" in queries()
    assert set(oracle_sql()) <= set(queries())


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(corpus_pipeline.COLUMNS)
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        path = corpus_pipeline.scratch_path(spark, f"test-{name}")
        stage(spark, out[-1], sf_dir).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def test_stages_keep_columns_and_take_effect(stages):
    docs = stages[0]
    for before, after in zip(stages[:-1], stages[1:-1]):
        assert after.columns == corpus_pipeline.COLUMNS and dict(after.dtypes) == dict(docs.dtypes)
        assert after.join(before, "doc_id", "left_anti").count() == 0
    lines = {r["doc_id"]: r["text"] for r in stages[2].collect()}
    ordered = sorted((r["doc_id"], r["text"]) for r in stages[1].collect())
    cut = brute.without_later_lines(ordered, corpus_pipeline.line_runs.MIN_WORDS)
    assert lines == {i: t for (i, old), t in zip(ordered, cut) if t.strip(" ") or t == old}
    groups = brute.jaccard_components(sorted(lines.items()))
    assert {r["doc_id"] for r in stages[3].collect()} == {i for i, _, least in groups if i == least}


def test_packed_ids_are_those_of_the_mix(stages):
    mixed, packed = stages[4], stages[5]
    tokens = packed.groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("all"))
    assert tokens.filter("n <> all").count() == 0
    assert tokens.count() == mixed.count() > 0


def test_run_equals_its_stages(spark, sf_dir, stages):
    got = corpus_pipeline.run(spark, sf_dir)
    assert got.columns == stages[-1].columns
    total = lambda df: df.agg(F.sum("length"), F.countDistinct("doc_id")).first()
    assert total(got) == total(stages[-1])


def test_pipeline_stages_take_odd_rows(spark, sf_dir):
    odd = [(1, None, None, None, None), (None, "a few plain words", "en", "s1", 3), (2, "", "en", "s1", 0),
           (3, "word " * 30_000, "en", None, 5), (3, "word " * 30_000, "en", None, 5), (4, "ein text. " * 30, "de", "s2", 1)]
    docs = spark.createDataFrame(odd, "doc_id long, text string, lang string, source string, n_chars long")
    for df in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            df = stage(spark, df, sf_dir)
            rows = df.collect()
            df = spark.createDataFrame(rows, df.schema)
        assert packing.PIECES.split()[0] in df.columns


def test_one_row_of_each_group_stays(spark, sf_dir):
    a, b, c, d = (" ".join(f"{name}{k}" for k in range(40)) for name in "abcd")
    rows = [(1, a), (1, a), (1, b), (0, b), (None, a), (None, c), (None, c), (5, c + " end"), (None, d), (None, d + " end")]
    rows = [(i, t, "en", "s1", len(t)) for i, t in rows]
    docs = spark.createDataFrame(rows * 2, "doc_id long, text string, lang string, source string, n_chars long")
    got = [(r["doc_id"], r["text"]) for r in corpus_pipeline.one_of_each(spark, docs.repartition(4), sf_dir).collect()]
    known = sorted(x for x in got if x[0] is not None)
    assert known == [(0, b), (1, a), (5, c + " end")]
    assert len(got) == 4 and all(t in (d, d + " end") for i, t in got if i is None)


def test_the_found_language_is_what_the_mix_weighs(spark, sf_dir):
    texts = {"en": "the quick brown foxes were running over those lazy dogs ", "de": "der schnelle Fuchs springt über die faulen Hunde und "}
    rows = [(2 * i + k, texts[lang] * 5 + f"{lang} {i}", lang, "s1", 9) for i in range(20) for k, lang in enumerate(texts)]
    rows += [(100, texts["de"] * 6, None, "s1", 9), (101, texts["en"] * 9 + texts["de"], "de", "s1", 9), (102, "12 + 3", "en", "s1", 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    found = corpus_pipeline.known_language(spark, docs.repartition(3), sf_dir)
    assert found.columns == docs.columns and dict(found.dtypes) == dict(docs.dtypes)
    kept = {r["doc_id"]: r for r in found.collect()}
    assert {i: r["lang"] for i, r in kept.items()} == {i: lang for i, _, lang, *_ in rows[:40]} | {100: "de", 101: "en"}
    assert all(kept[i]["text"] == text for i, text, *_ in rows if i in kept)
    leaves = corpus_pipeline.mixing.plan_mix(found, corpus_pipeline.domain(), corpus_pipeline.WEIGHTS, max_epochs=1)[1]
    assert {r["_lang"] for r in leaves.collect()} == {"en", "de"}
