"""Exact KS p-values, the vocabulary as a table, streams that never overwrite."""

import itertools

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from riskloom.operators import drift, encoding, vocabulary
from riskloom.session import settle


def gaps_of_all_orders(n, m):
    """The largest gap, times ``n m``, of every order of the pooled values."""
    out = []
    for places in itertools.combinations(range(n + m), n):
        i = largest = 0
        for k in range(n + m):
            i += k in places
            largest = max(largest, abs(i * m - (k + 1 - i) * n))
        out.append(largest)
    return np.array(out)


@pytest.mark.parametrize("n,m", [(1, 1), (1, 8), (3, 5), (6, 6), (8, 8), (8, 7)])
def test_lattice_p_value_equals_enumeration(n, m):
    gaps = gaps_of_all_orders(n, m)
    for gap in {0, *gaps.tolist(), n * m + 1}:
        assert np.isclose(drift.lattice_p_value(n, m, gap), (gaps >= gap).mean(), atol=1e-12)


def test_lattice_p_value_keeps_small_chances():
    assert np.isclose(drift.lattice_p_value(30, 30, 900), 2 / 118264581564861424, rtol=1e-9, atol=0)
    # Large samples come near to the limiting value.
    limit = sum(2 * (-1) ** (k - 1) * np.exp(-2 * k * k * 1.2**2) for k in range(1, 50))
    assert abs(drift.lattice_p_value(2000, 2000, round(1.2 * np.sqrt(2 / 2000) * 2000**2)) - limit) < 0.01


def test_p_value_is_chosen_by_sample_size(spark):
    pairs = spark.createDataFrame(
        [("a", 1.0, 3, 0), ("a", 2.0, 0, 4), ("b", 1.0, 2, 2), ("b", 2.0, 1, 1)],
        "feature string, value double, n_ref bigint, n_cur bigint",
    )
    exact = {r["feature"]: r["ks_p_value"] for r in drift.ks_from_counts(pairs).collect()}
    assert np.isclose(exact["a"], 2 / 35) and exact["b"] == 1.0
    limiting = {r["feature"]: r["ks_p_value"] for r in drift.ks_from_counts(pairs, exact_rows=3).collect()}
    assert limiting["a"] != exact["a"] and limiting["b"] == 1.0


@pytest.fixture(scope="module")
def rows(spark):
    data = [
        (1, 1.0, "b", "x"), (2, None, "a", None), (3, 4.0, "b", "y"), (4, float("nan"), None, "it's"),
        (5, 2.0, "c", "x"), (6, 3.0, "", "ü"),
    ]
    return settle(spark.createDataFrame(data, "id int, n double, c string, d string"))


def test_table_encoding_equals_the_pipeline(rows):
    train = rows.filter("id < 6")
    plain = encoding.TabularEncoder(["n"], ["c", "d"]).fit(train)
    table = vocabulary.fit(train, ["n"], ["c", "d"])
    names = [r["name"] for r in table.names.orderBy("idx").collect()]
    assert names == encoding.feature_names(plain)
    want = {r["id"]: r["features"] for r in encoding.encode(plain, rows, ["id"]).collect()}
    got = vocabulary.encode(table, rows, ["id"])
    assert got.schema["features"].dataType.typeName() == "vectorudt"
    for r in got.collect():
        assert np.allclose(r["features"].toArray(), want[r["id"]].toArray())
    # MLlib functions take the column as it is.
    assert got.select(F.size(vector_to_array("features")).alias("n")).distinct().collect()[0]["n"] == len(names)
    long = {(r["id"], r["feature"]) for r in vocabulary.long_entries(table, rows, "id").collect()}
    assert (6, "cat__c_") not in long and (4, "cat__d_it's") in long and (2, "cat__d_x") in long


def test_table_encoding_of_empty_columns_and_no_rows(spark, rows):
    table = vocabulary.fit(rows.withColumn("d", F.lit(None).cast("string")), [], ["d", "c"])
    assert [r["name"] for r in table.names.orderBy("idx").collect()] == ["cat__c_", "cat__c_a", "cat__c_b", "cat__c_c"]
    assert vocabulary.encode(table, rows.limit(0), ["id"]).count() == 0
    none = vocabulary.fit(rows.limit(0), ["n"], ["c"])
    assert [tuple(r) for r in none.names.collect()] == [(0, "num__n")]
    assert all(len(r["features"]) == 1 for r in vocabulary.encode(none, rows).collect())


def test_many_levels_are_numbered_without_a_list(spark):
    levels = spark.range(20_000).select((F.col("id") % 5_000).cast("string").alias("c"), F.col("id").alias("k"))
    table = vocabulary.fit(levels, [], ["c"])
    assert table.size == 5_000
    slots = table.levels.orderBy("slot").collect()
    assert [r["slot"] for r in slots] == list(range(5_000)) and [r["value"] for r in slots] == sorted(map(str, range(5_000)))
    encoded = vocabulary.entries(table, levels, ["k"])
    assert encoded.filter(F.size("vector.indices") == 1).count() == 20_000
