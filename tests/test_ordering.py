import hashlib

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from caresift.functions.draws import hashed, uniform
from caresift.operators import ordering as O
from caresift.operators import split as D


def test_running_sums_with_a_hot_value_match_brute_force(spark):
    rng = random.Random(3)
    rows = [("a", round(rng.random(), 3)) for _ in range(2000)] + [("b", 0.5)] * 1500 + [("b", round(rng.random(), 3)) for _ in range(500)]
    df = spark.createDataFrame(rows, "g string, v double")
    cuts = O.order_cuts(df, "v", 6)
    counted = df.groupBy("g", "v").agg(F.count("*").alias("n"))
    out = O.prefix_aggregates(O.with_range_cell(counted, "v", cuts), ["g"], "v", {"s": ("sum", "n")}, descending=True)
    for r in out.collect():
        own = [v for g, v in rows if g == r["g"]]
        assert r["s"] == sum(v >= r["v"] for v in own)
        assert r["s_before"] == sum(v > r["v"] for v in own)
        assert r["s_total"] == len(own)


@pytest.mark.parametrize("cuts", [[], [0.2, 0.5, 0.9], None])
def test_quantiles_are_exact_whatever_the_cuts(spark, cuts):
    rng = random.Random(9)
    values = [rng.random() for _ in range(301)] + [0.5] * 200
    df = spark.createDataFrame([("g", v) for v in values] + [("g", None)], "g string, v double")
    row = O.exact_quantiles(df, ["g"], "v", [0.0, 0.25, 0.5, 0.9, 1.0], list("abcde"), cuts).first()
    assert [row[c] for c in "abcde"] == pytest.approx(np.quantile(values, [0, 0.25, 0.5, 0.9, 1]).tolist())


def test_quantile_of_one_value(spark):
    df = spark.createDataFrame([(4.0,)], "v double")
    assert O.exact_quantiles(df, [], "v", [0.5], ["m"]).first()["m"] == 4.0


def test_row_index_is_dense_and_ordered(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("k")).repartition(5)
    rows = O.with_row_index(df, [F.desc("k")], "i", start=1).orderBy("i").collect()
    assert [r["i"] for r in rows] == list(range(1, 5001))
    assert [r["k"] for r in rows] == sorted((r["k"] for r in rows), reverse=True)


def test_rank_cuts_refine_large_cells(spark):
    df = spark.range(3000).select(
        F.col("id").cast("string").alias("k"), F.when(F.col("id") < 2000, "hot").otherwise("cold").alias("c")
    ).withColumn("d", hashed(1, F.col("k")))
    targets = {"x": F.floor(F.col("n") * 0.3), "zero": F.lit(0), "all": F.col("n")}
    expected = {}
    for r in df.groupBy("c").agg(F.sort_array(F.collect_list("d")).alias("d")).collect():
        n = len(r["d"])
        expected[r["c"]] = (r["d"][int(n * 0.3) - 1], "", r["d"][-1])
    for step, sortable in ((3, 10**6), (1, 5), (2, 1)):
        got = {r["c"]: (r["x"], r["zero"], r["all"]) for r in O.rank_cuts(df, "c", "d", targets, step, sortable).collect()}
        assert got == expected


def test_positions_inside_a_hot_score(spark):
    rows = [(str(i), 0.5 if i % 3 else i / 1000) for i in range(900)]
    df = spark.createDataFrame(rows, "k string, p double")
    whole = [r["k"] for r in df.orderBy("p", hashed(F.col("k")), "k").collect()]
    wanted = [0, 10, 300, 301, 555, 899]
    got = {r["position"]: r["k"] for r in O.positions_by_score(df, "p", "k", wanted).collect()}
    assert got == {p: whole[p] for p in wanted}


def test_draws_do_not_depend_on_partitions(spark):
    a = spark.range(100).select("id", uniform(7, F.col("id")).alias("u")).repartition(3).orderBy("id").collect()
    b = spark.range(100).repartition(9).select("id", uniform(7, F.col("id")).alias("u")).orderBy("id").collect()
    assert a == b
    assert all(0 <= r["u"] < 1 for r in a)


# --- splits ------------------------------------------------------------------------


def people(spark, n, share=0.9):
    return spark.range(n).select(
        F.col("id").cast("string").alias("k"), (F.col("id") < n * share).cast("int").alias("y")
    )


def test_split_sizes_of_three_thousand_rows(spark):
    out = D.split_60_20_20(people(spark, 3000, 0.5), "k", "y")
    sizes = {r["split"]: r["count"] for r in out.groupBy("split").count().collect()}
    assert sizes == {"train": 1800, "val": 600, "test": 600}


@pytest.mark.parametrize("n", [1, 7, 103])
def test_split_keeps_class_shares_within_one_row(spark, n):
    out = D.stratified_split(people(spark, n), "k", "y", 0.15, 0.15)
    assert out.count() == n
    for r in out.groupBy("y").agg(F.count("*").alias("n"), F.count_if(F.col("split") == "train").alias("t")).collect():
        assert abs(r["t"] - 0.7 * r["n"]) <= 1


def test_split_does_not_depend_on_partitions(spark):
    df = people(spark, 500)
    a = D.split_test_first(df.repartition(2), "k", "y").orderBy("k").collect()
    b = D.split_test_first(df.repartition(7), "k", "y").orderBy("k").collect()
    assert a == b


@pytest.mark.parametrize("val,test", [(0.5, 0.5), (0.9, 0.3), (-0.1, 0.2)])
def test_invalid_fractions(spark, val, test):
    with pytest.raises(ValueError):
        D.stratified_split(people(spark, 10), "k", "y", val, test)


def test_published_class_weights(spark):
    df = spark.range(767).select((F.col("id") >= 375).cast("int").alias("y"))
    w = {r["label"]: r["weight"] for r in D.binary_class_weights(df, "y").collect()}
    assert w[0] == pytest.approx(1.022667, abs=1e-6) and w[1] == pytest.approx(0.978316, abs=1e-6)
    only = D.binary_class_weights(df.filter("y = 1"), "y").collect()
    assert {r["label"]: r["weight"] for r in only}[0] == 392 / 2.0


def test_quantile_sample_of_a_small_table(spark):
    df = spark.createDataFrame([("a", 0.1), ("b", 0.2), ("c", 0.3)], "k string, p double")
    rows = D.quantile_sample(df, "p", "k", 8).orderBy("case_id").collect()
    assert [r["k"] for r in rows] == ["a", "b", "c"]
    assert [r["case_id"] for r in rows] == [1, 2, 3]


def test_null_groups_are_groups(spark):
    rows = [("a", 1.0, 1), (None, 1.0, 2), (None, 2.0, 3), ("a", 2.0, 4)]
    df = O.with_range_cell(spark.createDataFrame(rows, "g string, v double, n int"), "v", [1.5])
    got = {(r["g"], r["v"]): (r["upto"], r["upto_total"]) for r in O.prefix_aggregates(df, ["g"], "v", {"upto": ("sum", "n")}).collect()}
    assert got == {("a", 1.0): (1, 5), ("a", 2.0): (5, 5), (None, 1.0): (2, 5), (None, 2.0): (5, 5)}
    quantiles = O.exact_quantiles(spark.createDataFrame(rows, "g string, v double, n int"), ["g"], "v", [0.5], ["m"])
    assert {r["g"]: r["m"] for r in quantiles.collect()} == {"a": 1.5, None: 1.5}


def test_one_tied_score_of_many_rows(spark, monkeypatch):
    monkeypatch.setattr(O, "TIED_ROWS", 1)
    rows = [(f"k{i:04d}", 0.5 if i % 10 else 0.9) for i in range(4000)]
    got = {r["position"]: r["k"] for r in O.positions_by_score(spark.createDataFrame(rows, "k string, p double"), "p", "k", [0, 1777, 3599, 3999]).collect()}
    order = [k for _, _, k in sorted((p, hashlib.md5(k.encode()).hexdigest(), k) for k, p in rows)]
    assert got == {p: order[p] for p in (0, 1777, 3599, 3999)}


@pytest.mark.parametrize("sorted_rows", [100_000, 10])
def test_rows_at_positions_of_any_order(spark, monkeypatch, sorted_rows):
    monkeypatch.setattr(O, "CELL_SORTED", sorted_rows)
    draw = random.Random(3)
    rows = [(draw.choice([None, "", "a", "ab", "abc", "é", "z", "zz"]), draw.choice([None, -5, 0, 7, 1 << 40]), i) for i in range(300)]
    df = spark.createDataFrame(rows, "s string, n long, i int").repartition(7)
    want = sorted(rows, key=lambda r: (r[0] is not None, (r[0] or "").encode(), r[1] is not None, r[1] or 0, r[2]))
    for start, stop in ((0, 7), (100, 140), (290, 400), (300, 310), (0, 300)):
        got = sorted(O.rows_at(df, ["s", "n", "i"], start, stop, "at", 300).collect(), key=lambda r: r["at"])
        assert [r["at"] for r in got] == list(range(start, min(stop, 300)))
        assert [(r["s"], r["n"], r["i"]) for r in got] == want[start:stop]
    tied = sorted(O.rows_at(df, ["s"], 50, 90, "at", 300).collect(), key=lambda r: r["at"])
    assert [r["s"] for r in tied] == [r[0] for r in want[50:90]]
    again = O.rows_at(df.repartition(3), ["s"], 50, 90, "at", 300).collect()
    assert sorted(map(tuple, again), key=repr) == sorted(map(tuple, tied), key=repr)
    same = spark.createDataFrame([(1,)] * 200, "k int")
    assert sorted(r["at"] for r in O.rows_at(same, ["k"], 20, 25, "at", 200).collect()) == list(range(20, 25))
    other = spark.createDataFrame([(float(k),) for k in range(20)], "x double")
    assert [r["x"] for r in O.rows_at(other, ["x"], 3, 5, "at", 20).orderBy("at").collect()] == [3.0, 4.0]
