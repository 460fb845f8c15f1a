from decimal import Decimal

import pytest
from helpers import d, rows
from pyspark.sql import functions as F

from tidemark.operators import quality
from tidemark.operators.hot_keys import copied, hot_keys, join_unique, salted
from tidemark.plans import quality_reports


def test_violations(spark):
    df = spark.createDataFrame([(1, None), (2, 5), (None, -1)], "a int, b int")
    checks = {**quality.null_checks(["a", "b"]), "b_is_negative": F.col("b") < 0}
    assert rows(quality.violations(df, "t", checks)) == [
        ("a_is_null", "t", 3, 1),
        ("b_is_negative", "t", 3, 1),
        ("b_is_null", "t", 3, 1),
    ]


def test_duplicates_and_keys(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, 2), (3, 4), (3, 4), (3, 4)], "a int, b int")
    assert rows(quality.duplicate_rows(df, "t")) == [("t", 6, 3, 2)]
    assert [tuple(r) for r in quality.counts(df, ["a"]).collect()] == [(1, 3), (3, 3)]
    assert rows(quality.repeated(df, ["a", "b"])) == [(1, None, 2), (3, 4, 3)]
    assert rows(quality.key_uniqueness(df, "t", ["a"])) == [("t", "a", 2, 2)]
    assert rows(quality.duplicate_rows(df.where("false"), "t")) == [("t", 0, 0, 0)]


def test_frequencies_and_ranges(spark):
    df = spark.createDataFrame([("x", 1, d("2024-01-01")), ("x", None, d("2023-01-01"))], "s string, n int, day date")
    assert rows(quality.frequencies(df, "t", ["s", "n"])) == [
        ("t", "n", "1", 1),
        ("t", "n", None, 1),
        ("t", "s", "x", 2),
    ]
    out = quality.ranges(df, "t", days=["day"], amounts=["n"])
    assert rows(out, "column_name", "min_date", "max_date", "min_amount", "max_timestamp") == [
        ("day", d("2023-01-01"), d("2024-01-01"), None, None),
        ("n", None, None, Decimal("1.00"), None),
    ]


def test_orphans(spark):
    child = spark.createDataFrame([(1,), (1,), (2,), (9,), (9,), (None,)], "k int")
    parent = spark.createDataFrame([(1,), (2,), (2,), (None,)], "k int")
    none = child.where("false")
    found = quality.orphans({"c": child, "d": none, "e": parent}, parent, "p", "k")
    assert rows(found) == [("c", "p", "k", 5, 2), ("d", "p", "k", 0, 0), ("e", "p", "k", 3, 0)]


def test_ids_as_sets_of_bits(spark):
    ids = [0, 1, 63, 64, -1, -64, -65, 2**62, -(2**63), 2**63 - 1, 5, 5, None]
    parent = spark.createDataFrame([(i,) for i in ids], "k bigint")
    child = spark.createDataFrame([(i,) for i in [*ids, 2, 62, 65, -2, -63, -66, 2**62 + 1, 10**9]], "k bigint")
    assert rows(quality.orphans({"c": child}, parent, "p", "k")) == [("c", "p", "k", 20, 8)]
    assert quality.known_ids(spark.range(6400).withColumnRenamed("id", "k"), "k").count() == 100
    assert rows(quality.orphans({"c": child}, parent.where("false"), "p", "k")) == [("c", "p", "k", 20, 20)]


def test_a_hot_key_has_many_rows(spark, monkeypatch):
    monkeypatch.undo()
    with pytest.raises(ValueError, match="at least"):
        hot_keys(spark.range(3), ["id"], 10)


def test_rows_that_share_a_hash_are_compared_as_they_are(spark, monkeypatch):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "a"), (3, None), (3, None)], "k int, v string")
    monkeypatch.setattr(quality.F, "xxhash64", lambda *columns: quality.F.lit(7))
    assert rows(quality.duplicate_rows(df, "t")) == [("t", 5, 3, 2)]


def test_hot_keys(spark):
    df = spark.createDataFrame([(k, i) for i, k in enumerate([1] * 50 + [None] * 20 + list(range(30)))], "k int, i int")
    assert rows(hot_keys(df, ["k"], 19)) == [(1, 3), (None, 2)] and rows(hot_keys(df, ["k"], 51)) == []
    right = spark.createDataFrame([(1, "one"), (2, "two"), (99, "no")], "k int, name string")
    for how in ("inner", "left", "left_semi", "left_anti"):
        plain = join_unique(df, right, ["k"], how)
        split = join_unique(df, right, ["k"], how, hot_rows=10)
        assert rows(split) == rows(plain) == rows(df.join(right, "k", how))


def test_a_salted_join_reads_the_left_side_once_and_its_keys_once(spark, tmp_path):
    rows_of = [(k, i) for i, k in enumerate([1] * 50 + [None] * 20 + list(range(30)))]
    spark.createDataFrame(rows_of, "k int, i int").write.parquet(str(tmp_path / "left"))
    spark.createDataFrame([(k, str(k)) for k in range(40)], "k int, name string").write.parquet(str(tmp_path / "right"))
    left, right = spark.read.parquet(str(tmp_path / "left")), spark.read.parquet(str(tmp_path / "right"))
    plan = join_unique(left, right, ["k"], "inner", hot_rows=5)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ReadSchema: struct<k:int,i:int>") <= 1 and "Union" not in plan
    hot = hot_keys(left, ["k"], 5)
    shares = salted(left, hot, ["k"]).groupBy("k", "_salt").count().where("k = 1").collect()
    assert len(shares) > 3 and sum(r["count"] for r in shares) == 51
    assert {(r.k, r["count"]) for r in copied(right, hot, ["k"]).groupBy("k").count().collect() if r["count"] > 1} == {(1, 11)}


def test_equal_rows_of_a_hot_key_are_spread_over_the_tasks(spark):
    same = spark.range(0, 1000, 1, 8).selectExpr("1 as k", "'x' as v")
    shares = salted(same, hot_keys(same, ["k"], 100), ["k"])
    assert shares.select("_salt").distinct().count() > 2
    assert rows(join_unique(same, same.distinct(), ["k", "v"], "inner", 100)) == rows(same)


def test_entity_rows(spark):
    df = spark.createDataFrame([(1, "a", 2), (1, "b", 1), (1, "a", None), (2, "a", 1)], "customer_id int, product_type string, o int")
    assert [r.o for r in quality_reports.entity_rows(df, 1, ("o",), "a").collect()] == [2, None]
    assert quality_reports.entity_rows(df, 1, ("o",)).count() == 3
    largest = quality_reports.largest_customers(df)
    assert rows(largest) == [(1,)]
    assert [r.o for r in quality_reports.timelines(df, largest, ("o",)).collect()] == [1, 2, None]
