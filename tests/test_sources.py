from datetime import date

import pytest
from helpers import d, rows, ts

from tidemark.operators.snapshot import load
from tidemark.plans import build, indicators, stored
from tidemark.sources import layout, sample, tables
from tidemark.sources.schemas import RAW

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("table", list(RAW))
def test_csv_round_trip(spark, tmp_path, table):
    given = sample.RAW_TABLES[table](spark, SF)
    path = str(tmp_path / table)
    # quoted in full, as the padded texts would lose their blanks otherwise
    written = given.write.option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    written.csv(path, header=True, quoteAll=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    back = tables.read_csv(spark, path, table)
    assert back.schema.simpleString() == spark.createDataFrame([], RAW[table]).schema.simpleString()
    assert rows(back) == rows(given)


def test_csv_that_does_not_fit_the_schema_fails(spark, tmp_path):
    (tmp_path / "bad.csv").write_text("customer_id,signup_date,region,acquisition_channel,size_band\nx,2024-01-01,a,b,c\n")
    with pytest.raises(Exception, match="Malformed records"):
        tables.read_csv(spark, str(tmp_path), "customers").collect()
    (tmp_path / "bad.csv").write_text("customer_id,wrong,region,acquisition_channel,size_band\n1,2024-01-01,a,b,c\n")
    with pytest.raises(Exception, match="CSV header"):
        tables.read_csv(spark, str(tmp_path), "customers").collect()


def test_parquet_and_catalogue(spark, tmp_path):
    given = sample.customers(spark, SF)
    given.write.parquet(str(tmp_path / "c"))
    back = tables.read_parquet(spark, str(tmp_path / "c"), "customers")
    assert rows(back) == rows(given)
    spark.sql("CREATE DATABASE IF NOT EXISTS raw_data")
    try:
        spark.sql(f"CREATE TABLE raw_data.tb_customers USING parquet LOCATION '{tmp_path / 'c'}'")
        assert rows(tables.source(spark, "raw_data", "tb_customers")) == rows(given)
    finally:
        spark.sql("DROP DATABASE raw_data CASCADE")


def test_partitioned_table(spark, tmp_path):
    df = spark.createDataFrame([(i, d(f"2024-0{1 + i % 3}-01")) for i in range(90)], "id int, month date")
    back = tables.publish_table(df, str(tmp_path / "t"), "month", ("id",))
    assert rows(back) == rows(df)
    assert len(list((tmp_path / "t").glob("*/month=*/*.parquet"))) == 3
    assert "PartitionFilters: [isnotnull(month" in back.where("month = '2024-01-01'")._jdf.queryExecution().toString()
    tables.publish_view(back, "some_view")
    assert spark.table("some_view").count() == 90
    # a new version leaves the old one to its readers
    tables.publish_table(df.limit(5), str(tmp_path / "t"), "month", ("id",))
    assert back.count() == 90 and tables.current_table(spark, str(tmp_path / "t")).count() == 5
    assert tables.current_table(spark, str(tmp_path / "none")) is None


def test_catalogue_view(spark, tmp_path):
    sample.customers(spark, SF).write.parquet(str(tmp_path / "c"))
    try:
        assert tables.publish_catalogue_view(spark, "stored_customers", str(tmp_path / "c")).count() == 150
        assert not [t for t in spark.catalog.listTables() if t.name == "stored_customers"][0].isTemporary
    finally:
        spark.sql("DROP VIEW IF EXISTS stored_customers")


H = "id bigint, v string"


def runner(spark, root):
    schema = tables.history_schema(spark.createDataFrame([], H).schema)

    def run(at, *given):
        current = spark.createDataFrame(list(given), H)
        if not tables.is_stored(spark, root, at):
            tables.publish_history(load(current, tables.open_versions(spark, root, schema), "id", ["v"], at), root, at)
        return rows(tables.read_history(spark, root, schema), "id", "v", "valid_to")

    return run, schema


T = [ts(f"2024-01-1{n}T00:00:00") for n in range(1, 8)]


def test_history_keeps_every_load(spark, tmp_path):
    root = str(tmp_path / "h")
    run, schema = runner(spark, root)
    assert tables.read_history(spark, root, schema) is None
    assert run(T[0], (1, "a"), (2, "b")) == [(1, "a", None), (2, "b", None)]
    after = [(1, "a", T[1]), (1, "c", None), (2, "b", None)]
    assert run(T[1], (1, "c"), (2, "b")) == after
    assert run(T[1], (9, "z")) == after  # stored already: left as it is
    (tmp_path / "h" / "version=20240113T000000000000").mkdir()  # an unfinished load is not read and gives way
    assert len(rows(tables.read_history(spark, root, schema))) == 3
    last = [(1, "a", T[1]), (1, "c", T[2]), (1, "d", None), (2, "b", T[2])]
    assert run(T[2], (1, "d")) == last
    with pytest.raises(ValueError, match="already stored"):
        run(T[0].replace(hour=5), (1, "z"))
    tables.compact_history(spark, root, schema)
    tables.compact_history(spark, root, schema)
    assert rows(tables.read_history(spark, root, schema), "id", "v", "valid_to") == last
    assert run(T[3], (1, "d"), (5, "e")) == sorted([*last, (5, "e", None)], key=str)
    assert run(T[4].replace(microsecond=7), (1, "d")) == sorted([*last, (5, "e", T[4].replace(microsecond=7))], key=str)


def test_loads_without_any_row_do_not_lock_the_history(spark, tmp_path):
    run, _ = runner(spark, str(tmp_path / "h"))
    assert run(T[0]) == [] and run(T[1]) == []
    assert run(T[2], (1, "a")) == [(1, "a", None)]
    assert run(T[3]) == run(T[4]) == run(T[5]) == [(1, "a", T[3])]
    assert run(T[6], (1, "a")) == [(1, "a", T[3]), (1, "a", None)]


def test_whole_build(spark, tmp_path):
    raw = {name: make(spark, SF) for name, make in sample.RAW_TABLES.items()}
    marts = build.build(spark, raw, str(tmp_path / "out"), sample.AS_OF, sample.FIRST_LOAD)
    assert marts["subscription_monthly"].count() == 42178
    assert [r.churn_month for r in marts["churn_metrics"].orderBy("churn_month").collect()][-1] == date(2023, 12, 1)
    scan = {r.signal_name: r.risk_ratio for r in marts["leading_indicator_scan"].collect()}
    assert scan["support_complaint_60d"] == 0.63 and scan["billing_unpaid_or_partpaid_60d"] == 0.62
    assert spark.table("stg_subscriptions").count() == 1500

    # a second day with the same source: same marts, nothing closed
    again = build.build(spark, raw, str(tmp_path / "out"), sample.AS_OF, sample.SECOND_LOAD, buckets=4)
    assert rows(again["leading_indicator_scan"]) == rows(marts["leading_indicator_scan"])
    assert again["subscription_monthly"].count() == 42178
    schema = tables.history_schema(raw["subscriptions"].schema)
    history = tables.read_history(spark, str(tmp_path / "out/snapshots/subscriptions"), schema)
    assert history.where("valid_to is not null").count() == 0
    # frames of the first build still read what they read before, and a repeated run is no error
    assert marts["subscription_monthly"].count() == 42178
    build.refresh_histories(spark, raw, str(tmp_path / "out"), sample.SECOND_LOAD)


def test_lines_that_do_not_fit_are_kept_apart(spark, tmp_path):
    head = "customer_id,signup_date,region,acquisition_channel,size_band\n"
    lines = ["1,2024-01-01,a,b,c", "x,2024-01-01,a,b,c", "3,soon,a,b,c", "4,2024-01-01,a", "5,2024-01-01,a,b,c,d", "6,,,,", '7,2024-01-01,"a,b",b,c']
    (tmp_path / "a.csv").write_text(head + "\n".join(lines[:4]) + "\n")
    (tmp_path / "b.csv").write_text(head + "\n".join(lines[4:]) + "\n")
    good, rejected = tables.read_csv_or_reject(spark, str(tmp_path), "customers")
    assert good.schema.simpleString() == spark.createDataFrame([], RAW["customers"]).schema.simpleString()
    assert rows(good, "customer_id") == [(1,), (6,), (7,)]  # whichever columns are asked for
    assert rows(good.where("customer_id = 7"), "region") == [("a,b",)]
    assert good.count() == 3 and rejected.count() == 4
    found = {r.record: (r.file.rpartition("/")[2], r.reason) for r in rejected.collect()}
    assert found == {
        lines[1]: ("a.csv", "customer_id is no bigint"),
        lines[2]: ("a.csv", "signup_date is no date"),
        lines[3]: ("a.csv", "number of fields"),
        lines[4]: ("b.csv", "number of fields"),
    }
    loaded = tables.load_csv(spark, str(tmp_path), "customers", str(tmp_path / "rejects"))
    assert rows(loaded) == rows(good)
    assert rows(tables.current_table(spark, str(tmp_path / "rejects"))) == rows(rejected)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_buckets_join_without_a_shuffle(spark, tmp_path):
    base = spark.createDataFrame([(i, i % 3 == 0, d("2024-03-01")) for i in range(200)], "subscription_id bigint, is_churned boolean, reference_date date")
    days = [(i % 200, d(f"2024-02-{1 + i % 28:02}"), i % 4, float(i % 90), i % 11) for i in range(3000)]
    usage = spark.createDataFrame(days, "subscription_id bigint, usage_date date, call_count bigint, call_minutes double, concurrent_peak bigint")
    usage = usage.withColumn("call_minutes", usage.call_minutes.cast("decimal(10,2)"))
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        flags = stored.usage_flags_from_buckets(base, usage, str(tmp_path), 4)
        plan = plan_of(flags)
        assert "SortMergeJoin" in plan and "Exchange" not in plan and plan.count("Bucketed: true") == 2
        assert rows(flags) == rows(indicators.usage_flags(base, usage))
        schema = spark.read.parquet(str(tmp_path / "days")).schema
        again = layout.attach_buckets(spark, "attached_days", str(tmp_path / "days"), schema, "subscription_id", 4, ("usage_date",))
        assert "Exchange" not in plan_of(again.groupBy("subscription_id").count())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
        spark.sql("DROP TABLE IF EXISTS attached_days")


def test_daily_usage_bounds_the_rows_of_a_subscription(spark):
    days = [(1, d("2024-02-01"), i % 2, 1.5, i) for i in range(50)] + [(None, d("2024-02-01"), 1, 1.0, 1), (2, None, 1, 1.0, 1)]
    usage = spark.createDataFrame(days, "subscription_id bigint, usage_date date, call_count bigint, call_minutes double, concurrent_peak bigint")
    assert rows(indicators.daily_usage(usage)) == [(1, d("2024-02-01"), 75.0, 49)]


def rows_scanned(df):
    """Rows that left the scan of a plan that has run."""
    plan = df._jdf.queryExecution().executedPlan()
    if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        plan = plan.executedPlan()
    leaves = plan.collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_an_index_reads_few_rows(spark, tmp_path):
    n = 200_000
    df = spark.range(n).selectExpr("(id * 7919) % 100000 * 2 as customer_id", "id % 5 as product", "id as subscription_id", "repeat('x', 20) as t")
    path = str(tmp_path / "index")
    index = layout.publish_index(df, path, "customer_id", ("product", "subscription_id"))
    found = index.where("customer_id = 4242")
    assert sorted(map(tuple, found.collect())) == rows(df.where("customer_id = 4242"))
    assert 2 <= rows_scanned(found) < n / 4
    absent = index.where("customer_id = 4243")  # within the bounds, but no such key: the Bloom filter says so
    assert absent.collect() == [] and rows_scanned(absent) == 0


def test_footers_give_counts_and_bounds_without_reading_rows(spark, tmp_path):
    df = spark.createDataFrame([(1, None, d("2024-01-02"), "a"), (5, -2.5, d("2023-01-02"), "b"), (2, 0.5, None, None)], "i int, x double, day date, s string")
    df.coalesce(1).write.parquet(str(tmp_path / "whole"))
    df.repartition(3, "i").write.parquet(str(tmp_path / "nulls"))  # one file without any x, one without any day
    pushed = layout.column_bounds(layout._footer_session(spark).read.parquet(str(tmp_path / "whole")))
    assert "PushedAggregation: [COUNT(*), MIN(i), MAX(i), MIN(x), MAX(x), MIN(day), MAX(day)]" in plan_of(pushed)
    out = layout.footer_bounds(spark, {t: str(tmp_path / t) for t in ("whole", "nulls")})
    one = [("day", 3, None, None, d("2023-01-02"), d("2024-01-02")), ("i", 3, 1.0, 5.0, None, None), ("x", 3, -2.5, 0.5, None, None)]
    assert rows(out) == [(t, *r) for t in ("nulls", "whole") for r in one]
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"


def test_rows_of_a_bucket_do_not_grow_with_the_table(spark, tmp_path):
    """The stored usage has as many buckets as its rows ask for; one task each writes and joins it."""
    import __spark_entry__ as entry

    assert [layout.buckets_for(n) for n in (0, 4_000_000, 4_000_001, 216_000_000)] == [8, 8, 9, 432]
    made = []

    def publish(df, name, path, key, buckets, sort_by=(), real=layout.publish_buckets):
        made.append(buckets)
        return real(df, name, path, key, buckets, sort_by)

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(layout, "BUCKET_ROWS", 500)
        patch.setattr(layout, "publish_buckets", publish)
        entry.queries()["snk_buckets_usage"](spark, "/root/testdata/sf0.001")
    lines = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").count()
    assert made == [-(-lines // 500)] * 2 and made[0] > 8
