import pytest
from helpers import d, rows, ts
from pyspark.errors import PySparkException

from tidemark.operators.snapshot import snapshot

T1, T2, T3 = ts("2024-01-18T00:00:00"), ts("2024-01-19T00:00:00"), ts("2024-01-20T00:00:00")


def table(spark, *given):
    return spark.createDataFrame([(k, v, d(w), u) for k, v, w, u in given], "id bigint, v string, w date, untracked string")


def load(current, history, at, **options):
    return snapshot(current, history, "id", ["v", "w"], at, **options)


def versions(df):
    return rows(df, "id", "v", "w", "valid_from", "valid_to")


def test_two_loads(spark):
    first = table(
        spark,
        (1, "same", None, "a"),
        (2, "old", None, "a"),
        (3, None, None, "a"),
        (4, "x", "2024-01-01", "a"),
        (5, "gone", None, "a"),
        (6, "same", None, "before"),
        (7, "twice", None, "a"), (7, "twice", None, "a"),
        (8, "twice", None, "a"), (8, "twice", None, "a"),
    )
    second = table(
        spark,
        (1, "same", None, "a"), (1, "same", None, "a"),
        (2, "new", None, "a"),
        (3, "value", None, "a"),
        (4, "x", None, "a"),
        (6, "same", None, "after"),
        (7, "twice", None, "a"), (7, "twice", None, "a"),
        (8, "other", None, "a"),
        (9, "fresh", None, "a"),
    )
    out = load(second, load(first, None, T1), T2)
    assert versions(out) == sorted(
        [
            (1, "same", None, T1, None),
            (2, "new", None, T2, None),
            (2, "old", None, T1, T2),
            (3, "value", None, T2, None),
            (3, None, None, T1, T2),
            (4, "x", d("2024-01-01"), T1, T2),
            (4, "x", None, T2, None),
            (5, "gone", None, T1, T2),
            (6, "same", None, T1, None),
            (7, "twice", None, T1, None),
            (7, "twice", None, T1, None),
            (8, "other", None, T2, None),
            (8, "twice", None, T1, T2),
            (8, "twice", None, T1, T2),
            (9, "fresh", None, T2, None),
        ],
        key=lambda r: [(v is None, str(type(v)), v if v is not None else 0) for v in r],
    )
    assert rows(out.where("id = 6"), "untracked") == [("before",)]
    assert out.columns == ["id", "v", "w", "untracked", "scd_id", "updated_at", "valid_from", "valid_to"]


def test_rows_without_key(spark):
    current = table(spark, (1, "a", None, "x"), (None, "b", None, "x"), (None, "c", None, "x"))
    out = load(current, load(current, None, T1), T2)
    assert versions(out.where("id is null")) == [
        (None, "b", None, T1, T2),
        (None, "b", None, T2, None),
        (None, "c", None, T1, T2),
        (None, "c", None, T2, None),
    ]
    assert versions(out.where("id = 1")) == [(1, "a", None, T1, None)]


def test_unchanged_input_changes_nothing(spark):
    current = table(spark, (1, "a", None, "x"), (2, None, "2024-01-01", "x"))
    history = load(current, None, T1)
    assert rows(load(current, history, T2)) == rows(history)


def test_a_key_that_returns_opens_a_new_version(spark):
    one, none = table(spark, (1, "a", None, "x")), table(spark, (2, "b", None, "x"))
    out = load(one, load(none, load(one, None, T1), T2), T3)
    assert versions(out.where("id = 1")) == [(1, "a", None, T1, T2), (1, "a", None, T3, None)]
    assert out.where("id = 1").select("scd_id").distinct().count() == 2


def test_conflicting_rows_fail(spark):
    history = load(table(spark, (1, "a", None, "x")), None, T1)
    with pytest.raises(PySparkException, match="different rows share the key 1"):
        load(table(spark, (1, "a", None, "x"), (1, "b", None, "x")), history, T2).collect()


def test_conflicting_open_versions_fail(spark):
    two = table(spark, (1, "a", None, "x"), (1, "b", None, "x"))
    with pytest.raises(PySparkException, match="different rows share the key 1"):
        load(two, None, T1).collect()
    history = load(two.where("v = 'a'"), None, T1)
    history = history.union(load(two.where("v = 'b'"), None, T1))
    with pytest.raises(PySparkException, match="different rows share the key 1"):
        load(table(spark, (1, "a", None, "x")), history, T2).collect()


def test_version_id(spark):
    (row,) = load(table(spark, (1, "a", None, "x")), None, T1).collect()
    import hashlib

    assert row.scd_id == hashlib.md5(b"1|2024-01-18 00:00:00").hexdigest()
    assert row.updated_at == row.valid_from == T1


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_chained_loads_grow_by_one_step_each(spark, tmp_path):
    """Each side is read once and the plan grows by the same amount with every load."""
    history, sizes = None, []
    for n in range(5):
        table(spark, (1, "a", None, "x"), (2, str(n), None, "x")).write.parquet(str(tmp_path / str(n)))
        history = load(spark.read.parquet(str(tmp_path / str(n))), history, ts(f"2024-01-1{n}T00:00:00"))
        plan = plan_of(history)
        assert plan.count("FileScan") == n + 1 and plan.count("Exchange ") == n + 1
        sizes.append(len(plan.splitlines()))
    steps = [b - a for a, b in zip(sizes[1:], sizes[2:])]
    assert max(steps) - min(steps) <= 2
    assert history.count() == 6


def test_many_copies_unfold_in_steps(spark, monkeypatch):
    from tidemark.operators import snapshot as module

    monkeypatch.setattr(module, "MOST_COPIES", 7)
    current = spark.range(50).selectExpr("1L as id", "'a' as v", "date'2024-01-01' as w", "'x' as untracked")
    history = load(current, None, T1)
    assert history.count() == 50
    out = load(current.selectExpr("id", "'b' as v", "w", "untracked"), history, T2)
    assert (out.where("valid_to is null").count(), out.where("valid_to is not null").count()) == (1, 50)


def test_empty_sides(spark):
    current = table(spark, (1, "a", None, "x"))
    none = current.where("false")
    assert load(none, None, T1).count() == 0
    history = load(current, load(none, None, T1), T2)
    assert versions(history) == [(1, "a", None, T2, None)]
    assert versions(load(none, history, T3)) == [(1, "a", None, T2, T3)]
