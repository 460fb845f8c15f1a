import hashlib

import pytest
from llm import brute

from tidemark.llm import exact_dedup


def plain(rows):
    """(doc_id, keep_id, group_size, text_sha256) of each row, and how many rows of each group stay."""
    groups: dict = {}
    for doc_id, text in rows:
        groups.setdefault(brute.lowered(text), []).append(doc_id)
    out = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        digest = hashlib.sha256(text.encode()).hexdigest()
        out += [(i, max(known) if known else None, len(ids), digest) for i in ids]
    return sorted(out, key=str)


def check(found, rows):
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found), key=str) == plain(rows)
    kept = [r for r in found if r.kept]
    assert len({r.text_sha256 for r in found}) == len(kept) == len({r.text_sha256 for r in kept})
    assert all(r.doc_id == r.keep_id for r in kept)


ODD = [
    (1, "Same TEXT"), (7, "same text"), (3, "SAME text"), (7, "same text"), (None, "same text"), (2, None), (5, ""), (4, " "),
    (6, "ÄÖ"), (8, "äö"), (9, "x" * 200_000), (10, "X" * 200_000), (None, "alone"), (None, "pair"), (None, "Pair"),
]


@pytest.mark.parametrize("candidates", [500, 1, 0])
def test_each_way_gives_the_same_answer(spark, monkeypatch, candidates):
    # frequent() names the digests that are broadcast; with none of them all rows are shuffled
    if candidates == 0:
        all_of_them = exact_dedup.frequent
        monkeypatch.setattr(exact_dedup, "frequent", lambda table: all_of_them(table).where("false"))
    else:
        monkeypatch.setattr(exact_dedup, "CANDIDATES", candidates)
    df = spark.createDataFrame(ODD, "doc_id long, text string").selectExpr("*", "'x' as keep_id", "1 as item", "2 as rank")
    check(exact_dedup.exact_duplicates(df).collect(), ODD)
    left = exact_dedup.drop_exact_duplicates(df)
    assert left.columns == df.columns
    rows = left.collect()
    assert len(rows) == len({brute.lowered(t) for _, t in ODD})
    best = {brute.lowered(r.text): r.doc_id for r in rows}
    assert best["same text"] == 7 and best[""] == 5 and best["x" * 200_000] == 10


def test_table_and_no_rows(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    check(exact_dedup.exact_duplicates(df).collect(), [tuple(r) for r in df.select("doc_id", "text").collect()])
    assert exact_dedup.exact_duplicates(df.limit(0)).collect() == []
    assert exact_dedup.drop_exact_duplicates(df.limit(0)).collect() == []


def test_one_row_three_million_times(spark):
    df = spark.range(0, 3_000_000, 1, 8).selectExpr("7L as doc_id", "'Same' as text")
    df = df.unionByName(spark.createDataFrame([(3, "same"), (9, "other")], "doc_id long, text string"))
    found = exact_dedup.exact_duplicates(df).groupBy("doc_id", "keep_id", "group_size", "kept").count().collect()
    assert sorted(tuple(r) for r in found) == [
        (3, 7, 3_000_001, False, 1), (7, 7, 3_000_001, False, 2_999_999), (7, 7, 3_000_001, True, 1), (9, 9, 1, True, 1),
    ]


def test_copies_are_written_out_in_steps_over_many_tasks(spark, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(exact_dedup, "STEP", 10)
    df = spark.range(1_000).selectExpr("7L as doc_id", "'Same' as text")
    out = exact_dedup.exact_duplicates(df).withColumn("task", F.spark_partition_id()).collect()
    assert len(out) == 1_000 and sum(r.kept for r in out) == 1 and len({r.task for r in out}) > 3


def test_nothing_leaves_the_jvm(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for result in (exact_dedup.exact_duplicates(df), exact_dedup.drop_exact_duplicates(df)):
        plan = result._jdf.queryExecution().toString()
        assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "ExternalRDD", "CartesianProduct"))
