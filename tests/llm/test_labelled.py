from tidemark.llm import labelled, queries


def test_rows_that_share_an_id_count_once(spark):
    rows = [(1, f"text {i % 3}") for i in range(300)] + [(2, "two"), (3, None), (3, None), (4, "no label")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(2)
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 1)], "doc_id long, quality int")
    found = labelled.sample(docs, labels, ["quality"], queries.F.lit(True))
    assert found.columns == ["doc_id", "text", "quality"]
    got = sorted(map(tuple, found.collect()))
    assert [(r[0], r[2]) for r in got] == [(1, 1), (2, 0), (3, 1)]
    assert got[0][1] in {"text 0", "text 1", "text 2"} and got[1][1] == "two" and got[2][1] is None
