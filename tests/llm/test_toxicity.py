import numpy as np

from tidemark.llm import ordinal, queries


def test_held_out_toxic_documents_are_found(spark):
    sf = "/root/testdata/sf0.1"
    rows = queries.op9_toxicity(spark, sf).collect()
    toxic = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    held = [(r.toxic, r.severity, toxic[r.doc_id]) for r in rows if r.held_out and r.doc_id in toxic]
    assert np.mean([found for found, _, label in held if label]) > 0.9
    assert np.mean([found for found, _, label in held if not label]) < 0.01
    assert min(s for _, s, label in held if label and s > 0.5) > max(0.3, np.median([s for _, s, label in held if not label]))


def test_weights_are_shared_and_thresholds_ordered():
    rng = np.random.default_rng(0)
    strength = rng.uniform(0, 3, 3000)
    grade = np.searchsorted([1, 2, 2.5], strength + 0.1 * rng.normal(size=3000))
    weights, thresholds = ordinal.fit_thresholds_and_weights(np.arange(3000), np.zeros(3000, int), strength, grade, 1)
    assert (np.diff(thresholds) > 0).all()
    assert np.allclose(thresholds / weights[0], [1, 2, 2.5], atol=0.1)


def test_odd_rows_and_labels(spark):
    rows = [(1, "a bad BAD!! word", 1), (None, None, 2), (3, "", 3), (1, "a bad BAD!! word", 1), (5, "x" * 100_000, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, severity int")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    found = ordinal.toxicity(docs, none).collect()
    assert len(found) == 5 and not any(r.toxic for r in found)
    some = spark.createDataFrame([(1, 1, 1), (3, 1, 0), (5, None, 0), (None, 1, 1)], "doc_id long, quality int, toxic int")
    assert len(ordinal.toxicity(docs, some).collect()) == 5
    assert ordinal.toxicity(docs.limit(0), some).collect() == []
