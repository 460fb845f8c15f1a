import numpy as np
import pytest

from tidemark.llm import mixing, queries


def plain_rates(n, p, targets, total, least, steps):
    """The same descent with all documents in one array."""
    rate, size = np.full(len(n), max(total, least)), n.sum()
    weight = 1 / np.maximum(targets, 1e-3)
    curve = (p * n[:, None]).T @ p / size
    step = 1 / np.linalg.eigvalsh(np.sqrt(weight)[:, None] * curve * np.sqrt(weight)[None]).max()
    for _ in range(steps):
        off = (rate * n) @ p / size - total * targets
        rate = np.maximum(least, rate - p @ (weight * off * step))
    return rate


@pytest.mark.parametrize("total, least", [(1.0, 0.0), (1.5, 1.0), (0.1, 0.0)])
def test_rates_equal_those_of_one_array_and_meet_the_targets(spark, total, least):
    rng = np.random.default_rng(5)
    n, p = rng.integers(0, 900, 400), rng.dirichlet([0.2, 0.1, 0.05], 400)
    rows = [(int(a), *map(float, b)) for a, b in zip(n, p, strict=True)]
    members = spark.createDataFrame(rows, "n long, a double, b double, c double")
    targets = [0.6, 0.3, 0.1]
    rates = mixing.fit_rates(members, "n", ["a", "b", "c"], targets, total, least, steps=25)
    found = np.array([r.rate for r in members.withColumn("rate", rates.column(["a", "b", "c"])).collect()])
    assert np.allclose(found, plain_rates(n, p, np.array(targets), total, least, len(rates.steps)))
    assert found.min() >= least
    shares = (found * n) @ p / n.sum()
    assert np.allclose(shares, total * np.array(targets), atol=0.03 * total) or least > 0


def test_the_table_comes_to_its_targets(spark):
    rows = queries.op5_mixing(spark, "/root/testdata/sf0.1").collect()
    p = np.array([[r.p_clean, r.p_low, r.p_toxic] for r in rows])
    n, rate = np.array([r.n_tokens for r in rows]), np.array([r.rate for r in rows])
    targets = np.array([queries.TARGETS[d] for d in queries.DOMAINS])
    assert np.allclose(p.sum(axis=1), 1) and rate.min() >= 0
    assert np.allclose((rate * n) @ p / n.sum(), targets, atol=2e-3)
    copies = np.array([r.copies for r in rows])
    assert np.allclose((copies * n) @ p / n.sum(), targets, atol=0.03) and (np.abs(copies - rate) < 1).all()


def test_posteriors_know_the_domains(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = queries._table(spark, sf, "documents"), queries.domain_labels(queries._table(spark, sf, "labels"))
    model = mixing.train(docs, labels, queries.DOMAINS, labels["doc_id"] % 4 != 0)
    members, _, shares = mixing.with_posteriors(docs.select("doc_id", "text"), model)
    held = members.join(labels.where("doc_id % 4 = 0"), "doc_id").collect()
    right = [int(np.argmax([r[s] for s in shares])) == r.domain for r in held]
    assert np.mean(right) > 0.93


def test_odd_rows(spark):
    rows = [(1, "x y", "k"), (None, None, None), (3, "", "l"), (1, "x y", "k")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, tokens string").withColumnRenamed("tokens", "p0_")
    none = spark.createDataFrame([], "doc_id long, domain int")
    model = mixing.train(docs, none, ["a", "b"], queries.F.lit(True))
    found = mixing.rates_of(docs, model, {"a": 1, "b": 3})
    assert found.count() == 4 and {r.n_tokens for r in found.collect()} == {0, 2}
    assert mixing.rates_of(docs.limit(0), model, {"a": 1, "b": 3}).collect() == []
    long = spark.createDataFrame([(1, "word " * 300_000), (2, "x" * 900_000)], "doc_id long, text string")
    found = {r.doc_id: r.n_tokens for r in mixing.rates_of(long, model, {"a": 1, "b": 1}).collect()}
    assert found == {1: 300_000, 2: 1}
    again = mixing.mixed(docs, model, {"a": 1, "b": 1}, total=2.0, least=1.0)
    assert again.columns == docs.columns and again.count() == 8
    assert mixing.mixed(docs.limit(0), model, {"a": 1, "b": 1}).collect() == []


@pytest.mark.parametrize("rare", [0.001, 0.0001])
def test_rare_domains_come_to_their_targets(spark, rare):
    n, p = np.full(1_000, 10), np.full((1_000, 3), [0.998, 0.001, 0.001])
    p[:2] = [[0.02, 0.96, 0.02], [0.02, 0.02, 0.96]]
    n[:2] = rare * 10_000
    rows = [(int(a), *map(float, b)) for a, b in zip(n, p, strict=True)]
    members = spark.createDataFrame(rows, "n long, a double, b double, c double").coalesce(1)
    targets = np.array([0.9, 0.06, 0.04])
    rates = mixing.fit_rates(members, "n", ["a", "b", "c"], [*targets])
    found = np.array([r.rate for r in members.withColumn("rate", rates.column(["a", "b", "c"])).collect()])
    assert found.min() >= 0 and np.allclose((found * n) @ p / n.sum(), targets, atol=1e-3)


def test_targets_out_of_reach_are_reported(spark):
    members = spark.createDataFrame([(10, 0.5, 0.5), (20, 0.5, 0.5)], "n long, a double, b double").coalesce(1)
    with pytest.warns(UserWarning, match="mixing ends"):
        mixing.fit_rates(members, "n", ["a", "b"], [0.9, 0.1])
