import math
import random
import re

import numpy as np
import pytest
from llm.brute import lowered
from compare import differences, duck

from tidemark.llm import reversed_search as r

DOCS = "doc_id long, text string"
ITEMS = "item_id long, text string"


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lowered(text))


def plain(docs, items, k):
    """item_id, rank, doc_id, score, with whole numbers of any size."""
    counted = [(i, terms(t)) for i, t in docs]
    counted = [(i, w) for i, w in counted if w]
    n, total = len(counted), sum(len(w) for _, w in counted)
    out = []
    for item_id, text in sorted({x for x in items if x[1] is not None}, key=repr):
        scored = []
        for doc_id, words in counted:
            score = 0
            for term in set(terms(text)) & set(words):
                df, tf = sum(term in w for _, w in counted), words.count(term)
                m = 100 - 90 + (90 * len(words) * n) // total
                score += math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1))) * ((1000000000 * tf) // (1000 * tf + 8 * m))
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        out += [(None if item_id is None else str(item_id), rank, s[3], -s[0]) for rank, s in enumerate(sorted(scored, key=lambda s: s[:3])[:k], 1)]
    return sorted(out, key=repr)


def found(spark, docs, items, k, **options):
    docs = spark.createDataFrame(docs, DOCS).selectExpr("*", "1 as score", "'x' as item_id", "2 as id", "3 as n_terms")
    items = spark.createDataFrame(items, ITEMS).selectExpr("*", "1 as id", "2 as doc_id", "3 as rank")
    out = r.ranked(docs.repartition(5), items, k, **options)
    return sorted((tuple(x) for x in out.collect()), key=repr)


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("options", [{}, {"most": 200}])
def test_random_texts(spark, seed, options, monkeypatch):
    pick = random.Random(seed)

    def text(n):
        return " ".join(pick.choice(["a", "B", "cé", "d4", "e-f", "gg"]) for _ in range(pick.randint(0, n)))

    docs = [(i, text(30)) for i in range(60)]
    docs += [(100 + i, t) for i, t in docs[:20]]  # ties
    items = [(i, text(4)) for i in range(12)]
    assert found(spark, docs, items, 3, **options) == plain(docs, items, 3)


ODD_DOCS = [
    (1, None), (2, ""), (3, "..."), (None, "one two"), (None, "one two"), (5, "one two"), (5, "one two"), (6, "ONE, Two!"),
    (7, "three " * 30_000 + "one"), (8, "four"),
]
ODD_ITEMS = [(1, "one"), (1, "one"), (1, "two"), (2, None), (3, ""), (4, "?"), (None, "one one two"), (6, "absent"), (7, "four FOUR")]


def test_odd_rows(spark):
    for k in (1, 4, 50):
        assert found(spark, ODD_DOCS, ODD_ITEMS, k) == plain(ODD_DOCS, ODD_ITEMS, k)
    assert found(spark, ODD_DOCS, ODD_ITEMS, 4, most=100) == plain(ODD_DOCS, ODD_ITEMS, 4)


def test_empty_tables(spark):
    docs, items = spark.createDataFrame(ODD_DOCS, DOCS), spark.createDataFrame(ODD_ITEMS, ITEMS)
    assert r.ranked(docs.limit(0), items).count() == 0
    assert r.ranked(docs, items.limit(0)).count() == 0


def test_heaps_keep_the_best_in_any_order():
    pick = np.random.default_rng(1)
    item, score, doc = pick.integers(0, 5, 3000), pick.integers(0, 50, 3000), pick.integers(0, 900, 3000)
    heaps = r.Heaps(5, 7)
    for part in np.array_split(np.arange(3000), 40):
        heaps.add(item[part], score[part], np.zeros(len(part), np.int64), doc[part])
    for i in range(5):
        mine = heaps.held[0] == i
        got = sorted(zip((-heaps.held[1][mine]).tolist(), heaps.held[3][mine].tolist()))
        assert got == sorted((-int(s), int(d)) for k, s, d in zip(item, score, doc) if k == i and s > 0)[:7]


def test_sums_stay_whole_numbers_beyond_double_precision():
    cell, worth = np.array([3, 1, 3, 900]), np.array([1 << 60, 5, 1, 1])
    for c in (cell, cell % 4):
        cells, score = r._sums(c, worth)
        want = {}
        for k, v in zip(c.tolist(), worth.tolist()):
            want[k] = want.get(k, 0) + v
        assert dict(zip(cells.tolist(), score.tolist())) == want


def test_work_in_small_pieces(spark, monkeypatch):
    docs = [(i, "a b c d " * (i % 7)) for i in range(40)]
    items = [(i, "a b c d e"[i:]) for i in range(5)]
    index = r.Index([(str(i), t) for i, t in items])
    import pyarrow as pa

    counts, held, times = r._counted(pa.array([t for _, t in docs]), index.terms)
    text = np.repeat(np.arange(40), np.diff(held.offsets.to_numpy()))
    flat = [x.flatten().to_numpy().astype(np.int64) for x in (held, times)]
    weight = np.arange(1, len(index.terms) + 1)
    whole = [np.concatenate(c) for c in zip(*r._scored(counts, text, *flat, index, weight, 40, 480))]
    monkeypatch.setattr(r, "POSTINGS", 3)
    pieces = list(r._scored(counts, text, *flat, index, weight, 40, 480))
    assert len(pieces) > 10
    for a, b in zip(whole, [np.concatenate(c) for c in zip(*pieces)]):
        assert a.tolist() == b.tolist()


def test_query_equals_sql(spark):
    sf = "/root/testdata/sf0.001"
    assert differences(spark, duck(sf), sf, "op12_reversed_search") == []
