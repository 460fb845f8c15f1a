import hashlib
import random
import re

import pytest
from llm.brute import lowered
from compare import differences, duck
from pyspark.sql import functions as F

from tidemark.llm import decontamination as d

DOCS = "doc_id long, text string"
ITEMS = "item_id long, text string"


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(text))


def plain(docs, items, window):
    """doc_id, n_words, n_hit, sorted item ids of each row, looking at every place of every document."""
    out = []
    for doc_id, text in docs:
        words, hit, ids = terms(text), set(), set()
        for item_id, item in items:
            wanted = terms(item)
            size = min(window, len(wanted))
            windows = {tuple(wanted[i : i + size]) for i in range(len(wanted) - size + 1)} if size else set()
            for i in range(len(words) - size + 1 if size else 0):
                if tuple(words[i : i + size]) in windows:
                    hit |= set(range(i, i + size))
                    ids.add("" if item_id is None else str(item_id))
        out.append((doc_id, len(words), len(hit), sorted(ids)))
    return sorted(out, key=repr)


def found(df):
    rows = df.select("doc_id", "n_words", d.hit_words().alias("h"), d.items_of().alias("i")).collect()
    return sorted(((r.doc_id, r.n_words, r.h, r.i) for r in rows), key=repr)


def some_texts(seed, n, longest, vocabulary):
    pick = random.Random(seed)
    return [" ".join(pick.choice(vocabulary) for _ in range(pick.randint(0, longest))) for _ in range(n)]


@pytest.mark.parametrize("most", [1 << 20, 300])
@pytest.mark.parametrize("seed", [1, 2])
def test_random_texts(spark, seed, most):
    docs = list(enumerate(some_texts(seed, 40, 80, ["a", "b", "C", "dé", "7"])))
    items = list(enumerate(some_texts(seed + 9, 15, 12, ["a", "b", "c", "dé", "no"])))
    docs += [(100 + i, f"x {t}, y") for i, (_, t) in enumerate(items)]
    out = d.matches(spark.createDataFrame(docs, DOCS).repartition(3), spark.createDataFrame(items, ITEMS), 4, most=most)
    assert found(out) == plain(docs, items, 4)


def test_matches_are_maximal_and_in_place(spark):
    docs = [(1, "zero One two, three FOUR five six"), (2, "one two three. one two three four"), (3, "nothing")]
    items = [(7, "one two three four"), (8, "six"), (9, "three four five six seven")]
    out = d.matches(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS), 3)
    got = {r.doc_id: sorted(tuple(m) for m in r.matches) for r in out.collect()}
    assert got == {
        1: [("7", 0, 1, 4), ("8", 0, 6, 1), ("9", 0, 3, 4)],
        2: [("7", 0, 0, 3), ("7", 0, 3, 4)],
        3: [],
    }


ODD_DOCS = [
    (1, None), (2, ""), (3, " .,\n"), (None, "one two three"), (5, "one two three"), (5, "one two three"), (6, "ONE two Three"),
    (7, "one two"), (8, "x " * 40_000 + "one two three"), (9, "one two three"), (10, "single"),
]
ODD_ITEMS = [(1, "one two three"), (1, "one two three"), (2, None), (3, ""), (4, "..."), (None, "one two three"), (6, "single"), (7, "two")]


def test_odd_rows_and_clashing_columns(spark):
    docs = spark.createDataFrame(ODD_DOCS, DOCS).selectExpr("*", "1 as matches", "'m' as n_words", "2 as item_id", "3 as row")
    items = spark.createDataFrame(ODD_ITEMS, ITEMS).selectExpr("*", "1 as id", "2 as doc_id", "3 as matches")
    want = plain(ODD_DOCS, ODD_ITEMS, 3)
    assert found(d.matches(docs, items, 3)) == want
    assert found(d.matches(docs, items, 3, most=80)) == want
    assert d.matches(docs.limit(0), items, 3).count() == 0
    assert found(d.matches(docs, items.limit(0), 3)) == plain(ODD_DOCS, [], 3)
    left = d.clean(docs, items, 3)
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect()) == [1, 2, 3, 9]  # no-break spaces are part of a word


def test_a_one_word_item_ahead_of_another_is_not_joined_to_it(spark):
    docs, items = [(1, "alpha beta gamma")], [(1, "alpha"), (2, "beta gamma")]
    out = d.matches(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS), 2)
    assert sorted(tuple(m) for m in out.first().matches) == [("1", 0, 0, 1), ("2", 0, 1, 2)]


def test_digest_of_items(spark):
    from tidemark.llm import queries

    row = queries.op11_decontamination(spark, "/root/testdata/sf0.001").where("not contaminated").first()
    assert (row.n_hit, row.n_items, row.items_sha256) == (0, 0, hashlib.sha256(b"").hexdigest())


def test_query_equals_sql(spark):
    sf = "/root/testdata/sf0.001"
    assert differences(spark, duck(sf), sf, "op11_decontamination") == []


def test_longest_match_of_every_suffix():
    import numpy as np
    import pyarrow as pa

    texts, item = some_texts(3, 12, 30, ["a", "b", "c"]), "a b c a b b c z a"
    shard, items = d.Shard(pa.array(texts)), d.Items([("1", item)], 3)
    known = {word.as_py().decode(): i for i, word in enumerate(shard.words)}
    query = np.array([known.get(x, len(known)) + 1 for x in item.split()])
    lengths = shard.longest(query, np.arange(len(query)), np.full(len(query), len(query)))
    joined = ["|" + "|".join(t.split()) + "|" for t in texts]
    for i, n in enumerate(lengths):
        words = item.split()[i:]
        best = max(k for k in range(len(words) + 1) if not k or any("|" + "|".join(words[:k]) + "|" in t for t in joined))
        assert n == best
    assert items.window.tolist() == [3] * 7 + [0, 0]


def test_clean_takes_other_names(spark):
    docs = spark.createDataFrame([(1, "one two three", 5), (2, "four", 6)], "doc_id long, text string, keep int")
    items = spark.createDataFrame([(1, "two three")], "name long, text string")
    assert [tuple(r) for r in d.clean(docs, items, 2, item_col="name").collect()] == [(2, "four", 6)]
    assert d.clean(docs, items.where(F.lit(False)), 2, item_col="name").count() == 2
