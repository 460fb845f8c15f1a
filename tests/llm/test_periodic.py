import random
import re
import zlib

import numpy as np
import pytest
from compare import differences, duck

from tidemark.llm import periodic, queries, suffixes

SCHEMA = "doc_id long, text string"


def plain_runs(words):
    """(start, length, period) of every run, trying every period at every place."""
    n, found = len(words), {}
    for q in range(n // 4, 0, -1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q):
                found[i, j + q - i] = q
            i = j
    return sorted((i, length, q) for (i, length), q in found.items())


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def plain(text):
    words = split(text)
    runs = plain_runs(words)
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    return len(words), runs, " ".join(w for i, w in enumerate(words) if i not in dropped)


def some_words(pick):
    n, k = pick.randint(0, 70), pick.randint(1, 4)
    words = [pick.choice("abcdE"[:k]) for _ in range(n)]
    if n and pick.random() < 0.6:
        a, p = pick.randint(0, n - 1), pick.randint(1, 9)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


@pytest.mark.parametrize("seed", range(40))
def test_runs_of_random_words(seed):
    pick = random.Random(seed)
    texts = [some_words(pick) for _ in range(12)]
    flat = np.array([ord(w) for t in texts for w in t], np.int64)
    got = np.stack(periodic.runs(flat, np.array([len(t) for t in texts])), axis=1).tolist()
    want, offset = [], 0
    for t in texts:
        want += [[s + offset, s + offset + n, q] for s, n, q in plain_runs(t)]
        offset += len(t)
    assert got == want


@pytest.mark.parametrize("apart", [False, True])
def test_suffix_array_and_common_prefixes(apart):
    pick = random.Random(5)
    texts = [some_words(pick) for _ in range(15)]
    flat, counts = np.array([ord(w) for t in texts for w in t]), np.array([len(t) for t in texts])
    order, levels = suffixes.suffix_array(flat, counts, apart)
    start, stop = suffixes.stops(counts)
    assert sorted(order.tolist()) == list(range(len(flat)))
    content = [(int(start[i]) if apart else 0, flat[i : stop[i]].tolist()) for i in order]
    assert content == sorted(content)
    ranks = levels[-1][order]
    assert [a == b for a, b in zip(content, content[1:])] == (ranks[1:] == ranks[:-1]).tolist()
    if apart:
        a, b = order[:-1], order[1:]
        same = start[a] == start[b]
        for x, y, n in zip(a[same], b[same], suffixes.common(levels, a[same], b[same], stop)):
            limit = min(stop[x] - x, stop[y] - y)
            assert n == next((k for k in range(limit) if flat[x + k] != flat[y + k]), limit)


def test_nearest_below():
    pick = random.Random(3)
    for n in (1, 2, 3, 8, 50, 129):
        values = np.array([pick.randint(-1, 4) for _ in range(n)])
        before, after = suffixes.nearest_below(values, np.arange(n))
        for i in range(n):
            assert before[i] == max((j for j in range(i) if values[j] < values[i]), default=-1)
            assert after[i] == min((j for j in range(i + 1, n) if values[j] < values[i]), default=n)


ODD = [
    (1, None), (2, ""), (3, " \t\n"), (None, "a a a a a a"), (4, "a a a a a"), (5, "a a a a a a"), (5, "a a a a a a"), (6, "A a A a A a A a"),
    (7, "x " + "one two three " * 5 + "one"), (8, "no repeats at all here"), (9, "\u00a0 \u00a0 \u00a0 \u00a0 \u00a0 \u00a0"),
    (10, "w " * 30_000), (11, "a b " * 9_000 + "c " * 500), (12, "é.\x0bé.\x0cé.\ré. é. é."),
]


def rows(df):
    return sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in df.collect()), key=repr)


def test_odd_rows(spark):
    df = spark.createDataFrame(ODD, SCHEMA).selectExpr("*", "1 as runs", "'c' as collapsed", "2 as n_words", "3 as start")
    short = [(i, t) for i, t in ODD if len(t or "") < 1000]
    got = rows(periodic.periodic_runs(df))
    assert [r for r in got if r[1] < 1000] == sorted(((i, *plain(t)) for i, t in short), key=repr)
    long = {r[0]: r for r in got if r[1] >= 1000}
    assert long[10][2:] == ([(0, 30_000, 1)], "w")
    assert long[11][2:] == ([(0, 18_000, 2), (18_000, 500, 1)], "a b c")
    assert periodic.periodic_runs(df.limit(0)).count() == 0
    assert rows(periodic.periodic_runs(df.repartition(5))) == got


def model_planted(doc_id, text):
    words, h = split(text), zlib.crc32(str(doc_id).encode() if doc_id is not None else b"")
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def test_planted_repeats(spark):
    pick = random.Random(4)
    docs = [(i, "  " * (i % 2) + "\n ".join(some_words(pick))) for i in range(400)] + [(None, "a b c d e f"), (40, None)]
    got = queries.planted(spark.createDataFrame(docs, SCHEMA).selectExpr("*", "1 as n", "2 as words"))
    assert sorted((str(r.doc_id), split(r.text)) for r in got.collect()) == sorted((str(i), model_planted(i, t)) for i, t in docs)


def test_query_equals_sql(spark):
    sf = "/root/testdata/sf0.001"
    assert differences(spark, duck(sf), sf, "op13_periodic_runs") == []
