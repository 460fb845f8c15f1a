import numpy as np
import pyarrow as pa
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import queries, viterbi

TEXTS = [None, "", " ", "  a\n b\t c ", "Größe, ñandú!\r\n\n", "▁ literal ▁▁mark", "日本 🎉 x", "the the the", "a" * 5_000, "\x00\x1f<0x41><s>"]


def score(table, word, ids):
    names = {i: s for i, s in table.table.values()}
    return sum(names.get(i, table.byte_score) for i in ids)


def best_of_all(table, word):
    """The largest score over all segmentations."""
    if not word:
        return 0.0
    found = [table.byte_score * len(word[0].encode()) + best_of_all(table, word[1:])]
    for k in range(1, len(word) + 1):
        if word[:k] in table.table:
            found.append(table.table[word[:k]][1] + best_of_all(table, word[k:]))
    return max(found)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(" abehintrö▁日", max_size=9), max_size=12))
def test_paths_are_best_and_sharing_changes_nothing(words):
    table = viterbi.pieces(queries.PIECE_MODEL)
    words = sorted(words)
    together = list(table.paths(words))
    for word, ids in zip(words, together, strict=True):
        assert ids == next(table.paths([word]))
        assert np.isclose(score(table, word, ids), best_of_all(table, word))


def test_a_text_is_encoded_as_one_path_and_decodes_exactly():
    table = viterbi.pieces(queries.PIECE_MODEL)
    library = sentencepiece.SentencePieceProcessor(model_file=queries.PIECE_MODEL)
    ids, counts = table.encode(pa.array(TEXTS, pa.string()))
    parts = np.split(ids, np.cumsum(counts)[:-1])
    for text, part, back in zip(TEXTS, parts, table.decode(ids, counts), strict=True):
        assert back.decode() == (text or "")
        assert library.decode(part.tolist()) == (text or "")
        whole = next(table.paths([" " + text])) if text else []
        assert np.isclose(score(table, text, part.tolist()), score(table, text, whole))


def test_rows(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "x y"), (3, "again"), (3, "again")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' as ids", "2 as n_pieces")
    back = viterbi.decode(viterbi.encode(docs, queries.PIECE_MODEL), queries.PIECE_MODEL).collect()
    assert sorted((str(r.doc_id), r.text) for r in back) == sorted((str(i), t or "") for i, t in rows)
    assert viterbi.encode(docs.limit(0), queries.PIECE_MODEL).collect() == []


def test_table_round_trip(spark):
    rows = queries.op4_sentencepiece_viterbi(spark, "/root/testdata/sf0.01").collect()
    assert len(rows) == 1000 and all(r.round_trip for r in rows) and sum(r.n_pieces for r in rows) > 100_000
