import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidemark.llm import encoding, queries, scoring, separators, wavelet, words
from tidemark.llm.encoding import byte_tokenizer

ODD = [
    (5, "Größe, WORLD!! I'll <|endoftext|> <|ENDOFTEXT|>x. J̌ T̈ a.́b"), (None, "no id"), (3, None), (4, ""),
    (9, "it's... 'tis $$$word### 12.5%"), (9, "it's... 'tis $$$word### 12.5%"), (1, " \t\n"), (7, "long " * 70_000),
]


def plain_ids(rows):
    encoder = Tokenizer.from_file(queries.WORD_TOKENIZER)
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    start, out = 0, []
    for doc_id, text in ordered:
        ids = [*encoder.encode(text or "", add_special_tokens=False).ids, 2]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def shards(df, monkeypatch=None):
    import pyspark.sql.functions as F

    found = wavelet.token_ids(df, queries.WORD_TOKENIZER, 2).select("doc_id", "start", "n_tokens", F.crc32("ids"))
    return sorted((tuple(r) for r in found.collect()), key=lambda r: r[1])


def test_ids_equal_the_library_on_odd_texts(spark):
    df = spark.createDataFrame(ODD, "doc_id long, text string").selectExpr("*", "'x' as ids", "1 as start", "2 as part")
    assert shards(df) == plain_ids(ODD)


def test_ids_equal_the_library_on_the_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert shards(df) == plain_ids([(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()])


def test_no_documents(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert shards(empty) == []
    assert separators.token_counts(empty, queries.BYTE_RANKS, queries.END_OF_TEXT).collect() == []


def check_encoder(encoder, texts):
    plain = Tokenizer.from_file(queries.WORD_TOKENIZER)
    want = [plain.encode(t or "", add_special_tokens=False).ids for t in texts]
    flat, counts = encoder.encode(pa.array(texts, pa.string()))
    assert counts.tolist() == [len(x) for x in want]
    assert flat.tolist() == sum(want, [])


@pytest.mark.parametrize("kept", [0, 400_000])
def test_any_mix_of_pieces_equals_the_library(monkeypatch, kept):
    monkeypatch.setattr(encoding, "KEPT", kept)
    monkeypatch.setattr(encoding, "TOGETHER", 7)
    signs = ["e", "z", "é", "ß", "ÿ", "÷", "×", "É", "µ", "E", "\u0301", "ł", "名", "3", "~", "~", ".", "'s", "`", "\x00", "\x7f", "\u2028", " ", " ", "\n"]
    signs += ["<|endoftext|>", "<|", "\u1fef", "\u212a", "\u0345", "\u00ad", "\ufffe", "\U0001f600"]
    dice, encoder = random.Random(5), encoding.WordTokenizer(queries.WORD_TOKENIZER)
    for size in (0, 1, 40):
        for _ in range(60):
            check_encoder(encoder, ["".join(dice.choices(signs, k=dice.randrange(30))) for _ in range(size)])
    check_encoder(encoder, [None, encoding.LETTERS, encoding.LETTERS.upper(), "".join(map(chr, range(0x250)))])


def test_words_as_python_objects():
    given = [b"a", b"", b"\x00b\x00", "é".encode(), b"a"]
    assert words.listed(pa.array(given, pa.binary())) == given
    assert words.listed(pa.array(given, pa.binary()).slice(1, 2)) == given[1:3]
    assert words.listed(pa.array([], pa.binary())) == []


@pytest.mark.parametrize("kept", [0, 400_000])
def test_subwords_of_words(monkeypatch, kept):
    monkeypatch.setattr(scoring, "KEPT", kept)
    known, encoder = scoring.Subwords(queries.BYTE_RANKS), byte_tokenizer(queries.BYTE_RANKS)
    for some in ([], [b"the", b"\xff", b"unquestionably"], [b"cat", b"the", b"\xc3"], [b"the", b"cat"]):
        found = [np.frombuffer(x, np.int32).tolist() for x in known.of(some)]
        assert found == [encoder.encode_ordinary(" " + x.decode(errors="replace")) for x in some]


def test_few_texts_go_through_the_whole_tokenizer():
    """Words of Latin letters need only its vocabulary, and other pieces share a text."""
    encoder, given = encoding.WordTokenizer(queries.WORD_TOKENIZER), []

    class Counted:
        def __init__(self, tokenizer):
            self.model, self.tokenizer = tokenizer.model, tokenizer

        def encode_batch_fast(self, texts, **how):
            given.extend(texts)
            return self.tokenizer.encode_batch_fast(texts, **how)

    encoder.tokenizer = Counted(encoder.tokenizer)
    letters = ["".join("éèßaou"[i // 6**k % 6] for k in range(4)) for i in range(1_000)]
    check_encoder(encoder, [" ".join(letters)])
    assert not any(given)
    check_encoder(encoder, [" ".join(f"{x}@{i}" for i, x in enumerate(letters))])
    assert len(given) < 10


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 70_000), max_size=1500), st.integers(0, 2**32 - 1))
def test_wavelet_matrix(ids, seed):
    ids = np.array(ids, np.uint32)
    shard = wavelet.Shard(wavelet.shard_bytes(3, 17, [4], [len(ids)], ids))
    matrix = shard.matrix
    assert (shard.part, shard.start, shard.doc_ids) == (3, 17, [4])
    assert np.array_equal(matrix.tokens(), ids)
    if not len(ids):
        return
    rng = np.random.default_rng(seed)
    places = rng.integers(0, len(ids), 20)
    assert np.array_equal(matrix.access(places), ids[places])
    for token in [*ids[places[:5]], 99_999]:
        found = np.flatnonzero(ids == token)
        end = int(rng.integers(0, len(ids) + 1))
        assert matrix.count(int(token)) == len(found)
        assert matrix.count(int(token), end) == (found < end).sum()
        assert [matrix.select(int(token), k) for k in range(len(found))] == found.tolist()
        assert matrix.select(int(token), len(found)) == -1


def plain_counts(rows):
    encoder = byte_tokenizer(queries.BYTE_RANKS)
    return sorted((str(i), len(encoder.encode_ordinary(t or ""))) for i, t in rows)


def test_counts_equal_the_encoder(spark):
    df = spark.createDataFrame(ODD, "doc_id long, text string").selectExpr("*", "'x' as file", "1 as ordinal")
    counted = separators.token_counts(df, queries.BYTE_RANKS, queries.END_OF_TEXT).collect()
    assert sorted((str(r.doc_id), r.n_tokens) for r in counted) == plain_counts(ODD)


@pytest.mark.parametrize("block_bytes, span", [(2, 1), (6, 2), (16, 3), (1 << 20, 256)])
def test_blocks_of_any_size_stitch(spark, tmp_path, block_bytes, span):
    files = {"a": [1, 1, 0, 0, 5, 0, 7, 7, 7, 7, 7, 7, 7, 0, 3, 3], "b": [0], "c": [4, 4, 4], "d": [2, 0, 0, 9, 9, 9, 9, 9, 0]}
    want = []
    for name, ids in files.items():
        (tmp_path / f"{name}.ids").write_bytes(np.array(ids, "<u2").tobytes())
        ordinal = start = 0
        for place, token in enumerate([*ids, None]):
            if token == 0 or (token is None and place > start):
                want.append((f"{name}.ids", ordinal, start, place - start, token == 0))
                ordinal, start = ordinal + 1, place + 1
    blocks = separators.block_counts(spark, str(tmp_path), 0, block_bytes)
    found = separators.document_counts(blocks, span)
    assert sorted(tuple(r) for r in found.select("file", "ordinal", "start", "n_tokens", "ended").collect()) == sorted(want)
