import importlib

import pytest
import sentencepiece
from llm import brute

from tidemark.llm import queries

pipeline = importlib.import_module("corpus_pipeline")
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The rows before the first stage and after each."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for k, (_, stage) in enumerate(pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stages") / str(k))
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append(docs)
    return out


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_all_but_the_last_keep_the_columns(stages):
    assert all(df.columns == stages[0].columns and df.schema == stages[0].schema for df in stages[:-1])


def test_quality(spark, stages):
    kept = {r.doc_id for r in queries.op7_quality_classifier(spark, SF).collect() if r.predicted}
    assert rows(stages[1]) == sorted((r for r in rows(stages[0]) if r[0] in kept), key=str)
    assert 0 < len(kept) < stages[0].count()


def test_exact(stages):
    best: dict = {}
    for r in rows(stages[1]):
        best[brute.lowered(r[1])] = max(best.get(brute.lowered(r[1]), r), r, key=lambda r: r[0])
    assert rows(stages[2]) == sorted(best.values(), key=str)


def test_near(stages):
    before = rows(stages[2])
    least = {i: c for i, _, c in brute.jaccard_components([(r[0], r[1]) for r in before])}
    assert rows(stages[3]) == [r for r in before if least[r[0]] == r[0]]


def test_mixing_keeps_clean_documents_and_lowers_the_share_of_toxic_ones(spark, stages):
    before, after = rows(stages[3]), rows(stages[4])
    assert set(after) <= set(before)
    toxic = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").collect() if r.toxic}
    clean = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").collect() if not r.toxic}
    gone = {r[0] for r in before} - {r[0] for r in after}
    assert len(gone & clean) <= 0.02 * len(clean)
    share = [sum(r[0] in toxic for r in x) / len(x) for x in (before, after)]
    assert share[1] < share[0]


def test_ids_decode(stages):
    library = sentencepiece.SentencePieceProcessor(model_file=queries.PIECE_MODEL)
    texts = {r[0]: r[1] for r in rows(stages[4])}
    found = stages[5].collect()
    assert len(found) == stages[4].count() and all(r.round_trip for r in found)
    for r in found[:50]:
        ids = [int.from_bytes(r.ids[i : i + 4], "little") for i in range(0, len(r.ids), 4)]
        assert len(ids) == r.n_pieces and library.decode(ids) == texts[r.doc_id]


def test_odd_rows_and_empty_tables(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long, digest string, row string"
    odd = [(None, None, None, None, None, "x", None), (1, "", "", "", 0, None, "y"), (2, "a b", None, None, 3, "x", "y")]
    odd += [(2, "a b", None, None, 3, "x", "y"), (3, "A b", None, None, 3, None, None), (4, "x" * 50_000, "", "", 1, "", "")]
    for name, data in (("odd", odd), ("none", [])):
        for labels in ([], [(2, 1, 0), (4, 0, 1), (None, None, None)]):
            folder = f"{tmp_path}/{name}{len(labels)}"
            docs = spark.createDataFrame(data, schema)
            docs.write.parquet(f"{folder}/documents.parquet")
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
            for _, stage in pipeline.STAGES[:-1]:
                assert stage(spark, docs, folder).columns == docs.columns
            result = pipeline.run(spark, folder).collect()
            assert all(r.round_trip for r in result) and (len(result) > 0) == (len(data) > 0)
