"""Registered queries of the training-data operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    decontamination,
    exact_dedup,
    mixing,
    ordinal,
    periodic,
    ranking,
    reversed_search,
    scoring,
    separators,
    signature_tree,
    topk,
    viterbi,
    wavelet,
)
from tidemark.llm.shared import crc_remainder

WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
BYTE_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")
END_OF_TEXT = 50256  # free in BYTE_RANKS
END_OF_DOCUMENT = 2


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = wavelet.token_ids(_table(spark, sf_dir, "documents"), WORD_TOKENIZER, END_OF_DOCUMENT)
    return found.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op4_sentencepiece_viterbi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded_and_back(_table(spark, sf_dir, "documents"))


def encoded_and_back(docs: DataFrame) -> DataFrame:
    """doc_id, n_pieces, ids_crc32 and round_trip (the decoded text is the one that was encoded) of every row."""
    docs = docs.select("doc_id", "text", F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("given"))
    back = viterbi.decode(viterbi.encode(docs, PIECE_MODEL, carry=("given",)), PIECE_MODEL)
    same = F.md5(F.col("text").cast("binary")) == F.col("given")
    return back.select("doc_id", "n_pieces", F.crc32("ids").alias("ids_crc32"), same.alias("round_trip"))


DOMAINS = ["clean", "low", "toxic"]
TARGETS = {"clean": 0.90, "low": 0.06, "toxic": 0.04}


def domain_labels(labels: DataFrame) -> DataFrame:
    """doc_id and the place in DOMAINS that the two labels say."""
    domain = F.when(F.col("toxic") > 0, 2).when(F.col("quality") > 0, 0).otherwise(1)
    return labels.where("toxic is not null and quality is not null").select("doc_id", domain.alias("domain"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), domain_labels(_table(spark, sf_dir, "labels"))
    return mixing.rates_of(docs, mixing.train(docs, labels, DOMAINS, F.lit(True)), TARGETS)


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return separators.token_counts(_table(spark, sf_dir, "documents"), BYTE_RANKS, END_OF_TEXT)


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.score(_table(spark, sf_dir, "documents"), crc_remainder("doc_id", 7) != 2, BYTE_RANKS, END_OF_TEXT)


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(_table(spark, sf_dir, "documents"))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op8_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordinal.toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op10_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signature_tree.linked_documents(_table(spark, sf_dir, "documents"))


def op11_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.matches(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    items = decontamination.items_of()
    return found.select("doc_id", "n_words", decontamination.hit_words().alias("n_hit"), items.alias("items")).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op12_reversed_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = _table(spark, sf_dir, "benchmark")
    found = reversed_search.ranked(_table(spark, sf_dir, "documents"), items)
    return found.withColumn("item_id", F.col("item_id").cast(items.schema["item_id"].dataType))


def planted(docs: DataFrame) -> DataFrame:
    """Documents whose id says so (crc32 % 10 = 0) repeat a stretch of p words from word a on to their end."""
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    words = F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), "")
    rows = docs.select("doc_id", "text", (h % 10 == 0).alias("chosen"), F.floor(h / 10).alias("g"))
    rows = rows.withColumn("words", F.when(F.col("chosen"), words))
    rows = rows.withColumn("n", F.greatest(F.size("words"), F.lit(0)).cast("long"))
    rows = rows.withColumn("a", F.col("g") % F.greatest("n", F.lit(1)))
    rows = rows.withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)))
    start, period = F.col("a").cast("int"), F.col("p").cast("int")
    times = F.ceil((F.col("n") - F.col("a")) / F.col("p")).cast("int")
    repeated = F.flatten(F.array_repeat(F.slice("words", start + 1, period), times))
    changed = F.slice(F.concat(F.slice("words", F.lit(1), start), repeated), F.lit(1), F.col("n").cast("int"))
    return rows.select("doc_id", F.when(F.col("n") > 0, F.array_join(changed, " ")).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.periodic_runs(planted(_table(spark, sf_dir, "documents")))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("l"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    rows = found.select("doc_id", "collapsed", lines.alias("lines"), longest.alias("top"))
    return rows.select(
        "doc_id",
        F.size("lines").cast("long").alias("n_runs"),
        (-F.col("top.s")).alias("start"),
        F.col("top.l").alias("length"),
        (-F.col("top.p")).alias("period"),
        F.floor(1000 * F.col("top.l") / -F.col("top.p")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join("lines", ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


EXACT_DEDUP_SQL = """
with texts as (
  select doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'))
    as text_sha256
  from documents
)
select doc_id, max(doc_id) over (partition by text_sha256) as keep_id,
  count(*) over (partition by text_sha256) as group_size,
  row_number() over (partition by text_sha256 order by doc_id desc nulls last) = 1 as kept, text_sha256
from texts
"""


# a list is compared component by component; the pairs are those of the stated query set with all rows
TOP_K_SQL = """
with parts as (
  select vec_id, embedding, [floor(1024 * x::double) for x in embedding] as v from embeddings
  where embedding is not null
    and len([x for x in embedding if x is null or not isfinite(x::double)]) = 0
),
scored as (
  select q.vec_id as query_id, c.vec_id, cast(list_inner_product(q.v, c.v) as bigint) as score
  from parts q join parts c on q.vec_id <> c.vec_id
  where q.vec_id % 100 = 0
)
select query_id, cast(rank as integer) as rank, vec_id, score
from (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from scored)
where rank <= 10
"""


def _terms(text: str) -> str:
    lowered = f"translate(coalesce({text}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return rf"regexp_extract_all({lowered}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


DECONTAMINATION_SQL = f"""
with docs as materialized (
  select row_number() over () as r, doc_id, {_terms("text")} as words from documents
),
items as materialized (
  select distinct coalesce(cast(item_id as varchar), '') as item_id, {_terms("text")} as words from benchmark
),
windows as materialized (
  select distinct item_id, w, array_to_string(list_slice(words, i, i + w - 1), ' ') as key
  from (select item_id, words, least(len(words), 10) as w, unnest(range(1, len(words) - least(len(words), 10) + 2)) as i
        from items where len(words) > 0)
),
hits as materialized (
  select r, item_id, i, w
  from (select r, i, w, array_to_string(list_slice(words, i, i + w - 1), ' ') as key
        from (select r, words, w, unnest(range(1, len(words) - w + 2)) as i
              from docs, (select distinct w from windows) where len(words) >= w)) d
  join windows using (w, key)
),
words_hit as (
  select r, count(distinct i + k) as n_hit from (select r, i, unnest(range(w)) as k from hits) group by r
),
named as (
  select r, count(*) as n_items, string_agg(item_id, ',' order by item_id) as items
  from (select distinct r, item_id from hits) group by r
)
select doc_id, cast(len(words) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from docs left join words_hit using (r) left join named using (r)
"""


REVERSED_SEARCH_SQL = f"""
with docs as materialized (
  select row_number() over () as r, doc_id, {_terms("text")} as words from documents
),
totals as materialized (
  select cast(count(*) filter (where len(words) > 0) as bigint) as docs, cast(sum(len(words)) as bigint) as terms from docs
),
items as materialized (
  select row_number() over () as i, item_id, words
  from (select distinct item_id, text, {_terms("text")} as words from benchmark where text is not null)
),
item_terms as materialized (select distinct i, unnest(words) as term from items),
counted as materialized (
  select r, term, count(*) as tf from (select r, unnest(words) as term from docs)
  where term in (select term from item_terms) group by r, term
),
weights as materialized (
  select term, cast(floor(1000 * ln((2 * t.docs + 2)::double / (2 * count(*) + 1)::double)) as bigint) as w
  from counted, totals t group by term, t.docs
),
parts as (
  select c.r, c.term, w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + ((90 * len(d.words) * t.docs) // t.terms)))) as worth
  from counted c join weights using (term) join docs d on d.r = c.r, totals t
),
scored as (
  select i, r, cast(sum(worth) as bigint) as score from parts join item_terms using (term) group by i, r
),
best as (
  select i, doc_id, score, cast(row_number() over (partition by i order by score desc, doc_id nulls last) as integer) as rank
  from scored join docs using (r) where score > 0
)
select item_id, rank, doc_id, score from best join items using (i) where rank <= 10
"""


# crc32 byte by byte with the table of its polynomial (fixed value); list_reduce starts from the first element
CRC32 = """xor(list_reduce(list_concat([4294967295::bigint],
    list_transform(string_split({0}, ''), lambda c: ascii(c)::bigint)), lambda c, b: xor(c >> 8, t.crc[(xor(c, b) & 255) + 1])), 4294967295)"""

PERIODIC_SQL = rf"""
with t as materialized (
  select list(list_reduce([n::bigint, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: xor(c >> 1, 3988292384 * (c & 1))) order by n) as crc
  from range(256) r(n)
),
given as materialized (
  select row_number() over () as r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as given,
    case when doc_id is null then 0 else {CRC32.format("cast(doc_id as varchar)")} end as h
  from documents, t
),
chosen as materialized (
  select *, len(given) as n, (h // 10) % greatest(len(given), 1) as a, h // 10 as g from given
),
texts as materialized (
  select r, doc_id, n, case when h % 10 <> 0 or n = 0 then given
    else list_transform(range(n), lambda i: given[1 + case when i < a then i else a + (i - a) % (1 + (n - a) // (3 + g % 8)) end]) end
    as words
  from chosen
),
placed as materialized (
  select r, n, unnest(range(n)) as i, unnest(words) as word from texts
),
pairs as (
  select x.r, x.i, y.i - x.i as q
  from placed x join placed y on x.r = y.r and x.word = y.word and y.i > x.i and 4 * (y.i - x.i) <= x.n
),
islands as (
  select r, q, min(i) as first, max(i) + q + 1 - min(i) as length
  from (select *, i - row_number() over (partition by r, q order by i) as island from pairs)
  group by r, q, island
),
runs as materialized (
  select r, first, length, min(q) as q from islands where length >= greatest(6, 4 * q) group by r, first, length
),
listed as (
  select r, count(*) as n_runs, string_agg(first || ',' || length || ',' || q || chr(10), '' order by first, q) as lines
  from runs group by r
),
longest as (
  select r, first, length, q from runs qualify row_number() over (partition by r order by length desc, first, q) = 1
),
dropped as (
  select distinct r, unnest(range(first + q, first + length)) as i from runs
),
collapsed as (
  select r, string_agg(word, ' ' order by i) as kept from placed anti join dropped using (r, i) group by r
)
select doc_id, coalesce(n_runs, 0) as n_runs, cast(first as bigint) as start, cast(length as bigint) as length,
  cast(q as bigint) as period, cast((1000 * length) // q as bigint) as exponent_milli,
  sha256(coalesce(lines, '')) as runs_sha256, sha256(coalesce(kept, '')) as collapsed_sha256
from texts left join listed using (r) left join longest using (r) left join collapsed using (r)
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    registered = (
        op1_token_ids, op2_lm_scoring, op3_exact_dedup, op4_sentencepiece_viterbi, op5_mixing, op6_token_counts,
        op7_quality_classifier, op8_exact_top_k, op9_toxicity, op10_ngram_jaccard_join, op11_decontamination,
        op12_reversed_search, op13_periodic_runs,
    )
    return {f.__name__: f for f in registered}


def oracle_sql() -> dict[str, str]:
    return {
        "op3_exact_dedup": EXACT_DEDUP_SQL,
        "op8_exact_top_k": TOP_K_SQL,
        "op11_decontamination": DECONTAMINATION_SQL,
        "op12_reversed_search": REVERSED_SEARCH_SQL,
        "op13_periodic_runs": PERIODIC_SQL,
    }
