"""Registered queries of the training-data operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from matchlake.llm import (
    class_lm,
    decontaminate,
    embedding_graph,
    exact_topk,
    language,
    packing,
    pii,
    repeated_text,
    separator_scan,
    simhash,
    spelling,
    token_alignment,
    toxicity,
)
from matchlake.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_flat_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_graph.near_duplicates(table(spark, sf_dir, "embeddings"))


def op2_sum_of_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents")).drop("ids")


def op3_separator_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = separator_scan.document_token_counts(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_tokens")


def op4_simhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "fingerprint", "component_id")


def op5_bm25_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score_documents(docs, model)


def op7_bootstrapped_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents"))
    return found.drop("all_spans", *pii.KEY)


def op8_prefix_doubling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_text.digests(repeated_text.without_repeats(table(spark, sf_dir, "documents")))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language.predict(docs, language.train(docs))


def op10_brown_class_ngrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return class_lm.score_documents(table(spark, sf_dir, "documents"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.align(table(spark, sf_dir, "documents"))


def op12_pivot_distance_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_topk.top_k(table(spark, sf_dir, "embeddings"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Query]:
    return {
        "op1_flat_graph": op1_flat_graph,
        "op2_sum_of_squares_packing": op2_sum_of_squares_packing,
        "op3_separator_scan": op3_separator_scan,
        "op4_simhash_near_duplicates": op4_simhash_near_duplicates,
        "op5_bm25_decontamination": op5_bm25_decontamination,
        "op6_toxicity": op6_toxicity,
        "op7_bootstrapped_pii": op7_bootstrapped_pii,
        "op8_prefix_doubling": op8_prefix_doubling,
        "op9_language_id": op9_language_id,
        "op10_brown_class_ngrams": op10_brown_class_ngrams,
        "op11_token_alignment": op11_token_alignment,
        "op12_pivot_distance_topk": op12_pivot_distance_topk,
        "op13_spelling_variants": op13_spelling_variants,
    }


# The other operators have no SQL form (learned models, token ids, XXH64 fingerprints, byte
# strings); tests/llm compares them with brute force.
FLAT_GRAPH_SQL = """
with recursive vectors as (
  select distinct vec_id, label, embedding::double[] as e from embeddings
  where vec_id is not null and label is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0),
links as (
  select a.vec_id as x, b.vec_id as y from vectors a join vectors b
    on a.label = b.label and a.vec_id <> b.vec_id and len(a.e) = len(b.e)
  where list_cosine_similarity(a.e, b.e) >= 0.98),
reached(x, y) as (select x, y from links union select r.x, l.y from reached r join links l on r.y = l.x),
counts as (select x, count(*) as n from links group by x),
least_ids as (select x, min(y) as y from reached group by x)
select v.vec_id, coalesce(c.n, 0) as n_links, least(v.vec_id, coalesce(m.y, v.vec_id)) as component_id,
  v.vec_id <= coalesce(m.y, v.vec_id) as kept
from embeddings v left join counts c on c.x = v.vec_id left join least_ids m on m.x = v.vec_id
"""

TOP_K_SQL = """
with vectors as (
  select distinct vec_id, list_transform(embedding, lambda x: floor(1024 * x::double)) as e from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scores as (
  select q.vec_id as query_id, c.vec_id, max(list_inner_product(q.e, c.e))::bigint as score
  from vectors q join vectors c on q.vec_id <> c.vec_id and len(q.e) = len(c.e)
  where q.vec_id % 100 = 0 group by all),
ranked as (select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank from scores)
select query_id, rank, vec_id, score from ranked where rank <= 10
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_flat_graph": FLAT_GRAPH_SQL, "op12_pivot_distance_topk": TOP_K_SQL}
