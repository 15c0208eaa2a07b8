"""Registered queries of the corpus operators, with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from encore.llm import (
    centroids,
    decontamination,
    extraction,
    impact_search,
    language,
    line_templates,
    merkle,
    mixing,
    ngram_join,
    quality,
    sentence_spans,
    sharding,
    url_filter,
)
from encore.llm.shared import table
from encore.llm.sql import kmeans_sql, merkle_sql, top_products_sql


def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.linked_components(table(spark, sf_dir, "documents"), n=3, similarity=90)


def op1_histogram_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"))


def op2_output_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


def op3_line_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.extract(table(spark, sf_dir, "pages"))


def op4_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed_sizes(table(spark, sf_dir, "documents"))


def op6_path_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))


def op7_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentence_spans.remove_repeats(table(spark, sf_dir, "documents"))


def op8_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_templates.dropped_lines(table(spark, sf_dir, "documents"))


def op9_sampled_splitters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.balanced_shards(table(spark, sf_dir, "documents"))


def op10_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


def op11_slot_pivot_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.audit(table(spark, sf_dir, "documents"), merkle.without_line_breaks())


def op12_vantage_point_kmeans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster_report(table(spark, sf_dir, "embeddings"))


def op13_impact_ordered_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return impact_search.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        op1_histogram_divergence,
        op2_output_codes,
        op3_line_blocks,
        op4_source_mix,
        op5_ngram_jaccard_join,
        op6_path_templates,
        op7_sentence_spans,
        op8_line_templates,
        op9_sampled_splitters,
        op10_winnowing,
        op11_slot_pivot_manifest,
        op12_vantage_point_kmeans,
        op13_impact_ordered_topk,
    )
}
SQL: dict[str, str] = {
    "op11_slot_pivot_manifest": merkle_sql(),
    "op12_vantage_point_kmeans": kmeans_sql(),
    "op13_impact_ordered_topk": top_products_sql(),
    "op10_winnowing": r"""
with d as (
  select row_number() over () as r, doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') as w
  from documents),
i as (
  select item_id, w, least(13, len(w)) as n from (
    select cast(item_id as varchar) as item_id, list_filter(string_split_regex(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') as w
    from benchmark) where len(w) > 0),
iw as (
  select distinct item_id, n, array_to_string(w[p : p + n - 1], ' ') as key
  from (select item_id, w, n, unnest(range(1, len(w) - n + 2)) as p from i)),
dw as (
  select r, n, p, array_to_string(w[p : p + n - 1], ' ') as key
  from (select r, w, n, unnest(range(1, len(w) - n + 2)) as p
        from d, (select distinct n from i) where len(w) >= n)),
hits as (select r, p, iw.n, item_id from dw join iw on dw.n = iw.n and dw.key = iw.key),
words as (select r, count(distinct q) as n_hit
          from (select r, unnest(range(p, p + n)) as q from hits) group by r),
items as (select r, count(distinct item_id) as n_items,
            string_agg(distinct item_id, ',' order by item_id) as names from hits group by r)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit,
  coalesce(n_items, 0) as n_items, sha256(coalesce(names, '')) as items_sha256,
  coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
from d left join words using (r) left join items using (r)
""",
}
