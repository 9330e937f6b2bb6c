"""The numbered queries: each applies its operator to its whole table.

``QUERIES`` and ``ORACLE`` have the form of the library's registry.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from paperloom.llm.decontaminate import find_leaks
from paperloom.llm.exact_dedup import exact_groups
from paperloom.llm.filter_audit import audit_filters
from paperloom.llm.html_text import extract_text
from paperloom.llm.language_id import identify
from paperloom.llm.mixing import mix_sources
from paperloom.llm.near_dedup import near_duplicates
from paperloom.llm.prefix_forest import nearest
from paperloom.llm.repeats import repeated_spans
from paperloom.llm.suffix_tree_lm import score_texts
from paperloom.llm.surrogates import replace_entities
from paperloom.llm.token_alignment import align_tokens
from paperloom.llm.token_counts import token_counts


def _table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mix_sources(spark, sf_dir):
    return mix_sources(_table(spark, sf_dir, "documents"), max_repeats=1.25)


def op2_decontaminate(spark, sf_dir):
    return find_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op3_suffix_dedup(spark, sf_dir):
    return repeated_spans(_table(spark, sf_dir, "documents")).drop("kept")


def op4_exact_dedup(spark, sf_dir):
    return exact_groups(_table(spark, sf_dir, "documents"))


def op5_ngram_jaccard(spark, sf_dir):
    return near_duplicates(_table(spark, sf_dir, "documents"))


def op6_lm_score(spark, sf_dir):
    return score_texts(_table(spark, sf_dir, "documents"))


def op7_surrogates(spark, sf_dir):
    return replace_entities(_table(spark, sf_dir, "documents")).withColumn("kinds", F.array_join("kinds", ","))


def op8_language_id(spark, sf_dir):
    return identify(_table(spark, sf_dir, "documents"))


def op9_token_counts(spark, sf_dir):
    return token_counts(_table(spark, sf_dir, "documents"))


def op10_main_text(spark, sf_dir):
    return extract_text(_table(spark, sf_dir, "pages"))


def op11_filter_audit(spark, sf_dir):
    return audit_filters(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op12_nearest(spark, sf_dir):
    return nearest(_table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)


def op13_token_alignment(spark, sf_dir):
    return align_tokens(_table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_mix_sources, op2_decontaminate, op3_suffix_dedup, op4_exact_dedup, op5_ngram_jaccard,
        op6_lm_score, op7_surrogates, op8_language_id, op9_token_counts, op10_main_text,
        op11_filter_audit, op12_nearest, op13_token_alignment,
    )
}

ORACLE = {
    "op4_exact_dedup": """
      select doc_id, max(doc_id) over same as keep_id, count(*) over same as group_size,
        doc_id = max(doc_id) over same as kept, sha256(coalesce(text, '')) as text_sha256
      from documents window same as (partition by coalesce(text, ''))""",
    # Each document leaves at the first filter of an order that it fails; shapley adds up all orders.
    "op11_filter_audit": r"""
      with texts as (
        select doc_id, coalesce(source, '') as part, coalesce(text, '') as t,
          list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') as words,
          doc_id > min(doc_id) over (partition by coalesce(text, '')) as again
        from documents),
      judged as (
        select part, coalesce(quality = 1, false) as good, coalesce(toxic = 1, false) as bad,
          {'A': len(words) < 50, 'B': 100 * len(list_distinct(words)) < 65 * len(words),
           'C': 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 5 * length(t),
           'D': regexp_matches(t, '[#$%&*|]'), 'E': again} as f
        from texts left join labels using (doc_id)),
      letters as (select unnest(['A', 'B', 'C', 'D', 'E']) as x),
      orders as (
        select a.x || b.x || c.x || d.x || e.x as filter_order
        from letters a, letters b, letters c, letters d, letters e
        where len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
      steps as (select filter_order, unnest([1, 2, 3, 4, 5]) as step from orders),
      failing as (
        select part, good, bad, concat(case when f.A then 'A' else '' end, case when f.B then 'B' else '' end,
          case when f.C then 'C' else '' end, case when f.D then 'D' else '' end, case when f.E then 'E' else '' end) as fails
        from judged),
      sets as (select part, fails, count(*) as n, count_if(good) as good, count_if(bad) as bad from failing group by all),
      leaving as (
        select part, fails, n, good, bad, filter_order, step, filter_order[step] as letter,
          contains(fails, filter_order[step]) as fails_here,
          len(list_filter(range(1, step), lambda k: contains(fails, filter_order[k]))) > 0 as gone
        from sets, steps),
      counted as (
        select part, filter_order, step, any_value(letter) as letter,
          sum(case when gone or fails_here then 0 else n end)::bigint as kept,
          sum(case when fails_here and not gone then n else 0 end)::bigint as removed,
          sum(case when fails_here and gone then n else 0 end)::bigint as redundant,
          sum(case when fails = letter then n else 0 end)::bigint as unique_fails,
          sum(case when fails_here and not gone then good else 0 end)::bigint as good_lost,
          sum(case when fails_here and not gone then bad else 0 end)::bigint as toxic_lost
        from leaving group by part, filter_order, step)
      select part, filter_order, step::int as step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
        sum(removed) over (partition by part, letter)::bigint as shapley
      from counted""",
}
