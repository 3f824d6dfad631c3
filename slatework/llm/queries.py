"""One registered query per operator, over its whole table, and DuckDB SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slatework.llm import (
    decontaminate,
    extraction,
    fill_in_middle,
    language_id,
    licenses,
    ngram_lm,
    packing,
    secret_ledger,
    simhash,
    token_counts,
    topk_search,
    toxicity,
    whitening,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.digest(_table(spark, sf_dir, "documents"))


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.extract(_table(spark, sf_dir, "pages"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_table(spark, sf_dir, "documents"))


def op5_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    return topk_search.search(vectors, F.col("vec_id") % 50 == 0, k=5)


def op6_simhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_ledger.digest(_table(spark, sf_dir, "documents"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.predictions(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op9_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_lm.scores(_table(spark, sf_dir, "documents"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.predictions(_table(spark, sf_dir, "documents"))


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(_table(spark, sf_dir, "embeddings"))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle.digest(_table(spark, sf_dir, "documents"))


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(_table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    every = (
        op1_packing,
        op2_html_extraction,
        op3_decontamination,
        op4_license_scan,
        op5_topk_search,
        op6_simhash_near_duplicates,
        op7_secret_scan,
        op8_toxicity,
        op9_lm_scores,
        op10_language_id,
        op11_embedding_whitening,
        op12_fill_in_middle,
        op13_token_counts,
    )
    return {f.__name__: f for f in every}


_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

_OP3_SQL = f"""
with items as (select item_id, {_WORDS} as w from benchmark where item_id is not null),
windows as (
 select distinct item_id, n, array_to_string(list_slice(w, s, s + n - 1), ' ') as body
 from (select item_id, w, least(len(w), 13) as n, unnest(range(1, greatest(len(w) - 12, 1) + 1)) as s
       from items where len(w) > 0)),
docs as (select row_number() over () as uid, doc_id, {_WORDS} as w from documents),
spots as (
 select uid, w, n, unnest(range(1, len(w) - n + 2)) as s
 from docs, (select distinct n from windows) where len(w) >= n),
hits as (
 select uid, s, p.n, item_id
 from (select uid, s, n, array_to_string(list_slice(w, s, s + n - 1), ' ') as body from spots) p
 join windows on p.n = windows.n and p.body = windows.body),
covered as (
 select uid, count(distinct pos) as n_hit
 from (select uid, unnest(range(s, s + n)) as pos from (select distinct uid, s, n from hits)) group by uid),
found as (
 select uid, count(*) as n_items, string_agg(item, ',' order by item) as items
 from (select distinct uid, cast(item_id as varchar) as item from hits) group by uid)
select doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
 sha256(coalesce(items, '')) as items_sha256,
 coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
from docs left join covered using (uid) left join found using (uid)
"""

_OP5_SQL = """
with usable as (
 select row_number() over () as uid, vec_id,
  list_transform(embedding, lambda x: floor(256 * cast(x as double))) as v
 from embeddings
 where vec_id is not null and embedding is not null
  and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (
 select q.uid, q.vec_id as query_id, c.vec_id, cast(list_dot_product(q.v, c.v) as bigint) as score
 from usable q join usable c on q.uid <> c.uid where q.vec_id % 50 = 0),
ranked as (
 select *, row_number() over (partition by uid order by score desc, vec_id) as rank from scored)
select query_id, cast(rank as int) as rank, vec_id, score from ranked where rank <= 5
"""


def _op7_sql() -> str:
    parts = []
    for k, rule in enumerate(secret_ledger.RULES):
        pattern = rule.pattern.replace("'", "''")
        parts.append(
            f"""select uid, {k} as rule, unnest(range(1, len(gap) + 1)) as i, unnest(gap) as gap,
 unnest(list_concat(hit, [null])) as hit, unnest(list_concat(val, [null])) as val
from (select uid, string_split_regex(text, '{pattern}') as gap, regexp_extract_all(text, '{pattern}') as hit,
 regexp_extract_all(text, '{pattern}', {rule.group}) as val from docs where regexp_matches(text, '{pattern}'))"""
        )
    least = " ".join(f"when {k} then {rule.least}" for k, rule in enumerate(secret_ledger.RULES))
    names = " ".join(f"when {k} then '{rule.name}'" for k, rule in enumerate(secret_ledger.RULES))
    counts = ", ".join(f"count(*) filter (rule = {k}) as n_{r.name}" for k, r in enumerate(secret_ledger.RULES))
    every = ", ".join(f"coalesce(n_{r.name}, 0) as n_{r.name}" for r in secret_ledger.RULES)
    return f"""
with docs as (select row_number() over () as uid, doc_id, coalesce(text, '') as text from documents),
pieces as ({" union all ".join(parts)}),
placed as (
 select uid, rule, hit, val,
  sum(length(gap) + coalesce(length(hit), 0)) over (partition by uid, rule order by i) as stop from pieces),
found as (
 select uid, rule, cast(stop - length(hit) as bigint) as start, cast(stop as bigint) as stop
 from placed where hit is not null and length(val) >= case rule {least} end),
spans as (
 select uid, {counts},
  string_agg(concat(case rule {names} end, ':', start, ':', stop), ',' order by start, rule) as spans
 from found group by uid)
select doc_id, {every}, sha256(coalesce(spans, '')) as base_sha256, coalesce(spans, '') as spans
from docs left join spans using (uid)
"""


def _group(number: int) -> str:
    return f"cast(('0x' || substr(h, {8 * number + 1}, 8)) as ubigint)"


_OP12_SQL = f"""
with docs as (
 select doc_id, coalesce(text, '') as text, sha256(concat('1:', coalesce(cast(doc_id as varchar), ''))) as h
 from documents),
units as (
 select doc_id, text, regexp_extract_all(text, '[A-Za-z]+|[^A-Za-z]') as u,
  {_group(0)} as h1, {_group(1)} as h2, {_group(2)} as h3, {_group(3)} as h4 from docs),
ranks as (
 select doc_id, text, u, cast(len(u) as bigint) as n, h1 % (len(u) + 1) as a, h2 % (len(u) + 1) as b,
  case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or h3 % 100 >= 90
   then 'plain' when h4 % 100 < 20 then 'spm' else 'psm' end as form from units),
parts as (
 select doc_id, text, n, form, array_to_string(u[1:least(a, b)], '') as p,
  array_to_string(u[least(a, b) + 1:greatest(a, b)], '') as m, array_to_string(u[greatest(a, b) + 1:], '') as s
 from ranks)
select doc_id, n, form, case when form <> 'plain' then cast(length(p) as bigint) end as prefix_chars,
 case when form <> 'plain' then cast(length(m) as bigint) end as middle_chars,
 sha256(case form when 'plain' then text when 'psm' then concat('<P>', p, '<S>', s, '<M>', m)
  else concat('<S>', s, '<P>', p, '<M>', m) end) as output_sha256,
 sha256(text) as restored_sha256
from parts
"""


def oracle_sql() -> dict[str, str]:
    """Exact joins, products and patterns; the other queries hash, tokenise or learn and are tested in tests/llm."""
    return {
        "op3_decontamination": _OP3_SQL,
        "op5_topk_search": _OP5_SQL,
        "op7_secret_scan": _op7_sql(),
        "op12_fill_in_middle": _OP12_SQL,
    }
