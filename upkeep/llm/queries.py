"""The registered queries ``opN_<name>`` and ``pipeline``: each applies its operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from upkeep.llm import (
    decontaminate,
    language,
    licenses,
    neighbours,
    ngram_join,
    packing,
    periodic_runs,
    quality,
    ranked_search,
    span_dedup,
    token_counts,
    toxicity,
    url_filter,
)
from upkeep.llm.common import read_table


def op1_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(read_table(spark, sf_dir, "documents"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(read_table(spark, sf_dir, "documents"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    rules = spark.createDataFrame(url_filter.RULES, "verdict string, host string, path string")
    found = url_filter.filter_urls(pages, rules, url_filter.unsafe_hosts(pages))
    return found.select("page_id", "host", "path", "rule", "verdict")


def op6_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(read_table(spark, sf_dir, "embeddings"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    trees = quality.fit_quality(docs, read_table(spark, sf_dir, "labels"))
    scored = quality.quality_scores(docs, trees)
    return scored.select("doc_id", F.coalesce(quality.held_out(), F.lit(False)).alias("held_out"), "score", "predicted")


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    found = language.identify(docs, language.fit_language(docs))
    return found.select("doc_id", language.held_out().alias("held_out"), "lang_pred", "score", "rejected")


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = span_dedup.span_report(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = toxicity.fit_toxicity(docs, read_table(spark, sf_dir, "labels"))
    scored = toxicity.toxicity_scores(docs, model)
    return scored.select("doc_id", toxicity.held_out().alias("held_out"), "score", "predicted")


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    found = periodic_runs.periodic_runs(docs, order=periodic_runs.echoing_tail)
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select(
        "doc_id",
        "n_runs",
        "start",
        "length",
        "period",
        "exponent_milli",
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


NGRAM_JOIN_SQL = """
with recursive words as (
  select doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x20\\x09-\\x0D]+') as w
  from documents
), shingles as (
  select distinct doc_id, unnest(list_transform(range(greatest(len(w) - 4, 1)), lambda i: array_to_string(w[i + 1 : i + 5], ' '))) as shingle
  from words where len(w) > 0
), sized as (
  select doc_id, count(*) as n from shingles group by doc_id
), shared as (
  select a.doc_id as a, b.doc_id as b, count(*) as c
  from shingles a join shingles b on a.shingle = b.shingle and a.doc_id < b.doc_id group by all
), links as (
  select a, b from shared join sized x on x.doc_id = a join sized y on y.doc_id = b where 100 * c >= 80 * (x.n + y.n - c)
), edges as (
  select a, b from links union all select b, a from links
), reach as (
  select doc_id as doc, doc_id as other from documents
  union
  select reach.doc, edges.b from reach join edges on edges.a = reach.other
)
select d.doc_id, coalesce(s.n, 0) as n_shingles, c.component_id
from documents d left join sized s using (doc_id)
join (select doc as doc_id, min(other) as component_id from reach group by doc) c using (doc_id)
"""

DECONTAMINATION_SQL = """
with doc_words as (
  select doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w
  from documents
), item_words as (
  select item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w
  from benchmark
), windows as (
  select distinct item_id, least(len(w), 10) as size,
    unnest(list_transform(range(greatest(len(w) - 9, 1)), lambda i: array_to_string(w[i + 1 : i + 10], ' '))) as words
  from item_words where len(w) > 0
), sizes as (
  select distinct size from windows
), places as (
  select doc_id, size, unnest(range(len(w) - size + 1)) as place, w from doc_words, sizes where len(w) >= size
), found as (
  select p.doc_id, p.place, p.size, v.item_id
  from (select doc_id, place, size, array_to_string(w[place + 1 : place + size], ' ') as words from places) p join windows v using (size, words)
), hit as (
  select doc_id, count(distinct word) as n_hit from (select doc_id, unnest(range(place, place + size)) as word from found) group by doc_id
), items as (
  select doc_id, count(*) as n_items, string_agg(item_id, ',' order by item_id) as ids
  from (select distinct doc_id, cast(item_id as varchar) as item_id from found) group by doc_id
)
select doc_id, cast(coalesce(len(w), 0) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from doc_words left join hit using (doc_id) left join items using (doc_id)
"""

SUFFIX_DEDUP_SQL = """
with hexed as (
  select doc_id, coalesce(hex(encode(text)), '') as h from documents
), spans as (
  select doc_id, start, substr(h, 2 * start + 1, 200) as bytes
  from (select doc_id, h, unnest(range(len(h) // 2 - 99)) as start from hexed where len(h) >= 200)
), ranked as (
  select doc_id, start, row_number() over (partition by bytes order by doc_id, start) as place from spans
), runs as (
  select doc_id, start, sum(fresh) over (partition by doc_id order by start) as run
  from (
    select doc_id, start, case when start <= lag(start) over (partition by doc_id order by start) + 100 then 0 else 1 end as fresh
    from ranked where place > 1
  )
), cuts as (
  select doc_id, min(start) as s, max(start) + 100 as e from runs group by doc_id, run
), pieces as (
  select doc_id, s, e, coalesce(lag(e) over (partition by doc_id order by s), 0) as before from cuts
), kept as (
  select doc_id, count(*) as n_spans, sum(e - s) as n_removed, max(e) as last,
    string_agg(substr(h, 2 * before + 1, 2 * (s - before)), '' order by s) as head
  from pieces join hexed using (doc_id) group by doc_id
)
select doc_id, cast(len(h) // 2 as bigint) as n_bytes, cast(coalesce(n_removed, 0) as bigint) as n_removed, coalesce(n_spans, 0) as n_spans,
  sha256(unhex(coalesce(head, '') || substr(h, 2 * coalesce(last, 0) + 1))) as kept_sha256
from hexed left join kept using (doc_id)
"""

RANKED_SEARCH_SQL = """
with words as (
  select row_number() over () as row_id, doc_id,
    regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') as terms
  from documents
), sized as (
  select row_id, doc_id, cast(len(terms) as bigint) as n, terms from words where len(terms) > 0
), corpus as (
  select count(*) as documents, cast(sum(n) as bigint) as total from sized
), asked as (
  select distinct item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) as term
  from benchmark where item_id is not null
), places as (
  select row_id, term, count(*) as tf
  from (select row_id, unnest(terms) as term from sized) where term in (select term from asked) group by row_id, term
), weights as (
  select term, cast(floor(1000 * ln((2 * documents + 2)::double / (2 * count(*) + 1)::double)) as bigint) as w
  from places, corpus group by term, documents
), found as (
  select a.item_id, s.doc_id, s.row_id,
    cast(sum(w.w * ((1000000000 * p.tf) // (1000 * p.tf + 8 * (10 + (90 * s.n * c.documents) // c.total)))) as bigint) as score
  from asked a join places p using (term) join weights w using (term) join sized s using (row_id), corpus c
  group by a.item_id, s.doc_id, s.row_id
)
select item_id, cast(rank as integer) as rank, doc_id, score
from (
  select *, row_number() over (partition by item_id order by score desc, doc_id asc nulls last, row_id) as rank
  from found where score > 0
)
where rank <= 10
"""

URL_FILTER_SQL = """
with parts as (
  select page_id,
    case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end as rest
  from pages
), split as (
  select page_id, regexp_extract(rest, '^[^/?#]*') as raw, rest from parts
), named as (
  select page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') as path
  from split
), judged as (
  select *,
    case
      when (host = 'example.org' or host like '%.example.org') and path like '/en/1%' then 'example.org/en/1'
      when (host = 'example.org' or host like '%.example.org') and path like '/es/%' then 'example.org/es/'
      when (host = 'com' or host like '%.com') and path like '/fr/%' then 'com/fr/'
      when (host = 'com' or host like '%.com') and path like '/de/%' then 'com/de/'
      when (host = 'org' or host like '%.org') and path like '/%' then 'org/'
    end as rule,
    (select min(h.host) from named h
     where (named.host = h.host or ends_with(named.host, '.' || h.host))
       and list_has_any(regexp_split_to_array(h.host, '[.-]'),
         ['ads', 'adult', 'bets', 'casino', 'malware', 'phishing', 'pills', 'poker', 'porn', 'spam', 'viagra', 'xxx'])
    ) is not null as listed
  from named
)
select page_id, host, path, rule,
  case when rule in ('org/', 'com/fr/') then 'allow' when rule is not null or listed then 'block' else 'allow' end as verdict
from judged
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_licenses": op1_licenses,
        "op2_packing": op2_packing,
        "op3_ngram_join": op3_ngram_join,
        "op4_decontamination": op4_decontamination,
        "op5_url_filter": op5_url_filter,
        "op6_neighbours": op6_neighbours,
        "op7_quality": op7_quality,
        "op8_language": op8_language,
        "op9_suffix_dedup": op9_suffix_dedup,
        "op10_token_counts": op10_token_counts,
        "op11_toxicity": op11_toxicity,
        "op12_ranked_search": op12_ranked_search,
        "op13_periodic_runs": op13_periodic_runs,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op3_ngram_join": NGRAM_JOIN_SQL,
        "op4_decontamination": DECONTAMINATION_SQL,
        "op5_url_filter": URL_FILTER_SQL,
        "op9_suffix_dedup": SUFFIX_DEDUP_SQL,
        "op12_ranked_search": RANKED_SEARCH_SQL,
    }
