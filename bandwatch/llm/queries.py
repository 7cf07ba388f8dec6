"""Registered queries of this package and their comparison SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from bandwatch.llm.collocations import collocations
from bandwatch.llm.decontaminate import benchmark_passages
from bandwatch.llm.jaccard import jaccard_components
from bandwatch.llm.language import identify_languages
from bandwatch.llm.lines import dedup_lines
from bandwatch.llm.near_vectors import near_vectors
from bandwatch.llm.packing import pack
from bandwatch.llm.pii import personal_data
from bandwatch.llm.quality import document_quality
from bandwatch.llm.runs import periodic_runs
from bandwatch.llm.stage import lower_ascii_sql
from bandwatch.llm.token_files import read_token_files, write_token_files
from bandwatch.llm.token_lengths import token_counts
from bandwatch.llm.top_k import top_k

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def wrap(run):
        QUERIES[name] = run
        if sql:
            SQL[name] = sql
        return run

    return wrap


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


ASCII_SPACE_SQL = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


@query("op4_line_dedup", f"""
with cut as (select doc_id, string_split(coalesce(text, ''), chr(10)) as parts from documents),
lines as (select doc_id, unnest(parts) as line, unnest(range(len(parts))) as pos from cut),
keyed as (select doc_id, line, pos, {lower_ascii_sql(f"trim(line, {ASCII_SPACE_SQL})")} as k from lines),
hot as (select k, max(doc_id) as keep from keyed where length(k) >= 40 group by k having count(distinct doc_id) >= 5),
marked as (select l.*, h.keep is not null and l.doc_id <> h.keep as gone from keyed l left join hot h using (k))
select doc_id, count(*) as n_lines, count(*) filter (where gone) as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where not gone), '')) as kept_sha256
from marked group by doc_id
""")
def line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(table(spark, sf_dir, "documents"), digest=True)


@query("op3_token_files")
def token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_token_files(write_token_files(table(spark, sf_dir, "documents")), digest=True)


@query("op6_token_counts")
def token_count_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))


@query("op7_packing")
def packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), digest=True)


@query("op10_jaccard_join")
def jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))


@query("op8_language_id")
def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_languages(table(spark, sf_dir, "documents"))


@query("op5_pii")
def pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(table(spark, sf_dir, "documents")).drop("span_list")


@query("op9_decontamination")
def decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return benchmark_passages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op1_top_k", """
with v as (select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)) as q from embeddings
  where embedding is not null and vec_id is not null and list_count(embedding) = len(embedding)
    and len(list_filter(embedding, lambda x: not isfinite(x))) = 0),
scored as (select a.vec_id as query_id, b.vec_id, list_dot_product(a.q, b.q)::bigint as score
  from v a join v b on a.vec_id % 50 = 0 and a.vec_id <> b.vec_id and len(a.q) = len(b.q)),
ranked as (select *, row_number() over (partition by query_id order by score desc, vec_id)::integer as rank from scored)
select query_id, rank, vec_id, score from ranked where rank <= 5
""")
def nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"))


@query("op2_quality")
def quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op12_near_vectors", """
with recursive v as (select vec_id, embedding::double[] as e from embeddings
  where embedding is not null and vec_id is not null and list_count(embedding) = len(embedding)
    and len(list_filter(embedding, lambda x: not isfinite(x))) = 0 and len(list_filter(embedding, lambda x: x <> 0)) > 0),
links as (select a.vec_id as a, b.vec_id as b from v a join v b on a.vec_id <> b.vec_id and len(a.e) = len(b.e)
  where list_cosine_similarity(a.e, b.e) >= 0.9),
reach as (select a, b from links union select r.a, l.b from reach r join links l on r.b = l.a)
select e.vec_id, (select count(*) from links l where l.a = e.vec_id) as n_links,
  least(e.vec_id, coalesce((select min(b) from reach r where r.a = e.vec_id), e.vec_id)) as component_id,
  e.vec_id <= coalesce((select min(b) from reach r where r.a = e.vec_id), e.vec_id) as kept
from embeddings e
""")
def near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


@query("op13_collocations", f"""
with cut as (select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array({lower_ascii_sql("coalesce(text, '')")}, '[.,;:!?\\x0A-\\x0D]')) as piece
  from documents),
pieces as (select lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda w: w <> '') as w from cut),
totals as (select lang, sum(len(w))::hugeint as n from pieces group by lang),
grams as (select lang, k, list_slice(w, i, i + k - 1) as p from (select lang, w, k, unnest(range(1, len(w) - k + 2)) as i
  from pieces, (select unnest(range(1, 6)) as k))),
counts as (select lang, k, p, count(*) as f from grams group by all having count(*) >= 100),
cuts as (select lang, k, p, f, unnest(range(1, k)) as c from counts where k > 1),
made as (select x.lang, x.k, x.p, x.f as a, c, l.f as l, r.f as r, n, 1000::hugeint * x.f * n // (l.f::hugeint * r.f) as score
  from cuts x join counts l on l.lang = x.lang and l.p = list_slice(x.p, 1, c)
  join counts r on r.lang = x.lang and r.p = list_slice(x.p, c + 1, x.k) join totals t on t.lang = x.lang),
best as (select * from made qualify row_number() over (partition by lang, p order by score, c) = 1),
inner_parts as (select lang, list_slice(p, i, i + s - 1) as p, max(a) as longer from (
  select lang, p, a, s, unnest(range(1, k - s + 2)) as i from (select *, unnest(range(2, k)) as s from best where k > 2)) group by all),
kept as (select b.lang, array_to_string(b.p, ' ') as phrase, a, l, r, n, score from best b
  left join inner_parts i on i.lang = b.lang and i.p = b.p where longer is null or 100 * longer < 100 * a),
ranked as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from kept)
select lang, rank::bigint as rank, phrase, a::bigint as a, l::bigint as l, r::bigint as r, n::bigint as n, score::bigint as score
from ranked where rank <= 2000
""")
def phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


@query("op11_runs")
def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs(table(spark, sf_dir, "documents"), test_tails=True, digest=True)
