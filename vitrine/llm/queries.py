"""The training-data operators as queries over whole tables, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.llm import decontaminate, fingerprint, language_id, language_model, line_dedup, mixing, near_dedup, sharding, token_counts, url_filter
from vitrine.llm.common import fold, table


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_report(table(spark, sf_dir, "documents"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge_urls(pages, url_filter.rules_table(spark)).select("page_id", "host", "path", "rule", "verdict")


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"))


def op4_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.score(table(spark, sf_dir, "documents"), fold(F.col("doc_id"), 10) == 0)


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = fold(F.col("doc_id"), 4) == 2
    model = language_id.train(docs, ~held_out)
    return language_id.identify(docs, model, ("doc_id",)).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_dedup.near_duplicates(table(spark, sf_dir, "documents"), words=2, percent=80)
    return out.select("doc_id", "n_shingles", "component_id", "kept")


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sizes(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.shard(table(spark, sf_dir, "documents"), 8)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op9_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprint_edits(table(spark, sf_dir, "documents"))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per leaked pair of document and benchmark item."""
    out = decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "item_id", "n_windows", "item_windows", "exact")


QUERIES = {f.__name__: f for f in (op1_line_dedup, op2_url_filter, op3_token_counts, op4_lm_score, op5_language_id, op6_minhash, op7_mixing, op8_sharding, op9_fingerprint, op10_decontaminate)}

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"

ORACLE = {
    "op2_url_filter": f"""
        with parts as (
            select page_id, {_LOWER.format("coalesce(regexp_extract(rest, '^([^/?#]*)', 1, 's'), '')")} as host,
                   coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1, 's'), '') as path, row_number() over () as r
            from (select page_id, case when contains(url, '://') then substr(url, strpos(url, '://') + 3) end as rest from pages)
        ), rules(verdict, rh, rp) as (
            values ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')
        ), best as (
            select r, arg_max(rh || rp, length(rh || rp)) as rule, arg_max(verdict, length(rh || rp)) as verdict
            from parts join rules on (host = rh or ends_with(host, '.' || rh)) and starts_with(path, rp) group by r
        )
        select page_id, host, path, rule, coalesce(verdict, 'allow') as verdict from parts left join best using (r)""",
    "op6_minhash": f"""
        with recursive w as (
            select doc_id, {_WORDS.format(_LOWER.format("coalesce(text, '')"))} as l from documents
        ), s as (
            select distinct doc_id, unnest(case when len(l) > 1 then list_transform(range(1, len(l)), lambda i: l[i] || ' ' || l[i + 1]) else l end) as sh from w
        ), n as (select doc_id, count(*) as n from s group by 1),
        pairs as (select a.doc_id as a, b.doc_id as b, count(*) as k from s a join s b on a.sh = b.sh and a.doc_id < b.doc_id group by 1, 2),
        links as (select a, b from pairs join n x on a = x.doc_id join n y on b = y.doc_id where 100 * k >= 80 * (x.n + y.n - k)),
        reach(id, root) as (
            select doc_id, doc_id from w union
            select l.o, reach.root from reach join (select a as i, b as o from links union all select b, a from links) l on l.i = reach.id
        ), c as (select id, min(root) as component_id from reach group by 1)
        select w.doc_id, coalesce(n.n, 0)::bigint as n_shingles, c.component_id, w.doc_id = c.component_id as kept
        from w join c on c.id = w.doc_id left join n on n.doc_id = w.doc_id""",
    "op7_mixing": f"""
        with d as (
            select doc_id, source, coalesce(len({_WORDS.format("text")}), 0)::bigint as size,
                   ('0x' || substr(md5(concat('mix:', coalesce(doc_id::varchar, '-'), ':', md5(coalesce(text, '')))), 1, 15))::bigint as h from documents
        ), s as (
            select *, 3 * source_size as cap, sum(source_size) over () as total, sum(weight) over () as weights from (
                select source, sum(size)::bigint as source_size, [5, 2, 1][1 + ((row_number() over (order by source nulls last)) - 1) % 3] as weight from d group by source)
        ), f as (
            select *, coalesce(sum(cap) over p, 0) as cap_before, coalesce(sum(weight) over p, 0) as weight_before from s
            window p as (order by cap / weight, source nulls last rows between unbounded preceding and 1 preceding)
        ), g as (select *, cap * (weights - weight_before) <= (total - cap_before) * weight as capped from f),
        t as (
            select source, source_size, case when capped then cap::double
                else (total - coalesce(sum(cap) filter (capped) over (), 0))::double / (weights - coalesce(sum(weight) filter (capped) over (), 0))::double * weight::double end as target from g
        ), b as (select *, case when source_size > 0 then floor(target / source_size)::bigint else 0 end as copies from t),
        r as (
            select d.*, source_size, target, copies, target - copies * source_size as budget,
                   sum(size) over (partition by d.source order by h range between unbounded preceding and current row) as upto,
                   sum(size) over (partition by d.source, h) as here
            from d join b on d.source is not distinct from b.source
        ), e as (select *, min(case when upto > budget then h end) over (partition by source) as edge from r)
        select doc_id, size, source_size, target,
               (size * (copies + case when h < edge or (h = edge and upto - budget < budget - (upto - here)) then 1 else 0 end))::bigint as taken from e""",
}
