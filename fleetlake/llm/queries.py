"""Registered queries of this package, one per operator, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from fleetlake.llm import (boundary_bpe, bpe_sql, flat_graph, jump_shards, pairwise_quality, positional_index,
                           prob_minhash, revisits, skip_chain, spectrum_whitening, tree_extract, url_markov,
                           zone_kmeans)

# The vocabulary files are parameters of the coders; these are the installed ones.
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def captures(pages: DataFrame) -> DataFrame:
    """Four crawls of every page, a day apart: full responses and revisits with varied validators.

    A digit of a hash decides: the first crawl and hashes from a on are full responses; revisits
    name the first crawl's tag (0-5), name it weakly (6, 7), give its date (8) or nothing (9).
    """
    return (pages.select("page_id", "url", F.length("html").alias("size"), F.md5("html").alias("payload"),
                         F.explode(F.sequence(F.lit(0), F.lit(3))).alias("r"))
            .selectExpr("*", "md5(concat(page_id, ':', r)) as h", "md5(concat(page_id, ':0')) as h0",
                        "1704067200 + page_id % 1000 * 60 as t0")
            .selectExpr("*", "r > 0 and left(h, 1) <= '9' as revisit", "left(h, 1) as k", "t0 + r * 86400 as ts")
            .selectExpr(
                "page_id * 4 + r as capture_id", "ts", "revisit",
                "case r when 1 then replace(url, '.example.', '.EXAMPLE.') when 2 then concat(url, '#later') "
                "else url end as url",
                """map_filter(case when revisit then map(
                     'date', string(ts), 'cache-control', 'max-age=600', 'connection', 'close',
                     'content-length', '0', 'last-modified', case k when '8' then string(t0) end,
                     'etag', case when k <= '5' then concat('"', substr(h0, 2, 8), '"')
                                  when k <= '7' then concat('W/"', substr(h0, 2, 8), '"') end)
                   else map('date', string(ts), 'cache-control', 'max-age=60', 'content-type', 'text/html',
                     'content-length', string(size), 'last-modified', string(ts),
                     'etag', concat('"', substr(h, 2, 8), '"')) end, (k, v) -> v is not null) as headers""",
                "case when not revisit then payload end as digest"))


@query
def op1_revisits(spark, sf_dir):
    found = revisits.resolve(captures(table(spark, sf_dir, "pages")))
    lines = F.transform(F.array_sort(F.map_entries("headers")),
                        lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return found.withColumn("headers", F.array_join(lines, ";"))


ORACLES["op1_revisits"] = r"""
with crawl as (
  select page_id, url, length(html) as size, md5(html) as payload, r,
         md5(page_id || ':' || r) as h, md5(page_id || ':0') as h0,
         1704067200 + page_id % 1000 * 60 as t0
  from pages, unnest([0, 1, 2, 3]) u(r)),
capture as (
  select page_id * 4 + r as capture_id, t0 + r * 86400 as ts, r > 0 and left(h, 1) <= '9' as revisit,
         left(h, 1) as k, size, payload, h, h0, t0,
         case r when 1 then replace(url, '.example.', '.EXAMPLE.') when 2 then url || '#later' else url end as url
  from crawl),
keyed as (
  select *, regexp_replace(lower(regexp_extract(url, '^https?://([^/?#]*)', 1)), '^www\.', '')
            || coalesce(nullif(regexp_extract(url, '^https?://[^/?#]*([^?#]*)', 1), ''), '/')
            || regexp_extract(url, '^[^?#]*(\?[^#]*)', 1) as url_key
  from capture),
based as (
  select *, last_value(case when not revisit then capture_id end ignore nulls) over (
              partition by url_key order by ts, capture_id
              rows between unbounded preceding and 1 preceding) as base_id
  from keyed),
judged as (
  select v.capture_id, v.url_key, v.ts, b.capture_id as base_id, b.ts as base_ts, b.size, b.payload,
         substr(b.h, 2, 8) as tag, substr(v.h0, 2, 8) as v_tag, b.ts as modified, v.k,
         case when b.capture_id is null then 'no-base'
              when v.k <= '7' then case when substr(b.h, 2, 8) = substr(v.h0, 2, 8) then 'etag' else 'mismatch' end
              when v.k = '8' then case when b.ts = v.t0 then 'last-modified' else 'mismatch' end
              else 'unverified' end as verdict
  from based v left join keyed b on b.capture_id = v.base_id and not b.revisit
  where v.revisit)
select capture_id, url_key, ts, base_id, base_ts, verdict,
       case when verdict in ('etag', 'last-modified') then
         'cache-control=max-age=600;content-length=' || size || ';content-type=text/html;date=' || ts
         || ';etag=' || case when k in ('6', '7') then 'W/' else '' end || '"' || tag || '"'
         || ';last-modified=' || modified end as headers,
       case when verdict in ('etag', 'last-modified') then payload end as digest
from judged
"""


@query
def op2_pairwise_quality(spark, sf_dir):
    scored = pairwise_quality.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted")


@query
def op3_jump_shards(spark, sf_dir):
    rows = jump_shards.assign(table(spark, sf_dir, "documents"), 24)
    return rows.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot",
                       "grown_shard")


@query
def op7_positional_index(spark, sf_dir):
    found = positional_index.contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))


URL_RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"),
             ("allow", "org/fr/")]


@query
def op4_url_markov(spark, sf_dir):
    judged = url_markov.judge(table(spark, sf_dir, "pages"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


ORACLES["op4_url_markov"] = """
with page as (
  select *, case when (host = 'example.net' or host like '%.example.net') and starts_with(path, '/en/')
                   then 'example.net/en/'
                 when (host = 'example.com' or host like '%.example.com') and starts_with(path, '/de/')
                   then 'example.com/de/'
                 when (host = 'org' or host like '%.org') and starts_with(path, '/fr/') then 'org/fr/'
                 when (host = 'net' or host like '%.net') and starts_with(path, '/') then 'net/' end as rule
  from (select page_id, row_number() over () as n, url,
               lower(regexp_extract(url, '://([^/?#]*)', 1)) as host,
               regexp_extract(url, '://[^/?#]*([^?#]*)', 1) as path,
               '^^^' || regexp_replace(translate(url, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789_&=#',
                 'abcdefghijklmnopqrstuvwxyz0000000000-???'), '[^a-z0/.?-]', '*', 'g') as spelt
        from pages)),
ruled as (select *, case when rule in ('example.net/en/', 'org/fr/') then 1 when rule is not null then 0 end as good
          from page),
gram as (select n, good, substr(spelt, i, 4) as g from ruled, unnest(range(1, length(spelt) - 2)) u(i)),
c3 as (select g, count(*) filter (good = 1) as a, count(*) filter (good = 0) as b from gram group by g),
c2 as (select right(g, 3) as g, sum(a) as a, sum(b) as b from c3 group by 1),
c1 as (select right(g, 2) as g, sum(a) as a, sum(b) as b from c3 group by 1),
c0 as (select right(g, 1) as g, sum(a) as a, sum(b) as b from c3 group by 1),
k3 as (select left(g, 3) as h, sum(a) as na, sum(b) as nb, count(*) filter (a > 0) as ka, count(*) filter (b > 0) as kb from c3 group by 1),
k2 as (select left(g, 2) as h, sum(a) as na, sum(b) as nb, count(*) filter (a > 0) as ka, count(*) filter (b > 0) as kb from c2 group by 1),
k1 as (select left(g, 1) as h, sum(a) as na, sum(b) as nb, count(*) filter (a > 0) as ka, count(*) filter (b > 0) as kb from c1 group by 1),
k0 as (select sum(a) as na, sum(b) as nb, count(*) filter (a > 0) as ka, count(*) filter (b > 0) as kb from c0),
p0 as (select g, case when na > 0 then (a + ka / 32.0::double) / (na + ka) else 1 / 32.0::double end as pa,
              case when nb > 0 then (b + kb / 32.0::double) / (nb + kb) else 1 / 32.0::double end as pb from c0, k0),
p1 as (select c1.g, case when na > 0 then (a + ka * pa) / (na + ka) else pa end as pa,
              case when nb > 0 then (b + kb * pb) / (nb + kb) else pb end as pb
       from c1 join k1 on left(c1.g, 1) = h join p0 on p0.g = right(c1.g, 1)),
p2 as (select c2.g, case when na > 0 then (a + ka * pa) / (na + ka) else pa end as pa,
              case when nb > 0 then (b + kb * pb) / (nb + kb) else pb end as pb
       from c2 join k2 on left(c2.g, 2) = h join p1 on p1.g = right(c2.g, 2)),
p3 as (select c3.g, case when na > 0 then (a + ka * pa) / (na + ka) else pa end as pa,
              case when nb > 0 then (b + kb * pb) / (nb + kb) else pb end as pb
       from c3 join k3 on left(c3.g, 3) = h join p2 on p2.g = right(c3.g, 3)),
score as (select n, any_value(good) as good, avg(ln(pa) - ln(pb)) as s from gram join p3 using (g) group by n),
fit as (select avg(s) filter (good = 1) as ma, stddev_samp(s) filter (good = 1) as sa,
               avg(s) filter (good = 0) as mb, stddev_samp(s) filter (good = 0) as sb from score)
select page_id, host, path, rule,
       case when ruled.good = 1 then 'allow' when ruled.good = 0 then 'block'
            when s < (ma * sb + mb * sa) / (sa + sb) then 'block' else 'allow' end as verdict
from ruled left join score using (n), fit
"""


@query
def op5_skip_chain(spark, sf_dir):
    found = skip_chain.detect(table(spark, sf_dir, "documents"))
    def of_kind(spans, kind):
        return F.filter(spans, lambda s: s["kind"] == kind)

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    every = F.concat("base", "added")
    in_order = F.flatten(F.array(*[F.array_sort(of_kind(every, k)) for k in skip_chain.KINDS]))
    counts = [F.size(of_kind("base", k)).cast("long").alias(f"n_{k}") for k in skip_chain.KINDS]
    return found.select("doc_id", *counts, F.sha2(joined("base"), 256).alias("base_sha256"),
                        joined(in_order).alias("spans"))


@query
def op6_tree_extract(spark, sf_dir):
    text = tree_extract.extract(table(spark, sf_dir, "pages"))
    return text.withColumn("n_chars", F.char_length("text").cast("long"))


@query
def op8_prob_minhash(spark, sf_dir):
    found = prob_minhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "group_id", "kept", "copies", "grouped")


@query
def op10_bpe_sql(spark, sf_dir):
    coded = bpe_sql.encode(table(spark, sf_dir, "documents"), RANKS, public_tokenizers.PATTERN)
    return coded.select(
        "doc_id", F.size("tokens").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("tokens").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op9_flat_graph(spark, sf_dir):
    return flat_graph.near_duplicates(table(spark, sf_dir, "embeddings"))


@query
def op11_zone_kmeans(spark, sf_dir):
    found = zone_kmeans.cluster(table(spark, sf_dir, "embeddings"))
    return found.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _kmeans_sql(k: int, rounds: int) -> str:
    """The rounds one after another; floor of a mean by the remainder that is not negative."""
    parts = ["""kept as materialized (
  select row_number() over () as n, vec_id, list_transform(embedding, lambda v: floor(256 * v::double)::bigint) as x
  from embeddings
  where len(embedding) = 64 and len(list_filter(embedding, lambda v: v is not null and isfinite(v))) = 64),
flat as materialized (select n, i, x[i] as v from kept, range(1, 65) t(i)),
c0 as materialized (
  select (row_number() over (order by sha256('2:' || vec_id) nulls last, x) - 1)::int as c, x as z
  from kept order by c limit """ + str(k) + ")"]
    for r in range(rounds + 1):
        parts.append(f"""near{r} as materialized (
  select n, c, d from (
    select n, c, list_sum(list_transform(list_zip(x, z), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::bigint as d
    from kept, c{r}) qualify row_number() over (partition by n order by d, c) = 1)""")
        if r < rounds:
            parts.append(f"""sums{r} as (
  select c, i, sum(v)::bigint as s, count(*) as m from near{r} join flat using (n) group by c, i),
c{r + 1} as materialized (
  select c, coalesce(g.z, c{r}.z) as z from c{r} left join (
    select c, list((s - (s % m + m) % m) // m order by i) as z from sums{r} group by c) g using (c))""")
    last = rounds
    return "with " + ",\n".join(parts) + f"""
select vec_id, c as cluster, d as distance, sum(d) over (partition by c)::bigint as cluster_inertia,
       sum(d) over ()::bigint as inertia, sha256(array_to_string(z, ',')) as centroid_sha256
from near{last} join kept using (n) join c{last} using (c)"""


ORACLES["op11_zone_kmeans"] = _kmeans_sql(40, 5)


@query
def op12_boundary_bpe(spark, sf_dir):
    coded = boundary_bpe.encode(table(spark, sf_dir, "documents"), WORDS)
    return coded.select("doc_id", "n_tokens", F.sha2("tokens", 256).alias("ids_sha256"),
                        F.sha2(F.encode("decoded", "utf-8"), 256).alias("decoded_sha256"))


@query
def op13_spectrum_whitening(spark, sf_dir):
    found = spectrum_whitening.whiten(table(spark, sf_dir, "embeddings"))
    return found.select("*", F.posexplode("whitened").alias("pos", "value")).select(
        "vec_id", (F.col("pos") + 1).alias("component"), "n", "deviation", F.col("value").alias("whitened"),
        F.col("explained")[F.col("pos")].alias("explained"), "identity_error")
