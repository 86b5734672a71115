"""Web archive revisits that say "not modified", resolved to the response they stand for.

A revisit is joined as of its time to the latest earlier full response with the same canonical
URL. Its validators are checked against that response, and the header fields that such an
answer may renew are merged into the stored ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from fleetlake.llm.common import columns
from fleetlake.sources.scratch import materialised

# Header fields that a "not modified" answer carries for renewal (HTTP semantics).
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "vary")


def canonical_url(url: Column) -> Column:
    """Host in lower case without user, www. and default port; path (at least /) and query.

    Scheme and fragment go. A url without :// has no canonical form (null).
    """
    whole = r"(?s)^([A-Za-z][A-Za-z0-9+.-]*)://(?:[^/?#@]*@)?([^/?#]*)([^?#]*)(\?[^#]*)?"
    scheme = F.lower(F.regexp_extract(url, whole, 1))
    name = F.regexp_replace(F.lower(F.regexp_extract(url, whole, 2)), r"^www\.", "")
    name = F.when(scheme == "http", F.regexp_replace(name, ":80$", "")).when(
        scheme == "https", F.regexp_replace(name, ":443$", "")).otherwise(name)
    rest = F.regexp_extract(url, whole, 3)
    rest = F.when(rest == "", F.lit("/")).otherwise(rest)
    return F.when(scheme != "", F.concat(name, rest, F.regexp_extract(url, whole, 4)))


def opaque_tag(etag: Column) -> Column:
    """An entity tag without its weakness mark: validation compares weakly."""
    return F.regexp_replace(F.trim(etag), r"^[Ww]/", "")


def resolve(captures: DataFrame) -> DataFrame:
    """One row per revisit: capture_id, url_key, ts, base_id, base_ts, verdict, headers, digest.

    ``captures`` has capture_id, url, ts (seconds), revisit (boolean; null: a full response),
    headers (map of lower-case names) and digest (of the payload). "Earlier" is a smaller ts, or
    the same ts and a smaller capture_id. ``verdict``: ``etag`` or ``last-modified`` (the
    validator that agrees; a tag decides where the revisit has one), ``mismatch``,
    ``unverified`` (the revisit has no validator), ``no-base``. Only the first two give headers
    and digest. A revisit without canonical url, ts or capture_id has no base, and a response
    without them is none. Null headers count as empty. Repeated revisits each get a row; of
    repeated responses any may be the base, being equal. Other columns are ignored.

    A single URL may hold most rows. Rows are therefore spread by ranges of (url, ts, id), so that
    a URL runs over many partitions; the latest response is first sought within a partition, and
    a small table of the last response of each (url, partition) carries it on to the next ones.
    """
    body = F.struct("capture_id", "ts", "headers", "digest")
    rows = columns(captures, "capture_id", "url", "ts", "revisit", "headers", "digest")
    rows = rows.select(
        "capture_id", canonical_url(F.col("url")).alias("url_key"), "ts",
        F.coalesce("revisit", F.lit(False)).alias("revisit"),
        F.coalesce("headers", F.create_map().cast("map<string,string>")).alias("headers"), "digest")
    usable = F.col("url_key").isNotNull() & F.col("ts").isNotNull() & F.col("capture_id").isNotNull()
    # Written: range bounds are sampled, and two evaluations could cut elsewhere.
    ranged = materialised(
        rows.where(usable | F.col("revisit")).repartitionByRange("url_key", "ts", "capture_id")
        .withColumn("part", F.spark_partition_id())
        .withColumn("full", F.when(~F.col("revisit"), body)).drop("digest"), "revisits")

    ends = ranged.where("url_key is not null").groupBy("url_key", "part").agg(
        F.max_by(F.col("full"), F.when(F.col("full").isNotNull(), F.struct("ts", "capture_id"))).alias("end"))
    spread = ends.groupBy("url_key").agg(F.count(F.lit(1)).alias("parts")).where("parts > 1")
    # A partition shares URLs with its neighbours only: at most two rows per partition.
    carried = ends.join(F.broadcast(spread.select("url_key")), "url_key").select(
        "url_key", "part", F.expr("last(end) ignore nulls over (partition by url_key order by part "
                                  "rows between unbounded preceding and 1 preceding)").alias("carried"))
    near = ranged.withColumn("near", F.expr(
        "last(full) ignore nulls over (partition by part, url_key order by ts, capture_id "
        "rows between unbounded preceding and 1 preceding)")).where("revisit")
    based = (near.join(F.broadcast(carried), ["url_key", "part"], "left")
             .withColumn("base", F.when(usable, F.coalesce("near", "carried"))))

    def field(of: str, name: str) -> Column:
        return F.try_element_at(F.col(of), F.lit(name))

    tag, since = field("headers", "etag"), field("headers", "last-modified")
    verdict = (F.when(F.col("base").isNull(), "no-base")
               .when(tag.isNotNull(), F.when(
                   F.coalesce(opaque_tag(tag) == opaque_tag(field("base.headers", "etag")), F.lit(False)), "etag")
                     .otherwise("mismatch"))
               .when(since.isNotNull(), F.when(
                   F.coalesce(since == field("base.headers", "last-modified"), F.lit(False)), "last-modified")
                     .otherwise("mismatch"))
               .otherwise("unverified"))
    good = F.col("verdict").isin("etag", "last-modified")
    renewed = F.map_filter("headers", lambda k, _: k.isin(*PERMITTED))
    kept = F.map_filter("base.headers", lambda k, _: ~F.map_contains_key(F.col("renewed"), k))
    return (based.withColumn("verdict", verdict).withColumn("renewed", renewed)
            .select("capture_id", "url_key", "ts", F.col("base.capture_id").alias("base_id"),
                    F.col("base.ts").alias("base_ts"), "verdict",
                    F.when(good, F.map_concat(kept, "renewed")).alias("headers"),
                    F.when(good, F.col("base.digest")).alias("digest")))
