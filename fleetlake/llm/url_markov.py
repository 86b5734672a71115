"""URL filter: host and path rules, and a character Markov ratio where no rule fits.

Two variable-order Markov models, of the URLs that rules allow and of those that they block,
give each character a probability after the three characters before it. Witten-Bell smoothing
mixes every order with the next lower one, down to equal chances. A URL's score is the mean log
ratio of both models per character; the threshold lies where both classes are as many standard
deviations away. All of it is DataFrame functions.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from fleetlake.llm.common import columns
from fleetlake.sources.scratch import materialised

ORDER = 3
# URLs are spelt in 32 symbols (letters, 0 for any digit, / . - ? and * for all others) after
# ORDER starts (^). So there are at most 33^4 grams, which bounds the table that is broadcast.
SYMBOLS = 32
_FROM = "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789_&=#"
_TO = "abcdefghijklmnopqrstuvwxyz0000000000-???"
_CHUNK = 256

Rules = list[tuple[str, str]]


def host(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z lower-cased; empty without ://."""
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(found, _FROM[:26], _TO[:26]), F.lit(""))


def path(url: Column) -> Column:
    """After the host up to ?, # or the end; empty without ://."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host_: Column, path_: Column, rules: Rules) -> Column:
    """The longest rule that fits: its host or a subdomain of it, and a path that starts alike."""
    tests = []
    for _, rule in sorted(rules, key=lambda r: (-len(r[1]), r[1])):
        name, slash, rest = rule.partition("/")
        same = (host_ == name) | host_.endswith(f".{name}")
        tests.append(F.when(same & path_.startswith(slash + rest), F.lit(rule)))
    return F.coalesce(*tests) if tests else F.lit(None).cast("string")


def verdict_of(rule: Column, rules: Rules) -> Column:
    return reduce(lambda c, r: c.when(rule == r[1], F.lit(r[0])), rules[1:],
                  F.when(rule == rules[0][1], F.lit(rules[0][0]))) if rules else F.lit(None).cast("string")


def grams(url: Column, order: int = ORDER) -> Column:
    """One string of ``order`` + 1 symbols for each character of ``url``; none for a null.

    Long URLs are cut into chunks that overlap by ``order``, since a substring walks from the
    start of its string.
    """
    spelt = F.regexp_replace(F.translate(url, _FROM, _TO), r"[^a-z0/.?-]", "*")
    spelt = F.concat(F.lit("^" * order), spelt)
    chunks = F.transform(
        F.sequence(F.lit(0), F.floor((F.length(spelt) - order - 1) / _CHUNK)),
        lambda c: F.substring(spelt, (c * _CHUNK + 1).cast("int"), F.lit(_CHUNK + order)))
    each = F.transform(chunks, lambda s: F.transform(
        F.sequence(F.lit(1), F.length(s) - order), lambda i: F.substring(s, i, F.lit(order + 1))))
    return F.when(F.length(url) > 0, F.flatten(each))


def _substring(text: str, start: int, length: int) -> Column:
    return F.substring(F.col(text), start, length)


def log_ratios(counts: DataFrame, order: int = ORDER) -> DataFrame:
    """(gram, ratio) from (gram, allow, block) counts: log P(last | first ones), allow over block.

    Each order's counts are sums of the next higher one's. Grams that neither model has seen are
    rows with zero counts.
    """
    found = counts.select("gram", *[F.lit(1.0 / SYMBOLS).alias(f"p_{c}") for c in ("allow", "block")])
    for k in range(order + 1):
        width = k + 1
        seen = (counts.groupBy(_substring("gram", order + 1 - k, width).alias("part"))
                .agg(F.sum("allow").alias("allow"), F.sum("block").alias("block")))
        before = seen.groupBy(F.expr(f"left(part, {k})").alias("context")).agg(*[
            f for c in ("allow", "block") for f in (
                F.sum(c).alias(f"n_{c}"), F.count_if(F.col(c) > 0).alias(f"kinds_{c}"))])
        stats = seen.join(before, F.expr(f"left(part, {k})") == F.col("context"))
        found = found.join(stats, _substring("gram", order + 1 - k, width) == F.col("part"))
        found = found.select("gram", *[
            F.when(F.col(f"n_{c}") > 0, (F.col(c) + F.col(f"kinds_{c}") * F.col(f"p_{c}"))
                   / (F.col(f"n_{c}") + F.col(f"kinds_{c}"))).otherwise(F.col(f"p_{c}")).alias(f"p_{c}")
            for c in ("allow", "block")])
    return found.select("gram", (F.ln("p_allow") - F.ln("p_block")).alias("ratio"))


def judge(pages: DataFrame, rules: Rules) -> DataFrame:
    """page_id, host, path, rule, verdict, score; one row per row of ``pages``.

    ``score`` is the mean log ratio less the threshold; null for a null or empty url. Without a
    rule the verdict is allow from 0 on, and where there is nothing to judge by: no characters,
    or no URL that a rule allows, or none that one blocks. Repeated rows each get a row; further columns are ignored; an
    empty table gives no rows. URLs of any length are read whole.
    """
    page = columns(pages, "page_id", "url")
    page = page.select("page_id", "url", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    page = page.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    page = page.withColumn("ruled", verdict_of(F.col("rule"), rules))
    # One row per url and gram; its count is combined before any shuffle.
    each = page.select("ruled", F.explode(grams(F.col("url"))).alias("gram"))
    counts = materialised(each.groupBy("gram").agg(
        *[F.count_if(F.col("ruled") == c).alias(c) for c in ("allow", "block")]), "url-grams")
    ratios = materialised(log_ratios(counts), "url-ratios")

    numbered = page.withColumn("_row", F.monotonically_increasing_id())
    rows = numbered.select(*numbered.columns, F.explode_outer(grams(F.col("url"))).alias("gram")).drop("url")
    # At most (SYMBOLS + 1) ** (ORDER + 1) rows, whatever the input.
    scored = (rows.join(F.broadcast(ratios), "gram", "left")
              .groupBy("_row", "page_id", "host", "path", "rule", "ruled")
              .agg(F.avg("ratio").alias("raw")))
    scored = materialised(scored.drop("_row"), "url-scores")
    fit = {r["ruled"]: r for r in scored.where("ruled is not null and raw is not null").groupBy("ruled").agg(
        F.avg("raw").alias("mean"), F.coalesce(F.stddev_samp("raw"), F.lit(0.0)).alias("sd")).collect()}
    if {"allow", "block"} <= set(fit):
        a, b = fit["allow"], fit["block"]
        spread = a["sd"] + b["sd"]
        cut = ((a["mean"] * b["sd"] + b["mean"] * a["sd"]) / spread if spread
               else (a["mean"] + b["mean"]) / 2)
        score = F.col("raw") - F.lit(cut)
    else:
        score = F.lit(None).cast("double")
    return scored.withColumn("score", score).select(
        "page_id", "host", "path", "rule",
        F.coalesce("ruled", F.when(F.col("score") < 0, F.lit("block")).otherwise(F.lit("allow")))
        .alias("verdict"), "score")
