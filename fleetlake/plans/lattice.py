"""Many groupings of the measures from one pass over each fact.

A fact is scanned once, into a state: per combination of the keys of all wanted contexts, the parts that
merge (sums, counts) and, for distinct counts, bitmaps over dense keys. Every context gets a node of its
own keys, made from the smallest node that holds them. Sums add up, bitmaps are united, so each context
is exact.

The keys are what contexts group by (make, month), looked up in the scan, not the ids and days these
follow from: a fact has about one row per truck, driver and day, so a state by them is the fact again.
Only an attribute at the date of the event is met by groups of its id and day.

A bitmap is cut into words of 64 keys and only words with a bit are kept. A group of one row costs one
word, so a state never has more rows than the fact has, once per kind, however fine its keys are. Ids whose
attributes are keys are numbered in the order of these: the ids of a word share them, so words stay full.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from fleetlake import registry
from fleetlake.functions.text import month_start
from fleetlake.operators.joins import lookup_join
from fleetlake.operators.surrogate import dense_key
from fleetlake.plans import measures as m
from fleetlake.sources.scratch import materialised

# Dense key of an id whose distinct values are counted: dimension, its id, its key.
DENSE = {"truck_id": ("dim_truck", "truck_id", "truck_sk"), "driver_id": ("dim_driver", "driver_id", "driver_sk")}
DAY = "_day"
_SUM = ""
# Dense keys in one word of a bitmap: the bits of a long. A bucket is named by its least key.
WORD = 64


@dataclass
class Node:
    """A state grouped by ``keys``, written once."""

    keys: frozenset[str]
    rows: DataFrame
    size: int


def _parts(name: str) -> dict[str, Column]:
    """Aggregates that merge by addition, by column name."""
    base = m.MEASURES[name]
    if base.kind == "avg":
        return {f"{name}_sum": F.sum(F.col(base.column).cast("double")), f"{name}_n": F.count(base.column)}
    return {name: base.build()}


def _finished(name: str) -> Column:
    if m.MEASURES[name].kind == "avg":
        return F.try_divide(F.col(f"{name}_sum"), F.col(f"{name}_n"))
    return F.col(name)


def _keys(fact: str, context: m.Context) -> dict[str, tuple]:
    """What a context's node is grouped by: name and (table, column or function of the day). The table is
    a dimension, DAY or, for the fact's own columns, empty."""
    keys: dict[str, tuple] = {name: (DAY, period) for name, period in context.periods.items()}
    for name, (dim, column) in context.attributes.items():
        if name in context.at_event:
            key = registry.relationship(fact, dim).fact_key
            keys |= {key: ("", key), DAY: (DAY, None)}
        else:
            keys[name] = (dim, column)
    return keys | {c: ("", c) for c in context.columns}


def dense_ids(dims: dict[str, DataFrame], column: str) -> DataFrame:
    """(id, position): one dense key per id; of a dimension with history, the least of its versions."""
    dim, key, sk = DENSE[column]
    return dims[dim].groupBy(F.col(key).alias("_id")).agg(F.min(sk).alias("_position"))


def _keyed(name: str, fact: DataFrame, keys: dict[str, tuple], positions: dict[str, str],
           dims: dict[str, DataFrame], date_column: str | None, keys_from: DataFrame | None) -> DataFrame:
    """The fact with its keys and, per counted column, the dense key of its id. A dimension that gives
    both is met once."""
    rows = fact
    if any(table == DAY for table, _ in keys.values()):
        rows = rows.withColumn(DAY, F.to_date(date_column or m.DATE_COLUMN[name]))
    for key, (table, by) in keys.items():
        if table == "" and by != key:
            rows = rows.withColumn(key, F.col(by))
        elif table == DAY and key != DAY:
            rows = rows.withColumn(key, by(F.col(DAY)) if by else F.col(DAY))
    lookups = {}
    for dim in dict.fromkeys(table for table, _ in keys.values() if table not in ("", DAY)):
        link = registry.relationship(name, dim)
        attributes = {key: by for key, (table, by) in keys.items() if table == dim}
        found = m.one_per_key(dims[dim], dim, link.dim_key, attributes)
        position = positions.get(link.fact_key)
        if position and DENSE[link.fact_key][:2] == (dim, link.dim_key):
            found = dense_key(found, [*attributes, "_ctx_key"], position)
        lookups.setdefault(link.fact_key, []).append(found.withColumnRenamed("_ctx_key", link.fact_key))
    for column, position in positions.items():
        if not any(position in found.columns for found in lookups.get(column, [])):
            ids = dense_ids(dims, column).withColumnsRenamed({"_id": column, "_position": position})
            lookups.setdefault(column, []).append(ids)
    for column, several in lookups.items():
        for found in several:
            rows = lookup_join(rows, found, on=[column], keys_from=(fact if keys_from is None else keys_from).select(column))
    return rows


def states(name: str, fact: DataFrame, keys: frozenset[str] | dict[str, tuple], bases: list[str],
           dims: dict[str, DataFrame], date_column: str | None = None,
           keys_from: DataFrame | None = None) -> DataFrame:
    """The state of a fact by ``keys`` (its columns and DAY, or keys as ``_keys`` gives them): rows of
    ``_kind`` '' carry the additive parts, those of a column's name its distinct values: a word of bits
    per ``_bucket`` of dense keys, and strays (ids without a dense key, null among them) one by one.

    A fact row is grouped once for the sums and once for every counted column, in one scan. ``keys_from``
    is a cheaper source of the fact's ids for finding hot ones, as a fact may be a join.
    """
    if not isinstance(keys, dict):
        keys = {k: (DAY, None) if k == DAY else ("", k) for k in keys}
    counted = [b for b in bases if m.MEASURES[b].kind == "values"]
    added = [b for b in bases if m.MEASURES[b].kind != "values"]
    columns = {m.MEASURES[b].column: f"_p{i}" for i, b in enumerate(counted)}
    # A lookup that shuffles hashes its whole rows: only what is read may go in.
    read = {m.MEASURES[b].column for b in bases} | {by for table, by in keys.values() if table == ""}
    read |= {registry.relationship(name, table).fact_key for table, _ in keys.values() if table not in ("", DAY)}
    read |= {date_column or m.DATE_COLUMN[name]} if any(table == DAY for table, _ in keys.values()) else set()
    fact = fact.select(*[c for c in fact.columns if c in read])
    rows = _keyed(name, fact, keys, columns, dims, date_column, keys_from)
    # Kinds of one row; only its first carries the values to be summed.
    kinds = [F.struct(F.lit(_SUM).alias("kind"), F.lit(None).cast("long").alias("position"),
                      F.lit(None).cast("string").alias("stray"))]
    kinds += [F.struct(F.lit(c).alias("kind"), F.col(p).cast("long").alias("position"),
                       F.when(F.col(p).isNull(), F.col(c).cast("string")).alias("stray"))
              for c, p in columns.items()]
    long = rows.withColumn("_k", F.explode(F.array(*kinds)))
    summing = F.col("_k.kind") == _SUM
    # Rows of other kinds hold nulls in the summed columns; whole rows are counted by their kind.
    long = long.select(*keys, F.col("_k.kind").alias("_kind"), F.col("_k.stray").alias("_stray"),
                       F.expr(f"_k.position - pmod(_k.position, {WORD})").alias("_bucket"),
                       F.expr(f"shiftleft(1L, cast(pmod(_k.position, {WORD}) AS int))").alias("_word"),
                       *[F.when(summing, F.col(c)).alias(c) for c in fact.columns if c not in keys])
    aggregates = [F.when(F.col("_kind") == _SUM, c).alias(n) for b in added for n, c in _parts(b).items()]
    return (long.groupBy(*keys, "_kind", "_bucket", "_stray")
            .agg(F.count(F.lit(1)).alias("_rows"), F.bit_or("_word").alias("_bits"), *aggregates))


def merged(state: DataFrame, keys: list[str], bases: list[str]) -> DataFrame:
    """A state grouped by fewer keys, or by what a dimension says of them."""
    names = [n for b in bases if m.MEASURES[b].kind != "values" for n in _parts(b)]
    return state.groupBy(*keys, "_kind", "_bucket", "_stray").agg(
        F.sum("_rows").alias("_rows"),
        F.bit_or("_bits").alias("_bits"),
        *[F.sum(n).alias(n) for n in names])


def _answers(state: DataFrame, keys: list[str], bases: list[str]) -> DataFrame:
    """Base measures per group of ``keys`` from a state that is grouped by them."""
    columns = []
    for b in bases:
        base = m.MEASURES[b]
        if base.kind == "values":
            mine = F.col("_kind") == base.column
            columns.append(F.coalesce(F.sum(F.when(mine, F.coalesce(F.bit_count("_bits"), F.lit(1)))),
                                      F.lit(0)).alias(b))
        else:
            columns += [F.sum(n).alias(n) for n in _parts(b)]
    found = state.groupBy(*keys).agg(*columns)
    return found.select(*keys, *[(F.col(b) if m.MEASURES[b].kind == "values" else _finished(b)).alias(b)
                                 for b in bases])


def _in_context(name: str, node: DataFrame, keys: dict[str, str], context: m.Context, bases: list[str],
                dims: dict[str, DataFrame]) -> DataFrame:
    """Base measures of the context from its node; ``keys`` maps a context's key to the node's."""
    state = node.select(*[F.col(n).alias(k) for k, n in keys.items()],
                        *[c for c in node.columns if c not in keys.values()])
    late = {k: a for k, a in context.attributes.items() if k in context.at_event}
    if late:
        rows = state.withColumn(context.date_columns.get(name) or m.DATE_COLUMN[name], F.col(DAY))
        rows = m.in_context(name, rows, replace(context, periods={}, attributes=late), dims)
        state = merged(rows, context.keys, bases)
    return _answers(state, context.keys, bases)


def evaluate_many(names: list[str], facts: dict[str, DataFrame], contexts: dict[str, m.Context],
                  dims: dict[str, DataFrame], keys_from: dict[str, DataFrame] | None = None) -> dict[str, DataFrame]:
    """Measures in several contexts, each as ``measures.evaluate`` gives it; a fact is scanned once.

    Contexts must agree in the date column of a fact. ``keys_from`` has, by fact, what ``states`` takes.
    """
    bases = m.base_measures(names)
    per_context: dict[str, list[DataFrame]] = {c: [] for c in contexts}
    for fact_name in dict.fromkeys(m.MEASURES[b].fact for b in bases):
        mine = [b for b in bases if m.MEASURES[b].fact == fact_name]
        wanted = {c: _keys(fact_name, context) for c, context in contexts.items()}
        dates = {c.date_columns.get(fact_name) for c in contexts.values()}
        if len(dates) > 1:
            raise ValueError(f"contexts take different dates of {fact_name}: {dates}")
        # Contexts that mean the same by a key share it, whatever they call it.
        names_of = {by: f"_k{i}" for i, by in enumerate(dict.fromkeys(by for w in wanted.values() for by in w.values()))}
        root = {key: by for by, key in names_of.items()}
        state = states(fact_name, facts[fact_name], root, mine, dims, dates.pop(), (keys_from or {}).get(fact_name))
        nodes = [_node(state, frozenset(root), fact_name)]
        for c in sorted(contexts, key=lambda c: -len(wanted[c])):
            named = {k: names_of[by] for k, by in wanted[c].items()}
            keys = frozenset(named.values())
            if all(n.keys != keys for n in nodes):
                parent = min((n for n in nodes if n.keys >= keys), key=lambda n: n.size)
                nodes.append(_node(merged(parent.rows, sorted(keys), mine), keys, fact_name))
            node = next(n for n in nodes if n.keys == keys)
            per_context[c].append(_in_context(fact_name, node.rows, named, contexts[c], mine, dims))
    return {c: _together(parts, contexts[c].keys, bases, names) for c, parts in per_context.items()}


def _node(rows: DataFrame, keys: frozenset[str], name: str) -> Node:
    written = materialised(rows, f"lattice-{name}")
    return Node(keys, written, written.count())


def _together(parts: list[DataFrame], keys: list[str], bases: list[str], names: list[str]) -> DataFrame:
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    combined = stacked.groupBy(*keys).agg(*[F.max(b).alias(b) for b in bases]) if len(parts) > 1 else parts[0]
    return combined.select(*keys, *[m.measure_column(n).alias(n) for n in names])


# ------------------------------------------------------- distinct counts by time
LEVELS = {"day": lambda d: d, "month": month_start, "year": lambda d: F.trunc(d, "year"),
          "total": lambda d: F.lit(None).cast("date")}


def distinct_rollup(fact: DataFrame, dims: dict[str, DataFrame], names: list[str],
                    fact_name: str = m.TRIPS) -> DataFrame:
    """(level, period, measures): distinct counts per day, month, year and in all, from one stored
    state per day. Bitmaps of days are united; no row is read again."""
    daily = materialised(states(fact_name, fact, frozenset({DAY}), names, dims), "lattice-days")
    out = []
    for level, period in LEVELS.items():
        rows = daily.withColumn("period", period(F.col(DAY)))
        out.append(_answers(merged(rows, ["period"], names), ["period"], names)
                   .select(F.lit(level).alias("level"), "period", *names))
    return reduce(DataFrame.unionByName, out)
