"""Benchmark decontamination with a stored, document-partitioned positional inverted index.

The training texts are cut into segments of some hundred thousand words. A segment holds,
for each benchmark term in it, the ascending list of its positions; segments are rows of a
Parquet table in the shared folder. Since a segment has whole documents, lists of one segment
are intersected without any shuffle, and a term or passage that every document holds is no
heavier for one task than for another.

A search sends a block of phrases to all segments. Each phrase starts from the list of its
term that is rarest in the segment, shifted by the term's offset, and is intersected with the
shifted lists of the other terms in order of their rarity.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from fleetlake.llm.common import columns, text_key, words
from fleetlake.sources.scratch import materialised

WINDOW = 10
SEGMENT_WORDS = 400_000
# Words of phrases that go to the tasks at once; more phrases make further blocks.
BLOCK_WORDS = 2_000_000
# Candidates that one step of a search holds.
_STEP = 2_000_000

_SEGMENT = ("ids array<long>, keys array<binary>, n_words array<int>, terms binary, "
            "counts binary, steps binary, far binary")
_FOUND = ("doc_id long, text_key binary, n_words long, items array<string>, "
          "runs array<struct<first:int,last:int>>")


class Phrases:
    """A block of phrases: term numbers, and windows by length with the items they stem from."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int):
        self.vocabulary: dict[bytes, int] = {}
        by_length: dict[int, dict[tuple[int, ...], set[str]]] = {}
        number = self.vocabulary
        for name, tokens in items:
            ids = [number.setdefault(w, len(number)) for w in tokens]
            size = min(window, len(ids))
            for i in range(len(ids) - size + 1) if ids else ():
                by_length.setdefault(size, {}).setdefault(tuple(ids[i:i + size]), set()).add(name)
        self.windows = {
            size: (np.array(list(found), np.int32), [sorted(x) for x in found.values()])
            for size, found in by_length.items()}


def phrase_blocks(benchmark: DataFrame, window: int = WINDOW, key: str = "item_id",
                  text: str = "text", block_words: int = BLOCK_WORDS) -> Iterator[Phrases]:
    """The benchmark in blocks of about ``block_words`` words, one after the other."""
    block, held = [], 0
    rows = columns(benchmark, key, text).select(
        F.coalesce(F.col(key).cast("string"), F.lit("")), F.encode(F.col(text), "utf-8"))
    for name, body in rows.toLocalIterator():
        tokens = words(body)
        if tokens:
            block.append((name, tokens))
            held += len(tokens)
        if held >= block_words:
            yield Phrases(block, window)
            block, held = [], 0
    yield Phrases(block, window)


def _packed(term_of: np.ndarray) -> tuple[bytes, bytes, bytes, bytes]:
    """Position lists of all terms: terms, list lengths, and gaps (one byte, or 255 and four)."""
    at = np.flatnonzero(term_of >= 0)
    terms = term_of[at]
    small = terms.astype(np.uint16) if len(terms) and terms.max() < 65536 else terms
    order = np.argsort(small, kind="stable")
    at, terms = at[order].astype(np.int32), terms[order]
    first = np.flatnonzero(np.diff(terms, prepend=-1))
    gaps = np.diff(at, prepend=np.int32(0))
    gaps[first] = at[first]
    return (terms[first].tobytes(), np.diff(np.append(first, len(at))).astype(np.int32).tobytes(),
            np.minimum(gaps, 255).astype(np.uint8).tobytes(),
            gaps[gaps >= 255].astype(np.int32).tobytes())


def build_index(docs: DataFrame, phrases: Phrases, key: str = "doc_id", text: str = "text",
                segment_words: int = SEGMENT_WORDS) -> DataFrame:
    """Write the index of ``docs`` for the terms of ``phrases``; return it as a table.

    One pass over the texts. Terms outside the phrases count as words but get no list. A
    document is never cut, so a very long one makes a segment of its own.
    """
    vocabulary = docs.sparkSession.sparkContext.broadcast(phrases.vocabulary)

    def segments(batches):
        number = vocabulary.value.get
        ids, keys, sizes, parts, held = [], [], [], [], 0

        def flush():
            terms, counts, steps, far = _packed(
                np.concatenate(parts) if parts else np.empty(0, np.int32))
            return pa.RecordBatch.from_arrays([
                pa.array([ids], pa.list_(pa.int64())), pa.array([keys], pa.list_(pa.binary())),
                pa.array([sizes], pa.list_(pa.int32())), *(pa.array([x], pa.binary())
                                                           for x in (terms, counts, steps, far))],
                names=["ids", "keys", "n_words", "terms", "counts", "steps", "far"])

        gap = np.array([-1], np.int32)
        for batch in batches:
            for doc, mark, body in zip(*(c.to_pylist() for c in batch.columns)):
                tokens = words(body)
                ids.append(doc)
                keys.append(mark)
                sizes.append(len(tokens))
                parts += [np.fromiter((number(w, -1) for w in tokens), np.int32, len(tokens)), gap]
                held += len(tokens) + 1
                if held >= segment_words:
                    yield flush()
                    ids, keys, sizes, parts, held = [], [], [], [], 0
        if ids:
            yield flush()

    rows = columns(docs, key, text).select(
        F.col(key).cast("long"), text_key(F.col(text)), F.encode(F.col(text), "utf-8"))
    return materialised(rows.mapInArrow(segments, _SEGMENT), "positional-index")


class _Segment:
    """Lists of one segment, and their reading by position."""

    def __init__(self, row: dict):
        self.sizes = np.array(row["n_words"], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.sizes + 1)])
        terms, counts = (np.frombuffer(row[k], np.int32) for k in ("terms", "counts"))
        gaps = np.frombuffer(row["steps"], np.uint8).astype(np.int64)
        gaps[gaps == 255] = np.frombuffer(row["far"], np.int32)
        ends = np.cumsum(counts, dtype=np.int64)
        total = np.cumsum(gaps)
        base = np.concatenate([[0], total[ends[:-1] - 1]]) if len(ends) else ends
        self.positions = total - np.repeat(base, counts)
        self.terms, self.counts, self.begin = terms, counts, ends - counts
        self.term_at = np.full(self.starts[-1], -1, np.int32)
        self.term_at[self.positions] = np.repeat(terms, counts)

    def document(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, at, "right") - 1

    def matches(self, windows: np.ndarray, slop: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(window, start) of each occurrence, all terms at their offset give or take ``slop``."""
        width, top = windows.shape[1], int(windows.max(initial=-1)) + 1
        size = np.zeros(max(top, int(self.terms.max(initial=-1)) + 1), np.int64)
        begin = np.zeros(len(size), np.int64)
        size[self.terms], begin[self.terms] = self.counts, self.begin
        of = size[windows]
        alive = np.flatnonzero(of.min(axis=1) > 0)
        rarest = np.argsort(of[alive], axis=1, kind="stable")
        lead = rarest[:, 0]
        term = windows[alive, lead]
        cost = np.cumsum(size[term])
        cuts = np.unique(np.searchsorted(cost, np.arange(0, cost[-1] if len(cost) else 0, _STEP)))
        for lo, hi in zip(cuts, [*cuts[1:], len(alive)]):
            n = size[term[lo:hi]]
            which = np.repeat(np.arange(lo, hi), n)
            index = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(begin[term[lo:hi]], n)
            start = self.positions[index] - lead[which]
            home = self.document(self.positions[index])
            for j in range(1, width):
                offset = rarest[which, j]
                need, at = windows[alive[which], offset], start + offset
                if slop:
                    keep = self._near(need, at, home, slop)
                else:
                    keep = (at >= 0) & (at < len(self.term_at))
                    keep[keep] = self.term_at[at[keep]] == need[keep]
                which, start, home = which[keep], start[keep], home[keep]
            yield alive[which], start

    def _near(self, need, at, home, slop):
        """Does the list of term ``need`` reach within ``slop`` of ``at`` in the same document?"""
        span = len(self.term_at)
        lists = np.repeat(self.terms.astype(np.int64), self.counts) * span + self.positions
        low = np.maximum(at - slop, self.starts[home])
        high = np.minimum(at + slop, self.starts[home] + self.sizes[home] - 1)
        found = np.searchsorted(lists, need * span + low)
        inside = found < len(lists)
        inside[inside] = lists[found[inside]] <= (need * span + high)[inside]
        return inside & (low <= high)


def search(index: DataFrame, phrases: Phrases, slop: int = 0) -> DataFrame:
    """One row per indexed document: doc_id, text_key, n_words, items, runs.

    ``items`` are the sorted names of the phrases whose windows occur; ``runs`` the maximal
    word ranges (last exclusive) that any occurrence covers. With ``slop`` each term may lie
    that many words off its place, in any order (proximity); a run then covers the window's
    own length from its start, cut to the document.
    """
    windows = index.sparkSession.sparkContext.broadcast(phrases.windows)

    def found(batches):
        for batch in batches:
            for row in batch.to_pylist():
                segment = _Segment(row)
                cover = np.zeros(len(segment.term_at) + 1, np.int64)
                items: dict[int, set[str]] = {}
                for width, (grams, names) in windows.value.items():
                    for which, start in segment.matches(grams, slop):
                        doc = segment.document(np.maximum(start, 0))
                        if slop:
                            low = np.maximum(start, segment.starts[doc])
                            high = np.minimum(start + width, segment.starts[doc] + segment.sizes[doc])
                        else:
                            low, high = start, start + width
                        np.add.at(cover, low, 1)
                        np.add.at(cover, np.maximum(low, high), -1)
                        pairs = np.unique(doc * len(grams) + which)
                        for d, w in zip((pairs // len(grams)).tolist(), (pairs % len(grams)).tolist()):
                            items.setdefault(d, set()).update(names[w])
                hit = np.concatenate([[0], np.cumsum(cover)[:-1] > 0, [0]]).astype(np.int8)
                edges = np.diff(hit)
                first, last = np.flatnonzero(edges > 0), np.flatnonzero(edges < 0)
                runs: dict[int, list] = {}
                home = segment.document(first)
                base = segment.starts[home]
                for d, a, b in zip(home.tolist(), (first - base).tolist(), (last - base).tolist()):
                    runs.setdefault(d, []).append({"first": a, "last": b})
                n = range(len(row["ids"]))
                yield pa.RecordBatch.from_arrays([
                    pa.array(row["ids"], pa.int64()), pa.array(row["keys"], pa.binary()),
                    pa.array(row["n_words"], pa.int64()),
                    pa.array([sorted(items.get(i, ())) for i in n], pa.list_(pa.string())),
                    pa.array([runs.get(i, []) for i in n], pa.list_(pa.struct(
                        [("first", pa.int32()), ("last", pa.int32())])))],
                    names=["doc_id", "text_key", "n_words", "items", "runs"])

    return index.mapInArrow(found, _FOUND)


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, slop: int = 0,
                  block_words: int = BLOCK_WORDS) -> DataFrame:
    """Documents (doc_id, text) against benchmark items (item_id, text).

    Returns doc_id, text_key, n_words, n_hit, items, runs, one row per row of ``docs``. An
    item of fewer than ``window`` words is one phrase; one without words is none. Null texts
    have no words. Items with the same id count once; a null id is the empty name. Repeated
    documents each get a row. An empty benchmark hits nothing, an empty table of documents gives
    no rows, further columns are ignored. The benchmark is searched in
    blocks; with one block nothing is shuffled, with more the rows meet again by row number.
    """
    blocks = phrase_blocks(benchmark, window, block_words=block_words)
    first, second = next(blocks), next(blocks, None)
    docs = columns(docs, "doc_id", "text")
    if second is None:
        found = search(build_index(docs, first), first, slop)
        return found.select("doc_id", "text_key", "n_words", _covered("runs").alias("n_hit"),
                            "items", "runs")
    # Row numbers take the place of doc_id, so that repeated ids stay apart.
    numbered = materialised(docs.withColumn("_row", F.monotonically_increasing_id()), "numbered")
    parts = None
    for block in (first, second, *blocks):
        part = search(build_index(numbered, block, key="_row"), block, slop)
        parts = part if parts is None else parts.union(part)
    merged = parts.groupBy("doc_id").agg(
        F.first("text_key").alias("text_key"), F.max("n_words").alias("n_words"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        F.flatten(F.collect_list("runs")).alias("runs")).withColumnRenamed("doc_id", "_row")
    hit = F.size(F.array_distinct(F.flatten(F.transform(
        "runs", lambda r: F.sequence(r["first"], r["last"] - 1))))).cast("long")
    return (merged.join(numbered.select("_row", "doc_id"), "_row")
            .select("doc_id", "text_key", "n_words", hit.alias("n_hit"), "items", "runs"))


def _covered(runs: str):
    return F.aggregate(runs, F.lit(0).cast("long"), lambda n, r: n + r["last"] - r["first"])


def decontaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` without the documents that hold any window of the benchmark; other columns stay."""
    hit = (contamination(docs, benchmark, window).where("n_hit > 0")
           .select(F.col("doc_id").alias("_fleetlake_id"), F.col("text_key").alias("_fleetlake_key")).distinct())
    return docs.join(hit, docs["doc_id"].eqNullSafe(F.col("_fleetlake_id"))
                     & (text_key(docs["text"]) == F.col("_fleetlake_key")), "left_anti")
