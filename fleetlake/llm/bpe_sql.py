"""Byte-level BPE by recursive DuckDB queries inside each Spark task.

Spark spreads the documents; a task splits its texts by the pattern and hands the distinct
pieces it has not met to an in-process DuckDB. There a row is a token at its position in a
piece. One round of the recursion joins neighbours with the merge table and contracts, in each
piece, the leftmost pair of minimum rank; pieces without a pair drop out, and the recursion ends
when none is left. Decoding joins ids with the vocabulary and aggregates in order of position.
"""

from __future__ import annotations

import base64
from array import array
from itertools import chain
from operator import itemgetter

import duckdb
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from fleetlake.llm.common import released

# Longer pieces (in bytes) take the linked-list form of the same rule: the recursion has a round for
# every merge, so its time grows with the square of a piece (README has figures).
LONG_PIECE = 8192
# Rounds of one statement, after which the rows go on as the start of the next one, and rows that
# all rounds of a statement may have: memory does not grow with the square of a piece.
ROUNDS = 64
_ROWS = 1_500_000
# Bytes of text that are split at once, bytes of the pieces that a worker remembers, and what an
# entry takes besides its bytes.
_CHUNK = 1_000_000
_REMEMBER = 200_000_000
_ENTRY = 260
_DUCKDB = "160MB"

# slot: piece and position in one number, so that neighbours meet in a join on one key.
ENCODE = """
with recursive step(word, slot, pos, id, round) as (
    select word, word::bigint * 4294967296 + pos, pos, id, 0 from start
    union all
    select s.word, case when s.pos > best then s.slot - 1 else s.slot end,
           case when s.pos > best then s.pos - 1 else s.pos end,
           case when s.pos = best then merged else s.id end, s.round + 1
    from step s join (
        select a.word, min(m.id::bigint * 4294967296 + a.pos) as least,
               least & 4294967295 as best, least >> 32 as merged
        from step a join step b on b.slot = a.slot + 1
        join merges m on m.l = a.id and m.r = b.id
        group by a.word
    ) c on c.word = s.word
    where s.pos <> best + 1 and s.round < {rounds}
)
select word, any_value(round) as round, list(id order by pos) as ids
from step join (select word, max(round) as round from step where pos = 0 group by word) using (word, round)
group by word
"""
DECODE = """
select word, string_agg(hex(v.bytes), '' order by pos) as body
from tokens t join vocabulary v using (id) group by word
"""


def _positions(lengths: np.ndarray) -> np.ndarray:
    """0, 1, ... for each length, one after another."""
    return (np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)).astype(np.int32)


def _blocks(items: list[int], lengths: list[int]):
    """Runs of ``items`` whose statement has a bounded number of rows."""
    block: list[int] = []
    rows = 0
    for item, length in zip(items, lengths):
        more = length * min(length, ROUNDS)
        if block and rows + more > _ROWS:
            yield block
            block, rows = [], 0
        block.append(item)
        rows += more
    if block:
        yield block


class Coder:
    """One worker's DuckDB with the vocabulary, and the pieces it knows already."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.split = ranks, regex.compile(pattern).findall
        self.byte = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self.db = duckdb.connect(":memory:", config={"threads": 1, "memory_limit": _DUCKDB,
                                                     "temp_directory": ""})
        self._load("vocabulary", id=pa.array(ranks.values(), pa.int32()),
                   bytes=pa.array(ranks.keys(), pa.binary()))
        pairs = [(ranks[t[:i]], ranks[t[i:]], rank) for t, rank in ranks.items()
                 for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks]
        left, right, merged = zip(*pairs) if pairs else ((), (), ())
        self._load("merges", l=pa.array(left, pa.int32()), r=pa.array(right, pa.int32()),
                   id=pa.array(merged, pa.int32()))
        # Piece to (ids as 32-bit numbers, decoded bytes), and the bytes these take.
        self.known: dict[str, tuple[bytes, bytes]] = {}
        self.held = 0

    def _load(self, name: str, **data):
        self.db.register("incoming", pa.table(data))
        self.db.execute(f"create table {name} as select * from incoming")
        self.db.unregister("incoming")

    def _run(self, name: str, sql: str, **data) -> pa.Table:
        self.db.register(name, pa.table(data))
        rows = self.db.sql(sql).to_arrow_table()
        self.db.unregister(name)
        return rows

    def packed_pieces(self, pieces: list[bytes]) -> list[bytes]:
        """Ids (32-bit numbers) of each piece. A piece that is a token as a whole is that token."""
        out, ranks = [b""] * len(pieces), self.ranks
        todo = []
        for i, piece in enumerate(pieces):
            rank = ranks.get(piece)
            if rank is not None:
                out[i] = array("i", (rank,)).tobytes()
            elif len(piece) > LONG_PIECE:
                out[i] = array("i", merge_long(piece, ranks)).tobytes()
            elif piece:
                todo.append(i)
        todo.sort(key=lambda i: len(pieces[i]))
        left: dict[int, np.ndarray] = {}
        for block in _blocks(todo, [len(pieces[i]) for i in todo]):
            body = self.byte[np.frombuffer(b"".join([pieces[i] for i in block]), np.uint8)]
            self._statement(block, np.array([len(pieces[i]) for i in block]), body, out, left)
        while left:  # pieces that need further rounds
            state, left = left, {}
            for block in _blocks(list(state), [len(x) for x in state.values()]):
                self._statement(block, np.array([len(state[i]) for i in block]),
                                np.concatenate([state[i] for i in block]), out, left)
        return out

    def _statement(self, block: list[int], lengths: np.ndarray, ids: np.ndarray, out: list[bytes],
                   left: dict[int, np.ndarray]) -> None:
        """ROUNDS rounds for the pieces of ``block``. Finished ones go to ``out``, others to ``left``."""
        found = self._run("start", ENCODE.format(rounds=ROUNDS), word=np.repeat(block, lengths).astype(np.int32),
                          pos=_positions(lengths), id=ids)
        words, rounds, lists = (found.column(c).combine_chunks() for c in ("word", "round", "ids"))
        values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int32, copy=False)
        body, ends = values.tobytes(), (np.asarray(lists.offsets) - lists.offsets[0].as_py()).tolist()
        for k, (word, done) in enumerate(zip(words.to_pylist(), rounds.to_pylist())):
            if done < ROUNDS:
                out[word] = body[4 * ends[k]:4 * ends[k + 1]]
            else:
                left[word] = values[ends[k]:ends[k + 1]]

    def encode_pieces(self, pieces: list[bytes]) -> list[list[int]]:
        return [array("i", x).tolist() for x in self.packed_pieces(pieces)]

    def decode_packed(self, sequences: list[bytes]) -> list[bytes]:
        """Bytes of each sequence of 32-bit ids, by ordered aggregation."""
        lengths = np.array([len(s) // 4 for s in sequences], np.int64)
        found = self._run(
            "tokens", DECODE, word=np.repeat(np.arange(len(sequences)), lengths).astype(np.int32),
            pos=_positions(lengths), id=np.frombuffer(b"".join(sequences), np.int32))
        out = [b""] * len(sequences)
        for word, body in zip(found.column("word").to_pylist(), found.column("body").to_pylist()):
            out[word] = bytes.fromhex(body)
        return out

    def decode_ids(self, sequences: list[list[int]]) -> list[bytes]:
        return self.decode_packed([array("i", s).tobytes() for s in sequences])

    def learn(self, pieces: set[str]) -> None:
        new = [p for p in pieces if p not in self.known]
        size = sum(map(len, new)) * 9 + len(new) * _ENTRY
        if self.held + size > _REMEMBER:
            self.known.clear()
            new = list(pieces)
            self.held, size = 0, sum(map(len, new)) * 9 + len(new) * _ENTRY
        if new:
            self.held += size
            packed = self.packed_pieces([p.encode("utf-8") for p in new])
            self.known.update(zip(new, zip(packed, self.decode_packed(packed))))

    def run(self, texts: list[str]) -> list[tuple[bytes, bytes]]:
        """(ids as 32-bit numbers, decoded bytes) of each text."""
        pieces = [self.split(t) for t in texts]
        self.learn(set(chain.from_iterable(pieces)))
        out = []
        for one in pieces:
            got = [self.known[p] for p in one]
            out.append((b"".join(map(itemgetter(0), got)), b"".join(map(itemgetter(1), got))))
        return out


def merge_long(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same merges (minimum rank first, leftmost of equals) over a heap and linked parts."""
    import heapq

    end = len(piece)
    after, before = list(range(1, end + 1)), list(range(-1, end - 1))
    stop = list(range(1, end + 1))
    heap = [(ranks[piece[i:i + 2]], i, i + 2) for i in range(end - 1) if piece[i:i + 2] in ranks]
    heapq.heapify(heap)
    gone = [False] * (end + 1)
    while heap:
        _, i, to = heapq.heappop(heap)
        j = after[i] if not gone[i] else end
        if gone[i] or j >= end or stop[j] != to:
            continue
        gone[j], stop[i], after[i] = True, to, after[j]
        if after[j] < end:
            before[after[j]] = i
        for a in (before[i], i):
            if a >= 0 and after[a] < end:
                whole = piece[a:stop[after[a]]]
                if whole in ranks:
                    heapq.heappush(heap, (ranks[whole], a, stop[after[a]]))
    return [ranks[piece[i:stop[i]]] for i in range(end) if not gone[i]]


_CODERS: dict[tuple[str, str], Coder] = {}


def coder(path: str, pattern: str) -> Coder:
    """The worker's coder for a rank file (lines of base64 bytes and rank) and a pattern."""
    if (path, pattern) not in _CODERS:
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        _CODERS[path, pattern] = Coder(ranks, pattern)
    return _CODERS[path, pattern]


def encode(docs: DataFrame, path: str, pattern: str, key: str = "doc_id",
           text: str = "text") -> DataFrame:
    """doc_id, tokens array<int>, decoded binary; one row per row of ``docs``.

    ``path`` names the rank file on every machine; it is opened once per worker. A null text is
    empty: no tokens, no bytes. Texts may have any length. Repeated rows each get theirs; further
    columns are ignored; an empty table gives no rows. Nothing is shuffled, and a lost task just
    runs again.
    """
    def run(batches):
        work = coder(path, pattern)

        def done(ids, texts):
            got = work.run(texts)
            ends = np.cumsum([0, *(len(g[0]) // 4 for g in got)], dtype=np.int32)
            tokens = pa.ListArray.from_arrays(
                pa.array(ends), pa.array(np.frombuffer(b"".join(g[0] for g in got), np.int32)))
            return pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), tokens, pa.array([g[1] for g in got], pa.binary())],
                names=[key, "tokens", "decoded"])

        for batch in batches:
            ids, texts, held = [], [], 0
            for doc, body in zip(batch.column(0), batch.column(1)):
                ids.append(doc.as_py())
                texts.append((body.as_py() or b"").decode("utf-8", "replace"))
                held += len(texts[-1])
                if held >= _CHUNK:
                    yield done(ids, texts)
                    ids, texts, held = [], [], 0
            if ids:
                yield done(ids, texts)

    rows = docs.select(F.col(f"`{key}`").cast("long"), F.encode(F.col(f"`{text}`"), "utf-8"))
    return rows.mapInArrow(released(run), f"`{key}` long, tokens array<int>, decoded binary")


def decode(rows: DataFrame, path: str, pattern: str, key: str = "doc_id",
           tokens: str = "tokens") -> DataFrame:
    """doc_id, decoded binary of any token lists (null: empty). Unknown ids decode to nothing."""
    def run(batches):
        work = coder(path, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                lists = [[t for t in x or [] if t is not None] for x in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(work.decode_ids(lists), pa.binary())],
                    names=[key, "decoded"])

    rows = rows.select(F.col(f"`{key}`").cast("long"), F.col(f"`{tokens}`").cast("array<int>"))
    return rows.mapInArrow(released(run), f"`{key}` long, decoded binary")
