import zlib
from collections import defaultdict

from fleetlake.llm import jump_shards


def jump(key, n):
    key, b, j = (key or 0) & (1 << 64) - 1, -1, 0
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) & (1 << 64) - 1
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def check(df, shards, expected):
    got = jump_shards.assign(df, shards).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["size"], r["text_crc32"]) for r in got) == sorted(
        (i is None, i or 0, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in expected)
    slots = defaultdict(list)
    for r in got:
        assert r["shard"] == jump(r["doc_id"], shards)
        assert r["grown_shard"] == jump(r["doc_id"], shards + 1)
        assert r["grown_shard"] in (r["shard"], shards)
        slots[r["shard"]].append(r["slot"])
    for found in slots.values():
        assert sorted(found) == list(range(len(found)))


def test_whole_table(load):
    rows = [(r["doc_id"], r["text"]) for r in load("documents").collect()]
    check(load("documents"), 24, rows)


def test_edges(docs):
    rows = [(1, "a"), (1, "a"), (1, "b"), (None, None), (None, "é"), (-5, ""), ((1 << 63) - 1, "x" * 100_000),
            (-(1 << 63), None)]
    for shards in (1, 2, 7):
        check(docs(*rows), shards, rows)
    assert jump_shards.assign(docs((1, "a")).limit(0), 24).count() == 0


def test_one_key_in_most_rows(docs):
    check(docs(*[(9, str(i)) for i in range(500)], *[(i, "t") for i in range(100)]), 24,
          [*[(9, str(i)) for i in range(500)], *[(i, "t") for i in range(100)]])
