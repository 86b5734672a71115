import base64
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from llm_helpers import wide

from fleetlake.llm import bpe_sql as b

PATH, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(x): int(y) for x, y in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_whole_table(load, reference):
    texts = {r["doc_id"]: r["text"] for r in load("documents").collect()}
    rows = b.encode(load("documents"), PATH, PATTERN).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert r["tokens"] == reference.encode_ordinary(texts[r["doc_id"]])
        assert bytes(r["decoded"]) == texts[r["doc_id"]].encode()


def test_edges(spark, docs, reference):
    rows = [(1, None), (2, ""), (2, ""), (None, "a b"), (3, "<|endoftext|> don't  \n\n x"), (4, "日本語 é 😀"),
            (5, "z" * 3000), (6, " " * 2000), (7, "the cat " * 40_000)]
    got = b.encode(docs(*rows), PATH, PATTERN).collect()
    assert sorted((str(r["doc_id"]), r["tokens"], bytes(r["decoded"])) for r in got) == sorted(
        (str(i), reference.encode_ordinary(t or ""), (t or "").encode()) for i, t in rows)
    assert b.encode(docs((1, "a")).limit(0), PATH, PATTERN).count() == 0
    lists = wide(spark.createDataFrame([(1, [1, 2, 3]), (2, []), (3, None), (4, [None, 5])],
                                       "doc_id long, tokens array<int>"))
    back = {r["doc_id"]: bytes(r["decoded"]) for r in b.decode(lists, PATH, PATTERN).collect()}
    assert back == {1: reference.decode_bytes([1, 2, 3]), 2: b"", 3: b"", 4: reference.decode_bytes([5])}


def test_long_pieces_merge_like_short_ones(reference):
    coder = b.coder(PATH, PATTERN)
    draw = random.Random(1)
    pieces = ["".join(draw.choice(letters) for _ in range(length)).encode()
              for length in (2, 3, 10, 60, 250, 300, 1000, 4096)
              for letters in ("ab", "abcdefghij", "aeiou", " ")]
    expected = [reference._core_bpe.encode_single_piece(p) for p in pieces]
    assert coder.encode_pieces(pieces) == expected
    for piece, ids in zip(pieces, expected):
        assert coder.encode_pieces([piece]) == [ids]
        if piece not in coder.ranks:
            assert b.merge_long(piece, coder.ranks) == ids
    longest = "".join(draw.choice("abcdefghij") for _ in range(20_000)).encode()
    assert coder.encode_pieces([longest]) == [reference._core_bpe.encode_single_piece(longest)]


def test_statements_of_few_rounds_and_rows_change_nothing(monkeypatch, reference):
    monkeypatch.setattr(b, "ROUNDS", 3)
    monkeypatch.setattr(b, "_ROWS", 50)
    coder = b.coder(PATH, PATTERN)
    pieces = [p.encode() for p in ("x", "internationalisation", "zzzzzzzz", "antidisestablishmentarianism", "qq")]
    assert coder.encode_pieces(pieces) == [reference._core_bpe.encode_single_piece(p) for p in pieces]


def test_a_full_memory_of_pieces_changes_nothing(monkeypatch, reference):
    monkeypatch.setattr(b, "_REMEMBER", 900)
    coder = b.coder(PATH, PATTERN)
    texts = ["one two three four five", "six seven one two", "one"]
    for text, (ids, body) in zip(texts, [coder.run([t])[0] for t in texts]):
        assert np.frombuffer(ids, np.int32).tolist() == reference.encode_ordinary(text) and body == text.encode()
