import random

import numpy as np
import public_tokenizers
import pytest
from llm_helpers import wide
from tokenizers import Tokenizer

from fleetlake.llm import boundary_bpe as b

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def reference():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids, tokenizer


def ids(packed):
    return np.frombuffer(packed, "<u4").tolist()


def test_whole_table(load, reference):
    encode, tokenizer = reference
    texts = {r["doc_id"]: r["text"] for r in load("documents").collect()}
    rows = b.encode(load("documents"), PATH).collect()
    assert len(rows) == len(texts)
    for r in rows:
        expected = encode(texts[r["doc_id"]])
        assert ids(r["tokens"]) == expected and r["n_tokens"] == len(expected)
        assert r["decoded"] == tokenizer.decode(expected, skip_special_tokens=False)


def test_edges(spark, docs, reference):
    encode, tokenizer = reference
    rows = [(1, None), (2, ""), (2, ""), (None, "a b"), (3, "<|endoftext|> DON'T  \n\n x<|startoftext|>"),
            (4, "日本語 é é 😀 İΣΑΣ"), (5, "z" * 3000), (6, " " * 2000), (7, "the cat " * 40_000),
            (8, "Ɤ\U000323b5 \x1c \x85 "), (9, "th" * 10_000)]
    got = b.encode(docs(*rows), PATH).collect()
    assert sorted((str(r["doc_id"]), ids(r["tokens"]), r["decoded"]) for r in got) == sorted(
        (str(i), encode(t), tokenizer.decode(encode(t), skip_special_tokens=False)) for i, t in rows)
    assert b.encode(docs((1, "a")).limit(0), PATH).count() == 0
    packed = np.array([0, 5, 49407, 1 << 20], "<u4").tobytes()
    lists = wide(spark.createDataFrame([(1, bytearray(packed)), (2, None)], "doc_id long, tokens binary"))
    back = {r["doc_id"]: r["decoded"] for r in b.decode(lists, PATH).collect()}
    assert back == {1: tokenizer.decode([0, 5, 49407], skip_special_tokens=False), 2: ""}


def test_every_code_point(reference):
    coder, (encode, _) = b.coder(PATH), reference
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for at in range(0, len(points), 500):
        text = "".join(f"a{chr(c)}1{chr(c)}B " for c in points[at:at + 500])
        assert ids(coder.encode(text)) == encode(text), hex(points[at])


def test_random_texts(reference):
    coder, (encode, _) = b.coder(PATH), reference
    draw = random.Random(3)
    pool = [chr(c) for r in (range(32, 127), range(32, 127), range(0x300, 0x370), range(0xC0, 0x250),
                             range(0x370, 0x400), range(0xAC00, 0xAC40), (0x1100, 0x1161, 0x11A8, 0x378, 0xA7CB))
            for c in r] + ["<|startoftext|>", "<|endoftext|>", "'s", "'ll", " \n\t "]
    for _ in range(3000):
        text = "".join(draw.choice(pool) for _ in range(draw.randrange(30)))
        assert ids(coder.encode(text)) == encode(text)


def test_cuts_are_where_no_token_goes_across(reference):
    coder, (_, tokenizer) = b.coder(PATH), reference
    row = coder.symbols("antidisestablishmentarianism zqxjk vwx 12 ok")
    cuts = coder.cuts(row).tolist()
    assert len(cuts) > 8  # more than the words
    inside = {(x, y) for t in tokenizer.get_vocab() for x, y in zip(t, t[1:])}
    letters = b.byte_letters()
    for i in set(range(1, len(row))) - set(cuts):  # places that are no cut lie inside some token
        assert (letters[row[i - 1] % 256], letters[row[i] % 256]) in inside


def test_a_full_memory_of_fragments_changes_nothing(monkeypatch, reference):
    monkeypatch.setattr(b, "_REMEMBER", 700)
    coder, (encode, _) = b.coder(PATH), reference
    for text in ["one two three four five", "six seven one two", "one"] * 2:
        assert ids(coder.encode(text)) == encode(text)
