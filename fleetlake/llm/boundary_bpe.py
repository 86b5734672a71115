"""BPE encoding and decoding with forced boundaries.

A word is a run of byte symbols, the last one marked as a word's end. Two symbols that stand side by
side inside no token of the vocabulary can never end up in one token, and merges on one side of such
a place do not touch the other: it is a certain cut. No token goes on after a word's end, so the ends
of words are cuts of the same kind. A text thus becomes one long row of symbols, is cut in one
vectorised lookup of all neighbouring pairs, and its fragments are encoded on their own and put
together again. Fragments recur far more often than words, so a worker keeps those it met.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

# Bytes of text that are cut at once, and bytes of fragments and ids that a worker keeps.
_CHUNK = 1_000_000
_REMEMBER = 80_000_000
# What an entry of that memory takes besides its bytes.
_ENTRY = 200
# Fragments of more symbols are merged over a heap.
_SHORT = 48
_NO_MERGE = 1 << 62


def byte_letters() -> list[str]:
    """The letter that stands for each byte in the vocabulary: printable ones for themselves, the
    others for code points from 256 on, in order."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b if b in plain else next(others)) for b in range(256)]


@lru_cache(maxsize=1)
def _new() -> np.ndarray:
    """Which code points have no entry in Python's tables."""
    return np.array([unicodedata.category(chr(c)) == "Cn" for c in range(0x110000)])


class Coder:
    """Vocabulary, merges, the table of pairs inside tokens, and the fragments met so far."""

    def __init__(self, text: str):
        spec = json.loads(text)
        self.spec, self.rules = json.dumps(spec | {"model": {"type": "BPE", "vocab": {}, "merges": []},
                                                   "added_tokens": []}), None
        model = spec["model"]
        self.suffix = model["end_of_word_suffix"]
        vocab: dict[str, int] = model["vocab"]
        letters = byte_letters()
        self.symbol = symbol = {a: b for b, a in enumerate(letters)}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.names = {i: t for t, i in [*vocab.items(), *self.special.items()]}
        self.split_special = regex.compile("|".join(map(regex.escape, self.special)) or r"(?!)")
        self.words = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        # Symbols: 0 to 255 are bytes, 256 to 511 bytes that end a word.
        self.unit = np.array([vocab[a] for a in letters] + [vocab[a + self.suffix] for a in letters])
        self.inside = np.zeros((512, 512), bool)
        for token in vocab:
            end = token.endswith(self.suffix)
            body = [symbol[a] for a in (token.removesuffix(self.suffix) if end else token)]
            if end:
                body[-1] += 256
            self.inside[body[:-1], body[1:]] = True
        # Both ids of a pair in one number, to its rank and the new id in one number.
        self.merges: dict[int, int] = {}
        for rank, (a, b) in enumerate(model["merges"]):
            self.merges.setdefault(vocab[a] << 32 | vocab[b], rank << 32 | vocab[a + b])
        self.known: dict[bytes, bytes] = {}
        self.held = 0

    def split(self, text: str) -> bytes:
        """The words of ``text``, each with a line feed behind it.

        Composed and in lower case, each letter by itself (no final sigma). Blanks are in no word, so
        they need not be made one. Where the text holds code points that Python's tables do not know
        yet, the tokenizer file's own normalizer and splitter say what they are.
        """
        if not text.isascii():
            if _new()[np.frombuffer(text.encode("utf-32-le"), "<u4")].any():
                return self._split_new(text)
            text = unicodedata.normalize("NFC", text).replace("\u03a3", "\u03c3")
        words = self.words.findall(text.lower())
        return "\n".join([*words, ""]).encode("utf-8")

    def _split_new(self, text: str) -> bytes:
        if self.rules is None:
            self.rules = Tokenizer.from_str(self.spec)
        words = self.rules.pre_tokenizer.pre_tokenize_str(self.rules.normalizer.normalize_str(text))
        return b"".join(bytes(map(self.symbol.__getitem__, w)) + b"\n" for w, _ in words)

    def symbols(self, text: str) -> np.ndarray:
        """The symbols of all words of ``text`` in one row."""
        row = np.frombuffer(self.split(text), np.uint8)
        feed = np.flatnonzero(row == 10)
        row = row.astype(np.uint16)
        row[feed - 1] += 256
        return np.delete(row, feed)

    def cuts(self, row: np.ndarray) -> np.ndarray:
        """First positions of the fragments of ``row``, and its end."""
        inner = np.flatnonzero(~self.inside[row[:-1], row[1:]]) + 1
        return np.concatenate([[0], inner, [len(row)]]) if len(row) else np.zeros(1, np.int64)

    def merged(self, fragment: bytes) -> bytes:
        """Ids (little-endian 32-bit) of one fragment (16-bit symbols): the pair of least rank first,
        the leftmost of equals."""
        ids = self.unit[np.frombuffer(fragment, np.uint16)].tolist()
        return array("I", self._few(ids) if len(ids) <= _SHORT else self._many(ids)).tobytes()

    def _few(self, ids: list[int]) -> list[int]:
        find = self.merges.get
        pairs = [find(a << 32 | b, _NO_MERGE) for a, b in zip(ids, ids[1:])]
        while pairs and (least := min(pairs)) < _NO_MERGE:
            i = pairs.index(least)
            ids[i:i + 2] = [least & 0xFFFFFFFF]
            del pairs[i]
            if i < len(pairs):
                pairs[i] = find(ids[i] << 32 | ids[i + 1], _NO_MERGE)
            if i:
                pairs[i - 1] = find(ids[i - 1] << 32 | ids[i], _NO_MERGE)
        return ids

    def _many(self, ids: list[int]) -> list[int]:
        """The same over a heap and linked parts, so that long fragments stay cheap."""
        n, merges = len(ids), self.merges
        heap = [(merges[p], i, *ab) for i, ab in enumerate(zip(ids, ids[1:]))
                if (p := ab[0] << 32 | ab[1]) in merges]
        heapq.heapify(heap)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while heap:
            found, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j], after[i] = found & 0xFFFFFFFF, -1, after[j]
            if after[j] < n:
                before[after[j]] = i
            for left, right in ((before[i], i), (i, after[i])):
                if left >= 0 and right < n and (p := ids[left] << 32 | ids[right]) in merges:
                    heapq.heappush(heap, (merges[p], left, ids[left], ids[right]))
        return [i for i in ids if i >= 0]

    def _learn(self, fragment: bytes) -> bytes:
        found = self.merged(fragment)
        self.held += len(fragment) + len(found) + _ENTRY
        if self.held > _REMEMBER:
            self.known.clear()
            self.held = len(fragment) + len(found) + _ENTRY
        self.known[fragment] = found
        return found

    def ids(self, row: np.ndarray) -> bytes:
        body, cuts = row.tobytes(), (2 * self.cuts(row)).tolist()
        fragments = [body[a:b] for a, b in zip(cuts, cuts[1:])]
        out = list(map(self.known.get, fragments))
        if None in out:
            for i, found in enumerate(out):
                if found is None:
                    out[i] = self.known.get(fragments[i]) or self._learn(fragments[i])
        return b"".join(out)

    def encode(self, text: str) -> bytes:
        """Ids of ``text`` (little-endian 32-bit). Special tokens are looked for before all else."""
        out, at = [], 0
        for m in self.split_special.finditer(text):
            out += [self.ids(self.symbols(text[at:m.start()])),
                    np.array([self.special[m.group()]], "<u4").tobytes()]
            at = m.end()
        return b"".join([*out, self.ids(self.symbols(text[at:]))])

    def decode(self, ids: bytes) -> str:
        """Tokens as they are written in the vocabulary, joined by blanks; unknown ids are nothing."""
        names = self.names
        return " ".join([names[i] for i in np.frombuffer(ids, "<u4").tolist() if i in names])


_CODERS: dict[str, Coder] = {}


def coder(path: str) -> Coder:
    """The worker's coder for a tokenizer file."""
    if path not in _CODERS:
        with open(path, encoding="utf-8") as file:
            _CODERS[path] = Coder(file.read())
    return _CODERS[path]


def _coded(work: Coder, ids: list, texts: list[str], key: str) -> pa.RecordBatch:
    coded = [work.encode(t) for t in texts]
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.int64()), pa.array([len(c) // 4 for c in coded], pa.int64()),
         pa.array(coded, pa.binary()), pa.array([work.decode(c) for c in coded], pa.string())],
        names=[key, "n_tokens", "tokens", "decoded"])


def encode(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_tokens, tokens binary (ids as little-endian 32-bit numbers), decoded string.

    One row per row of ``docs``, over whole texts of any length; a null text is empty: no tokens, an
    empty string. Repeated rows each get theirs, further columns are ignored, an empty table gives no
    rows. ``path`` names the tokenizer file on every machine. Nothing is shuffled; a lost task runs
    again.
    """
    def run(batches):
        work = coder(path)
        for batch in batches:
            ids, texts, held = [], [], 0
            for i in range(batch.num_rows):
                ids.append(batch.column(0)[i].as_py())
                texts.append((batch.column(1)[i].as_py() or b"").decode("utf-8", "replace"))
                held += len(texts[-1])
                if held >= _CHUNK:
                    yield _coded(work, ids, texts, key)
                    ids, texts, held = [], [], 0
            if ids:
                yield _coded(work, ids, texts, key)

    rows = docs.select(F.col(f"`{key}`").cast("long"), F.encode(F.col(f"`{text}`"), "utf-8"))
    return rows.mapInArrow(run, f"`{key}` long, n_tokens long, tokens binary, decoded string")


def decode(rows: DataFrame, path: str, key: str = "doc_id", tokens: str = "tokens") -> DataFrame:
    """doc_id, decoded string of packed ids (null: empty). Ids beyond the vocabulary are left out."""
    def run(batches):
        work = coder(path)
        for batch in batches:
            texts = [work.decode(c.as_py() or b"") for c in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())],
                                             names=[key, "decoded"])

    rows = rows.select(F.col(f"`{key}`").cast("long"), F.col(f"`{tokens}`"))
    return rows.mapInArrow(run, f"`{key}` long, decoded string")
