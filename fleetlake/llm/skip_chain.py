"""Personal data by fixed patterns and a skip-chain conditional random field.

The patterns give base spans, which always stay. The field then labels the tokens of a document
that look like data (those with digits or @, and words that repeat a part of a base span): each
has a potential from its shape, neighbours share one, and a token is tied to the last one before
it that repeats it or shares its number or name, however far away. Base spans are observed;
loopy message passing carries their labels over the ties, so that "555-7713" far below
"+1 (017) 555-7713" is labelled too. Only tokens that ties connect with a base span can be added:
elsewhere the patterns alone decide.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from fleetlake.llm.common import columns, released, sliced, text_key

KINDS = ("email", "ip", "card", "phone")
LABELS = ("other", *KINDS)
SURE = 0.8
ROUNDS = 12
DAMPING = 0.3
NEAR_CHARS = 60
TAIL_DIGITS = 7

_AFTER_AT = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# Numbers joined by dots, taken whole: a run of digits that goes nowhere is not tried again.
_DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")
# A token: parts of ASCII letters, digits and their joints; numbers also run over blanks and brackets.
_NUMBER = re.compile(r"\+?\(?[0-9][0-9 ().-]*[0-9]")
_NAME = re.compile(r"[A-Za-z0-9](?:[A-Za-z0-9._%+-]*[A-Za-z0-9])?")

Span = tuple[int, int, int]  # label number, start, end


def _emails(text: str):
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        found = _AFTER_AT.match(text, at) if start < at else None
        last = found.end() if found else at + 1
        if found:
            yield start, last
        at = text.find("@", last)


def _ips(text: str):
    for chain in _DOTTED.finditer(text):
        start, parts = chain.start(), chain.group().split(".")
        for i in range(0, len(parts) - 3, 4):
            end = start + sum(map(len, parts[i:i + 4])) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in parts[i:i + 4]):
                yield start, end
            start = end + 1


def _luhn(digits: list[int]) -> bool:
    twice = [2 * d - 9 * (d > 4) for d in digits[-2::-2]]
    return (sum(digits[-1::-2]) + sum(twice)) % 10 == 0


def _cards(text: str):
    for m in _CARD.finditer(text):
        if m.end() - m.start() <= 37:
            digits = [int(c) for c in m.group() if c.isdigit()]
            if 13 <= len(digits) <= 19 and _luhn(digits):
                yield m.span()


def _phones(text: str):
    for m in _PHONE.finditer(text):
        if 9 <= sum("0" <= c <= "9" for c in m.group()) <= 15:
            yield m.span()


def base_spans(text: str | None) -> list[Span]:
    """Matches of the patterns by kind, then start; leftmost and not overlapping in a kind."""
    if not text:
        return []
    out = [(1, *s) for s in _emails(text)]
    if _DIGIT.search(text):
        out += [(2, *s) for s in _ips(text)]
        out += [(3, *s) for s in _cards(text)]
        out += [(4, *s) for s in _phones(text)]
    return out


def _keys(piece: str, label: int) -> list[str]:
    """What a token is tied by: its number (whole, and last digits), its name or address."""
    digits = "".join(c for c in piece if "0" <= c <= "9")
    if label == 2:
        return [f"t{piece}"]
    if label == 1 or "@" in piece:
        local = piece.rpartition("@")[0].lower()
        return [f"t{piece.lower()}", f"t{local}"]
    keys = [f"t{piece.lower()}"]
    if len(digits) >= TAIL_DIGITS and not re.search("[A-Za-z]", piece):
        keys.append(f"n{digits[-TAIL_DIGITS:]}")
    return keys


def shape(piece: str) -> tuple[int, ...]:
    """What the potential of a token depends on."""
    digits = sum("0" <= c <= "9" for c in piece)
    return (min(digits, 20), min(piece.count("."), 4), "@" in piece, piece[:1] == "+", "(" in piece,
            bool(re.search("[A-Za-z]", piece)), " " in piece or "-" in piece)


def tokens(text: str, base: list[Span]) -> list[Span]:
    """Base spans (the first kind of equal places) and other data-like tokens clear of them."""
    taken, held = [], -1
    for label, start, end in sorted(base, key=lambda s: (s[1], -s[2], s[0])):
        if start >= held:
            taken.append((label, start, end))
            held = end
    names = {text[s:e].rpartition("@")[0].lower() for k, s, e in taken if k == 1}
    free, at = [], 0
    for label, start, end in [*taken, (0, len(text), len(text))]:
        at_end = start
        pos = at
        while pos < at_end:
            m = _NUMBER.search(text, pos, at_end)
            stop = m.start() if m else at_end
            for w in _NAME.finditer(text, pos, stop):
                if w.group().lower() in names or (_DIGIT.search(w.group())):
                    free.append((0, *w.span()))
            if not m:
                break
            # A number that letters touch belongs to a name.
            a, b = m.span()
            while a > pos and text[a - 1] in _LOCAL:
                a -= 1
            while b < at_end and text[b] in _LOCAL and text[b] not in ".":
                b += 1
            free.append((0, a, b))
            pos = b
        at = end
    return sorted({*taken, *free}, key=lambda s: (s[1], s[2]))


def _ties(text: str, found: list[Span]) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """(neighbours, skips): index pairs of tokens. A skip goes to the last token with the key."""
    near = [(i, i + 1) for i in range(len(found) - 1) if found[i + 1][1] - found[i][2] <= NEAR_CHARS]
    last: dict[str, int] = {}
    skips = set()
    for i, (label, start, end) in enumerate(found):
        for key in _keys(text[start:end], label):
            if key in last:
                skips.add((last[key], i))
            last[key] = i
    return near, sorted(skips)


class Potentials:
    """Log potentials: of shapes, of neighbours and of ties."""

    def __init__(self, counts: dict[tuple, float], rounds: int = 300, ridge: float = 0.05):
        shapes = [(k[1:-1], k[-1], n) for k, n in counts.items() if k[0] == "s"]
        self.values = sorted({(i, v) for x, _, _ in shapes for i, v in enumerate(x)})
        self.place = {v: i for i, v in enumerate(self.values)}
        x = np.array([self._row(s) for s, _, _ in shapes]).reshape(len(shapes), len(self.values) + 1)
        y = np.eye(len(LABELS))[[label for _, label, _ in shapes]] if shapes else np.zeros((0, len(LABELS)))
        n = np.sqrt(np.array([w for _, _, w in shapes]))
        n = n / max(n.sum(), 1e-9)
        self.weights = np.zeros((x.shape[1], len(LABELS)))
        for _ in range(rounds if len(shapes) else 0):
            p = _softmax(x @ self.weights)
            self.weights += 0.5 * (x.T @ ((y - p) * n[:, None]) - ridge * self.weights * 0.1)
        self.near = self._pairs(counts, "n", 0.0)
        # Before any tie is seen, equal labels are three times as likely as chance.
        self.skip = self._pairs(counts, "k", 3.0)

    @staticmethod
    def _pairs(counts, kind: str, agree: float) -> np.ndarray:
        joint = np.full((len(LABELS), len(LABELS)), 1.0) + agree * len(LABELS) * np.eye(len(LABELS))
        for k, n in counts.items():
            if k[0] == kind:
                joint[k[1], k[2]] += n / 2
                joint[k[2], k[1]] += n / 2
        joint /= joint.sum()
        alone = joint.sum(axis=1)
        return np.log(joint) - np.log(alone)[:, None] - np.log(alone)[None, :]

    def _row(self, one: tuple) -> np.ndarray:
        row = np.zeros(len(self.values) + 1)
        row[-1] = 1
        for i, v in enumerate(one):
            if (i, v) in self.place:
                row[self.place[i, v]] = 1
        return row

    def unary(self, one: tuple) -> np.ndarray:
        score = self._row(one) @ self.weights
        return score - np.log(np.exp(score).sum())


def _softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(axis=1, keepdims=True))
    return z / z.sum(axis=1, keepdims=True)


def marginals(unary: np.ndarray, edges: list[tuple[int, int]], potential: np.ndarray,
              rounds: int = ROUNDS) -> np.ndarray:
    """Beliefs (tokens x labels) by damped loopy sum-product; ``potential`` is edges x labels x labels."""
    if not len(edges):
        return _softmax(unary)
    pair = np.asarray(edges)
    source = np.concatenate([pair[:, 0], pair[:, 1]])
    target = np.concatenate([pair[:, 1], pair[:, 0]])
    table = np.concatenate([potential, potential.transpose(0, 2, 1)])
    back = np.concatenate([np.arange(len(pair)) + len(pair), np.arange(len(pair))])
    message = np.zeros((len(source), unary.shape[1]))
    for _ in range(rounds):
        total = unary.copy()
        np.add.at(total, target, message)
        sent = (total[source] - message[back])[:, :, None] + table
        top = sent.max(axis=1)
        new = np.log(np.exp(sent - top[:, None, :]).sum(axis=1)) + top
        new -= new.max(axis=1, keepdims=True)
        message = DAMPING * message + (1 - DAMPING) * new
    total = unary.copy()
    np.add.at(total, target, message)
    return _softmax(total)


def added_spans(text: str, base: list[Span], model: Potentials) -> list[Span]:
    """Tokens that the field labels as data with a marginal of at least SURE."""
    if not base:
        return []
    found = tokens(text, base)
    near, skips = _ties(text, found)
    # Tokens that ties connect with a base span.
    reach = {i for i, s in enumerate(found) if s[0]}
    known = len(reach)
    for order in (skips, skips[::-1]):
        for a, b in order:
            if a in reach or b in reach:
                reach |= {a, b}
    if len(reach) == known:
        return []
    unary = np.array([model.unary(shape(text[s:e])) for _, s, e in found])
    for i, (label, _, _) in enumerate(found):
        if label:
            unary[i] = np.where(np.arange(len(LABELS)) == label, 0.0, -30.0)
    belief = marginals(unary, near + skips,
                       np.concatenate([np.repeat(model.near[None], len(near), axis=0),
                                       np.repeat(model.skip[None], len(skips), axis=0)]))
    out = []
    for i in sorted(reach):
        label = int(belief[i].argmax())
        if not found[i][0] and label and belief[i, label] >= SURE:
            out.append((label, *found[i][1:]))
    return sorted(out)


def _statistics(text: str) -> Counter:
    """Counts that potentials are fitted on; the base patterns give the labels."""
    base = base_spans(text)
    counts: Counter = Counter()
    if not base and not _DIGIT.search(text):
        return counts
    found = tokens(text, base)
    near, skips = _ties(text, found)
    for label, start, end in found:
        counts[("s", *map(int, shape(text[start:end])), label)] += 1
    for kind, pairs in (("n", near), ("k", skips)):
        for a, b in pairs:
            counts[(kind, found[a][0], found[b][0])] += 1
    return counts


def fit(docs: DataFrame) -> Potentials:
    """Potentials from all documents. Only grouped counts reach the driver: shapes and label pairs
    take a bounded number of values."""
    def run(batches):
        for batch in batches:
            total: Counter = Counter()
            for body in batch.column(0):
                total.update(_statistics((body.as_py() or b"").decode("utf-8", "replace")))
            keys = list(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([["snk".index(k[0]), *k[1:]] for k in keys], pa.list_(pa.int32())),
                 pa.array([total[k] for k in keys], pa.int64())], names=["key", "n"])

    counts = (docs.select(F.encode(F.col("`text`"), "utf-8")).mapInArrow(released(run), "key array<int>, n long")
              .groupBy("key").agg(F.sum("n").alias("n")))
    return Potentials({("snk"[k[0]], *map(int, k[1:])): float(n)
                       for k, n in counts.toPandas().itertuples(index=False)})


def detect(docs: DataFrame, model: Potentials | None = None) -> DataFrame:
    """doc_id, text_key, base, added, masked; one row per row of ``docs``.

    ``base`` and ``added`` are arrays of (kind, start, end) in code points, end exclusive, by kind
    then start. ``masked`` is the text with each span replaced by its kind in brackets (overlapping
    spans as one, named by the first); null where the text is. Null and empty texts have no spans.
    Whole texts are read; repeated rows each get theirs; nothing is shuffled.
    """
    model = model or fit(docs)

    def run(batches):
        for batch in sliced(batches):
            base, added, masked = [], [], []
            for body in batch.column(2):
                text = body.as_py().decode("utf-8", "replace") if body.is_valid else None
                fixed = base_spans(text)
                more = added_spans(text, fixed, model) if fixed else []
                base.append(_rows(fixed))
                added.append(_rows(more))
                masked.append(mask(text, fixed + more) if fixed else text)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(base, _SPANS), pa.array(added, _SPANS),
                 pa.array(masked, pa.string())], names=["doc_id", "text_key", "base", "added", "masked"])

    rows = columns(docs, "doc_id", "text").select(
        F.col("doc_id").cast("long"), text_key(F.col("text")), F.encode(F.col("text"), "utf-8"))
    spans = "array<struct<kind:string,start:int,end:int>>"
    return rows.mapInArrow(released(run), f"doc_id long, text_key binary, base {spans}, added {spans}, masked string")


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


def _rows(spans: list[Span]) -> list[dict]:
    return [{"kind": LABELS[k], "start": s, "end": e} for k, s, e in spans]


def mask(text: str, spans: list[Span]) -> str:
    out, at = [], 0
    for label, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= at:
            out += [text[at:start], f"[{LABELS[label].upper()}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def redacted(docs: DataFrame) -> DataFrame:
    """``docs`` with personal data masked in ``text`` and ``n_chars`` counted anew; other columns
    and all rows stay. All columns pass through the tasks, so nothing is joined back."""
    model = fit(docs)
    place = docs.columns.index("text")
    schema = docs.schema

    def run(batches):
        for batch in sliced(batches):
            texts = [mask(t, fixed + added_spans(t, fixed, model)) if (fixed := base_spans(t)) else t
                     for t in (c.as_py() for c in batch.column(place))]
            yield pa.RecordBatch.from_arrays(
                [pa.array(texts, batch.column(place).type) if i == place else c
                 for i, c in enumerate(batch.columns)], names=batch.schema.names)

    out = docs.mapInArrow(released(run), schema)
    return out.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in docs.columns else out
