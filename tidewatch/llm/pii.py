"""Personal data: fixed patterns, and a linear-chain conditional random field that adds to them.

The patterns find e-mail addresses, IP addresses, card and phone numbers. The random field
tags words by their *shape* (digits, letters, signs, counted in classes) and by the tags next to
them, so it also finds what the patterns leave: phone numbers without a plus sign, cards side by
side. It is trained from a small labelled table and decoded by Viterbi in numpy batches.

An item needs a digit or an @ to be reported, so a text with neither is not decoded; every other
text is decoded as a whole.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import WHITE, byte_batches, documents

KINDS = ["email", "ip", "card", "phone"]
TAGS = ["other", *KINDS]
#: Labelled words that training takes at most, by sentence.
MAX_LABELLED = 20_000

# --- patterns -------------------------------------------------------------------------------

_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]*\Z")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NOT_LOCAL = re.compile(r"[^A-Za-z0-9._%+-]")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def small_parts(address: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255
               for p in address.split("."))


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """From each @ to both sides, so that a long word without one is not searched again and again."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and not _NOT_LOCAL.match(text[start - 1]):
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
            done = found.end()
        else:
            done = max(done, at + 1)
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by kind as listed and then by start."""
    spans = [("email", *x) for x in _emails(text)] if "@" in text else []
    spans += [("ip", *m.span()) for m in _IP.finditer(text) if small_parts(m[0])]
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            spans.append(("card", *m.span()))
    if "+" in text:
        spans += [("phone", *m.span()) for m in _PHONE.finditer(text)
                  if 8 <= sum(c in "0123456789" for c in m[0]) <= 15]
    return spans


# --- word shapes ----------------------------------------------------------------------------

#: Upper bounds of the classes that counts of digits and of dots fall in.
_DIGITS, _DOTS = np.array([0, 2, 3, 4, 6, 9, 12, 15, 19]), np.array([0, 2, 3])
_SIGNS = 6  # letter, @, plus, bracket, dash, other sign
SHAPES = (len(_DIGITS) + 1) * (len(_DOTS) + 1) << _SIGNS

_CLASS = np.zeros(256, dtype=np.uint8)
_CLASS[0x21:0x7F] = 6
_CLASS[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = 1
_CLASS[[ord("@")]], _CLASS[[ord("+")]], _CLASS[[ord("("), ord(")")]] = 2, 3, 4
_CLASS[ord("-")], _CLASS[ord(".")], _CLASS[0x30:0x3A] = 5, 8, 7
#: Sentence signs at the end of a word say nothing about its shape.
_CLASS[[ord(c) for c in ",;:!?\"'"]] = 0


def shapes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Shape number of each word of ``data``; words do not overlap and are in order."""
    if not len(starts):
        return np.empty(0, dtype=np.int64)
    lengths = ends - starts
    word = np.repeat(np.arange(len(starts)), lengths)
    at = np.arange(len(word)) - np.repeat(np.cumsum(lengths) - lengths - starts, lengths)
    kind = _CLASS[data[at]]
    # a full stop that ends the word is a sentence sign as well
    kind[np.cumsum(lengths)[data[ends - 1] == ord(".")] - 1] = 0
    counts = np.bincount(word * 9 + kind, minlength=9 * len(starts)).reshape(-1, 9)
    code = np.searchsorted(_DIGITS, counts[:, 7]) * (len(_DOTS) + 1)
    code += np.searchsorted(_DOTS, counts[:, 8])
    for sign in range(1, 1 + _SIGNS):
        code = code * 2 + (counts[:, sign] > 0)
    return code


def _features() -> np.ndarray:
    """Indicators of each shape: every class alone, digits with dots and letters, and a constant."""
    code = np.arange(SHAPES)
    signs = (code[:, None] >> np.arange(_SIGNS)[::-1]) & 1
    dots, digits = (code >> _SIGNS) % (len(_DOTS) + 1), (code >> _SIGNS) // (len(_DOTS) + 1)
    joint = (digits * (len(_DOTS) + 1) + dots) * 2 + signs[:, 0]
    plus = digits * 8 + signs[:, 2] * 4 + signs[:, 3] * 2 + signs[:, 4]
    columns = [np.ones((SHAPES, 1)), signs, 1 - signs]
    columns += [np.eye(x.max() + 1)[x] for x in (digits, dots, joint, plus)]
    return np.concatenate(columns, axis=1)


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of texts that lie behind each other in ``data``."""
    solid = ~WHITE[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    before, after = np.append(False, solid[:-1]), np.append(solid[1:], False)
    return (np.flatnonzero(solid & (~before | edge[:-1])),
            np.flatnonzero(solid & (~after | edge[1:])) + 1)


# --- the random field -----------------------------------------------------------------------

@dataclass
class Field:
    """``emission`` scores a tag for a shape; ``step`` a tag after another, the last row and
    column standing for the ends of a text."""
    emission: np.ndarray
    step: np.ndarray

    def decode(self, codes: np.ndarray, begin: np.ndarray) -> np.ndarray:
        """Viterbi tags of the words of several texts, which begin at the places ``begin``."""
        tags = np.zeros(len(codes), dtype=np.int64)
        if not len(codes):
            return tags
        length = np.diff(begin, append=len(codes))
        order = np.argsort(-length, kind="stable")
        begin, length = begin[order], length[order]
        n, rows = len(TAGS), np.arange(len(begin))
        score = self.step[n, :n] + self.emission[codes[begin]]
        back = []
        for t in range(1, length[0]):
            live = int(np.searchsorted(-length, -t))  # texts longer than t come first
            reach = score[:live, :, None] + self.step[None, :n, :n]
            back.append(reach.argmax(axis=1).astype(np.uint8))
            score[:live] = reach.max(axis=1) + self.emission[codes[begin[:live] + t]]
        tag = (score + self.step[:n, n]).argmax(axis=1)
        tags[begin + length - 1] = tag
        for t in range(int(length[0]) - 1, 0, -1):
            live = int(np.searchsorted(-length, -t))
            tag[:live] = back[t - 1][rows[:live], tag[:live]]
            tags[begin[:live] + t - 1] = tag[:live]
        return tags


def fit(labelled: list[tuple[int, int, str, str]], rounds: int = 400, decay: float = 1e-4
        ) -> Field:
    """Maximum likelihood by Adam with exact gradients (forward-backward over all sentences)."""
    sentences: dict[int, list[tuple[str, str]]] = {}
    for sentence, _, word, tag in sorted(labelled):
        sentences.setdefault(sentence, []).append((word, tag))
    phi, n = _features(), len(TAGS)
    size, longest = len(sentences), max(map(len, sentences.values()), default=0)
    codes = np.zeros((size, longest), np.int64)
    gold = np.full((size, longest), -1)
    for i, words in enumerate(sentences.values()):
        for j, (word, tag) in enumerate(words):
            raw = np.frombuffer(word.encode(), dtype=np.uint8)
            codes[i, j] = shapes(raw, np.array([0]), np.array([len(raw)]))[0]
            gold[i, j] = TAGS.index(tag)
    live, lengths = gold >= 0, (gold >= 0).sum(axis=1)
    # counts that the gradient compares with: shape by tag, tag by tag with ends
    seen_e, seen_s = np.zeros((SHAPES, n)), np.zeros((n + 1, n + 1))
    np.add.at(seen_e, (codes[live], gold[live]), 1)
    for i in range(size):
        path = [n, *gold[i, :lengths[i]], n]
        np.add.at(seen_s, (path[:-1], path[1:]), 1)
    weights, step = np.zeros((phi.shape[1], n)), np.zeros((n + 1, n + 1))
    moments = [np.zeros_like(weights), np.zeros_like(weights),
               np.zeros_like(step), np.zeros_like(step)]

    def log_sum(x: np.ndarray, axis: int) -> np.ndarray:
        top = x.max(axis=axis, keepdims=True)
        return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)

    rows = np.arange(size)
    for r in range(1, rounds + 1):
        score = (phi @ weights)[codes]
        alpha, beta = np.zeros((size, longest, n)), np.zeros((size, longest, n))
        for t in range(longest):
            into = (step[n, :n] if t == 0 else
                    log_sum(alpha[:, t - 1, :, None] + step[:n, :n], 1))
            alpha[:, t] = into + score[:, t]
        for t in range(longest - 1, -1, -1):
            if t + 1 < longest:
                on = log_sum(step[:n, :n] + (score[:, t + 1] + beta[:, t + 1])[:, None, :], 2)
                beta[:, t] = np.where((lengths == t + 1)[:, None], step[:n, n], on)
            else:
                beta[:, t] = step[:n, n]
        total = log_sum(alpha[rows, lengths - 1] + step[:n, n], 1)
        node = np.exp(alpha + beta - total[:, None, None]) * live[..., None]
        grad_e, grad_s = seen_e.copy(), seen_s.copy()
        np.add.at(grad_e, codes[live], -node[live])
        edge = np.exp(alpha[:, :-1, :, None] + step[:n, :n] + (score + beta)[:, 1:, None, :]
                      - total[:, None, None, None]) * live[:, 1:, None, None]
        grad_s[:n, :n] -= edge.sum(axis=(0, 1))
        grad_s[n, :n] -= node[:, 0].sum(axis=0)
        grad_s[:n, n] -= node[rows, lengths - 1].sum(axis=0)
        grads = [phi.T @ grad_e - decay * size * weights, grad_s - decay * size * step]
        for k, (value, grad) in enumerate(zip((weights, step), grads)):
            m, v = moments[2 * k], moments[2 * k + 1]
            m += 0.1 * (grad - m)
            v += 0.01 * (grad ** 2 - v)
            value += 0.1 * (m / (1 - 0.9 ** r)) / (np.sqrt(v / (1 - 0.99 ** r)) + 1e-8)
    return Field(phi @ weights, step)


#: Labelled sentences: D is a digit, X a hexadecimal digit, W a word; what is in braces is tagged.
PATTERNS = [
    "W W W W W W W W", "W, W W. W W W", "W W {email:W.DD@W.example.com} W W",
    "W {email:W_W@W-W.org}. W W", "W W: {email:W+W@WD.W.net}, W", "W {email:W@W.com} W W",
    "W @W W W", "W @WDD W", "W {ip:DDD.DD.D.DDD} W W", "W W {ip:DD.DDD.DDD.DD}, W W",
    "W {ip:D.DD.DDD.DD}. W", "W W D.D.D W W", "W D.D W", "W DD.DD W W", "W DDD,DDD.DD W",
    "W DDDD W W", "W W DDD W", "W {card:DDDDDDDDDDDDDDDD} W W", "W W {card:DDDD DDDD DDDD DDDD}. W",
    "W {card:DDDD-DDDD-DDDD-DDDD} W", "W {card:DDDDDDDDDDDDDDDDDDD} W W",
    "W {card:DDDDDDDDDDDDDDDD} {card:DDDDDDDDDDDDDDDD} W", "W {phone:+D (DDD) DDD-DDDD} W W",
    "W W {phone:+DD DDD DDD DDDD}, W", "W {phone:+DDDDDDDDDDD} W", "W {phone:+D DDD-DDD-DDDD}. W W",
    "W {phone:(DDD) DDD-DDDD} W", "W W {phone:DDD-DDD-DDDD} W", "W {phone:+DD.DDD.DDD.DDD} W",
    "W W +D W W", "W (DDDD) W W", "W W DD-DD W", "W DDDD-DD-DD W", "W W DD:DD W W",
    "W DD/DD/DDDD W", "W DD% W W", "W WD W", "W W XXXXXXXXXXXXXXXXXXXXXXXX W",
    "W W=XXXXXXXXXXXXXXXXXXXX W", "W WDDDD W W", "W DDDDDD W", 'W = "XXXXXXXXXXXXXXXXXXXXXXXXX" W',
    "W https://W.W/W/DDDD W", "W W-W W W", "W $DD W", "W DDDDDDDDDD W W", "W DDDDDDDD W", "W (W) W W",
    "W W.W W", "W W*** W%%% W&&& W", "W | W | W", "W W/W W", "W #DDD W", "W DDD-DDDD W",
    "W D W D W", "W ISBN DDD-D-DD-DDDDDD-D W", "W_W W", "W DDDD W DDDD W", "W D, D, DD W DD W",
    "W W!! W!! W!!", "W W? W; W: W", "DD. W W W", "W W DDDD.",
]


def sample_labels(spark: SparkSession) -> DataFrame:
    """A small labelled table (sentence, position, word, tag): four fillings of each pattern."""
    state, rows = 7, []

    def pick(choices: str) -> str:
        nonlocal state
        state = (state * 1103515245 + 12345) % (1 << 31)
        return choices[(state >> 8) % len(choices)]

    def fill(mark: re.Match) -> str:
        if mark[0] == "D":
            return pick("0123456789")
        if mark[0] == "X":
            return pick("0123456789abcdef")
        return "".join(pick("aeioubcdlmnrst") for _ in range(int(pick("234567"))))

    for sentence in range(4 * len(PATTERNS)):
        position = 0
        for part in re.findall(r"\{\w+:[^}]*\}\S*|\S+", PATTERNS[sentence % len(PATTERNS)]):
            tagged = re.fullmatch(r"\{(\w+):([^}]*)\}(\S*)", part)
            kind, body = (tagged[1], tagged[2] + tagged[3]) if tagged else ("other", part)
            for word in body.split():
                rows.append((sentence, position, re.sub("[DWX]", fill, word), kind))
                position += 1
    return spark.createDataFrame(rows, "sentence int, position int, word string, tag string")


def train(labelled: DataFrame, max_labelled: int = MAX_LABELLED) -> Field:
    """Fits the field to at most ``max_labelled`` rows (sentence, position, word, tag)."""
    rows = (labelled.dropna(subset=["sentence", "position", "word", "tag"])
            .where(F.length("word") > 0).orderBy("sentence", "position").limit(max_labelled))
    return fit([(r.sentence, r.position, r.word, r.tag) for r in rows.collect()])


# --- both together --------------------------------------------------------------------------

def _checked(kind: str, found: str) -> bool:
    digits = [c for c in found if c in "0123456789"]
    if kind == "card":
        return 16 <= len(digits) <= 19 and luhn("".join(digits))
    if kind == "phone":
        return 8 <= len(digits) <= 15
    if kind == "ip":
        return found.count(".") == 3 and len(digits) + 3 == len(found) and small_parts(found)
    return "@" in found[1:-1]


_INTERESTING = np.zeros(256, dtype=bool)
_INTERESTING[[*range(0x30, 0x3A), ord("@")]] = True
_INNER = set("0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")


def _trimmed(text: str, start: int, end: int) -> tuple[int, int]:
    while start < end and text[start] not in _INNER and text[start] not in "+(":
        start += 1
    while start < end and text[end - 1] not in _INNER:
        end -= 1
    return start, end


def _groups(tags: list[int], words: list[int], sizes: list[int], heads: list[int]
            ) -> Iterator[tuple[str, int, int]]:
    """(kind, first, last) of neighbouring words that make up one item; numbers are split where
    a card is complete or another phone number starts."""
    open_: list = []
    for i, tag in enumerate(tags):
        kind = TAGS[tag]
        if (open_ and open_[0] == kind and words[i - 1] + 1 == words[i]
                and (kind == "card" and open_[3] < 16
                     or kind == "phone" and not (open_[3] >= 7 and heads[i] in b"+("))):
            open_[2], open_[3] = i, open_[3] + sizes[i]
            continue
        if open_:
            yield tuple(open_[:3])
        open_ = [kind, i, i, sizes[i]]
    if open_:
        yield tuple(open_[:3])


def spans_of(field: Field, data: np.ndarray, offsets: np.ndarray
             ) -> list[list[tuple[str, int, int, bool]]]:
    """(kind, start, end, by_pattern) of each text, in code points, by kind and then start."""
    found: list[list] = [[] for _ in range(len(offsets) - 1)]
    marked = np.unique(np.searchsorted(offsets, np.flatnonzero(_INTERESTING[data]), side="right") - 1)
    if not len(marked):
        return found
    parts = [data[offsets[d]:offsets[d + 1]] for d in marked]
    data, offsets = np.concatenate(parts), np.append(0, np.cumsum([len(x) for x in parts]))
    starts, ends = words_of(data, offsets)
    # every marked text has a word
    begin = np.searchsorted(starts, offsets[:-1])
    tags = field.decode(shapes(data, starts, ends), begin)
    hit = np.flatnonzero(tags)
    cuts = np.searchsorted(hit, np.append(begin, len(starts)))
    for d, raw, offset, i0, i1 in zip(marked, parts, offsets, cuts, cuts[1:]):
        text = raw.tobytes().decode("utf-8")
        base = base_spans(text)
        spans = [(*s, True) for s in base]
        word = hit[i0:i1]
        if len(word):
            # code points before each byte
            points = np.append(0, np.cumsum((raw & 0xC0) != 0x80))
            low, high = points[starts[word] - offset], points[ends[word] - offset]
            sizes = [sum("0" <= c <= "9" for c in text[a:b]) for a, b in zip(low, high)]
            heads = data[starts[word]].tolist()
            order = sorted((a, b) for _, a, b in base)
            begins = [a for a, _ in order]
            reach = np.maximum.accumulate([b for _, b in order]) if order else []
            for kind, i, j in _groups(tags[word].tolist(), word.tolist(), sizes, heads):
                start, end = _trimmed(text, int(low[i]), int(high[j]))
                before = bisect_left(begins, end)
                free = not before or reach[before - 1] <= start
                if free and _checked(kind, text[start:end]):
                    spans.append((kind, start, end, False))
        spans.sort(key=lambda s: (KINDS.index(s[0]), s[1], s[2]))
        found[d] = spans
    return found


SPANS = T.ArrayType(T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
    T.StructField("end", T.LongType()), T.StructField("by_pattern", T.BooleanType())]))


def find(docs: DataFrame, field: Field) -> DataFrame:
    """(doc_id, spans): the personal data in each row of ``docs``, by kind and then start.

    Places are code points, the end exclusive. Defined cases: a null or empty text has no spans;
    repeated rows are returned as often as they come; a null doc_id stays null; an empty table
    gives no rows; other columns are ignored.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()),
                                   ("end", pa.int64()), ("by_pattern", pa.bool_())]))
        for ids, data, offsets in byte_batches(batches):
            spans = [[dict(zip(("kind", "start", "end", "by_pattern"), s)) for s in x]
                     for x in spans_of(field, data, offsets)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(spans, kind)], ["doc_id", "spans"])

    return documents(docs).mapInArrow(run, T.StructType(
        [T.StructField("doc_id", T.LongType()), T.StructField("spans", SPANS)]))


def digests(docs: DataFrame, field: Field) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans): what ``find`` has found."""
    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def of_kind(kind):
        return F.filter(base, lambda s: s["kind"] == kind)

    base = F.filter("spans", lambda s: s["by_pattern"])
    counts = [F.size(of_kind(k)).cast("long").alias(f"n_{k}") for k in KINDS]
    return find(docs, field).select("doc_id", *counts, F.sha2(joined(base), 256)
                                    .alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def masked(text: str, spans: list[tuple[str, int, int, bool]]) -> str:
    """``text`` with a mark of its kind for each span; spans that overlap are masked as one."""
    out, done = [], 0
    for kind, start, end, _ in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= done:
            out += [text[done:start], f"[{kind.upper()}]"]
        done = max(done, end)
    return "".join([*out, text[done:]])


def mask(docs: DataFrame, field: Field) -> DataFrame:
    """``docs`` with personal data masked in ``text``; ``n_chars``, if there, counts the new text.

    Texts without personal data, null texts among them, are as they were.
    """
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            numbered = pa.RecordBatch.from_arrays(
                [pa.array(range(len(texts)), pa.int64()), batch.column("text")],
                ["doc_id", "text"])
            changed = {}
            for rows, data, offsets in byte_batches(iter([numbered])):
                for row, spans in zip(rows, spans_of(field, data, offsets)):
                    if spans:
                        changed[row] = texts[row] = masked(texts[row], spans)
            columns = list(batch.columns)
            columns[names.index("text")] = pa.array(texts, batch.schema.field("text").type)
            if "n_chars" in names and changed:
                counts = batch.column("n_chars").to_pylist()
                for row, text in changed.items():
                    counts[row] = len(text)
                columns[names.index("n_chars")] = pa.array(
                    counts, batch.schema.field("n_chars").type)
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.mapInArrow(run, docs.schema)
