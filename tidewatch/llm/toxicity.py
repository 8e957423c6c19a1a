"""Toxicity: embeddings of character n-grams, averaged over passages into a linear softmax.

A text is read as passages of ``PASSAGE`` words. A passage is the bag of the character n-grams of
its words, each hashed to an embedding; their mean goes through a linear softmax over clean and
toxic, and embeddings and softmax are trained together. The score of a text is that of its most
toxic passage, so a few words count as much in a long text as in a short one. A misspelt or
inflected word shares most of its n-grams, and so most of its embedding, with the word itself.

Labels are of whole texts. Training starts from the passages of toxic texts whose n-grams
are rarest in clean ones, and after each round takes those that the model itself finds toxic.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_batches, documents

BITS, SIZES, PASSAGE, WIDTH = 18, (3, 4, 5), 12, 8
#: A passage of fewer n-grams is averaged as if it had this many, so that no single word decides.
MIN_GRAMS = 40
#: Labelled texts of either class that training takes at most, chosen by hash.
MAX_TEXTS = 1_500
#: Passages of a text that training takes at most, chosen at random from its doc_id.
MAX_PASSAGES = 300
#: Steps of training that a round takes at least.
MIN_STEPS = 150

#: Letters, digits and bytes of other characters make up words, in lower case; all else parts them.
_FOLD = np.full(256, 32, dtype=np.uint32)
_FOLD[0x80:] = np.arange(0x80, 0x100)
for _low, _high, _to in ((0x30, 0x3A, 0x30), (0x61, 0x7B, 0x61), (0x41, 0x5B, 0x61)):
    _FOLD[_low:_high] = np.arange(_to, _to + _high - _low)


def ngrams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket, passage) of every n-gram, and the number of passages up to each text's end.

    N-grams lie within a word and the blanks around it; texts that lie behind each other in
    ``data`` are parted by a blank. A word that repeats the one before it adds none.
    """
    texts = len(offsets) - 1
    folded = np.full(len(data) + texts + 1, 32, dtype=np.uint32)
    # one blank before each text and one at the end
    place = np.arange(len(data)) + 1 + np.repeat(np.arange(texts), np.diff(offsets))
    folded[place] = _FOLD[data]
    begins = offsets[:-1] + np.arange(texts)  # the blank before each text
    blank = folded == 32
    heads = np.append(False, ~blank[1:] & blank[:-1])
    words = np.cumsum(heads)  # words begun up to here
    before = words[begins]  # words in the texts before
    counts = np.diff(np.append(before, words[-1] if len(words) else 0))
    passages = -(-counts // PASSAGE)
    ends = np.cumsum(passages)
    text_of = np.repeat(np.arange(texts), np.diff(np.append(begins, len(folded))))
    passage = (ends - passages)[text_of] + (words - before[text_of] - 1) // PASSAGE
    # words alike in length and pairs of characters repeat each other
    pairs = np.append(folded[:-1] * np.uint32(0x01000193) + folded[1:], np.uint32(0))
    pairs = (pairs ^ (pairs >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    pairs[blank] = 0
    head = np.flatnonzero(heads)
    fresh = np.ones(len(head) + 1, dtype=bool)  # by word number, from 1
    if len(head):
        sums = np.add.reduceat(pairs, head)
        fresh[2:] = (np.diff(sums) != 0) | (np.diff(text_of[head]) != 0)
    # distance to the next blank behind each place
    blanks = np.flatnonzero(blank)
    ahead = blanks[np.searchsorted(blanks, np.arange(len(folded)), side="right")
                   .clip(max=len(blanks) - 1)] - np.arange(len(folded))
    buckets, owners = [], []
    h = folded
    for n in range(2, max(SIZES) + 1):
        h = h[:-1] * np.uint32(0x01000193) + folded[n - 1:]
        if n in SIZES:
            at = np.flatnonzero(ahead[:len(h)] >= n - 1)
            at = at[fresh[words[at + 1]]]
            mixed = (h[at] ^ np.uint32(n)) * np.uint32(0x9E3779B1)
            buckets.append(mixed >> np.uint32(32 - BITS))
            owners.append(passage[at + 1])
    return np.concatenate(buckets), np.concatenate(owners), ends


@dataclass
class Model:
    """``weight`` is each embedding's share in the difference of the two logits, ``bias`` that of
    the softmax; a text's greatest passage logit z scores sigmoid(slope z + shift)."""
    weight: np.ndarray
    bias: float
    slope: float = 1.0
    shift: float = 0.0

    def logits(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Greatest logit of each text's passages; the bias for a text without words."""
        bucket, passage, ends = ngrams(data, offsets)
        size = int(ends[-1]) if len(ends) else 0
        total = np.bincount(passage, weights=self.weight[bucket], minlength=size)
        count = np.bincount(passage, minlength=size)
        z = total / np.maximum(count, MIN_GRAMS) + self.bias
        out = np.full(len(ends), self.bias)
        begins = np.append(0, ends[:-1])
        some = ends > begins
        if some.any():
            out[some] = np.maximum.reduceat(z, begins[some])
        return out

    def score(self, logits: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * logits + self.shift, -30, 30)))


def _fit_softmax(bags: list[np.ndarray], toxic: np.ndarray, rounds: int, seed: int
                 ) -> tuple[np.ndarray, float]:
    """Embeddings and softmax by Adagrad on batches; returns weights by bucket and the bias."""
    rng = np.random.default_rng(seed)
    known, ids = np.unique(np.concatenate(bags), return_inverse=True)
    lengths = np.array([len(b) for b in bags])
    first = np.cumsum(lengths) - lengths
    table = rng.normal(0, 0.1, (len(known), WIDTH))
    matrix, bias = rng.normal(0, 0.5, (WIDTH, 2)), np.zeros(2)
    sums = [np.full_like(x, 1e-6) for x in (table, matrix, bias)]
    share = np.where(toxic == 1, 0.5 / max(1, toxic.sum()), 0.5 / max(1, (1 - toxic).sum()))
    batches = max(1, len(bags) // 1024)
    for _ in range(max(rounds, MIN_STEPS // batches)):
        for batch in np.array_split(rng.permutation(len(bags)), batches):
            n = lengths[batch]
            rows = ids[np.repeat(first[batch] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
            owner = np.repeat(np.arange(len(batch)), n)
            size = np.maximum(n, MIN_GRAMS)[:, None]
            mean = np.add.reduceat(table[rows], np.cumsum(n) - n) / size
            z = mean @ matrix + bias
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(batch)), toxic[batch]] -= 1
            delta = p * share[batch][:, None] * len(bags)
            back = (delta @ matrix.T) / size
            used, slot = np.unique(rows, return_inverse=True)
            grad = np.stack([np.bincount(slot, weights=back[owner, d]) for d in range(WIDTH)], 1)
            sums[0][used] += grad ** 2
            table[used] -= 0.3 * grad / np.sqrt(sums[0][used])
            for value, total, g in ((matrix, sums[1], mean.T @ delta), (bias, sums[2], delta.sum(0))):
                total += g ** 2
                value -= 0.05 * g / np.sqrt(total)
    weight = np.zeros(1 << BITS)
    weight[known] = table @ (matrix[:, 1] - matrix[:, 0])
    return weight, float(bias[1] - bias[0])


def _passage_logits(bags: list[np.ndarray], weight: np.ndarray, bias: float) -> np.ndarray:
    return np.array([weight[b].sum() / max(len(b), MIN_GRAMS) for b in bags]) + bias


def fit(texts: np.ndarray, toxic: np.ndarray, bags: list[np.ndarray], rounds: int = 4,
        seed: int = 11) -> Model:
    """``bags`` are passages, ``texts`` the text of each and ``toxic`` the label of that text."""
    if not len(bags) or toxic.min() == toxic.max():
        return Model(np.zeros(1 << BITS), 0.0)
    bad, good = np.flatnonzero(toxic == 1), np.flatnonzero(toxic == 0)

    def presence(rows: np.ndarray) -> np.ndarray:
        return np.bincount(np.concatenate([np.unique(bags[i]) for i in rows]),
                           minlength=1 << BITS)

    seen, clean = presence(bad), presence(good)
    odds = np.log((seen + 0.5) / (len(bad) + 1)) - np.log((clean + 0.5) / (len(good) + 1))
    odds[seen < 3] = 0
    z = np.array([np.sort(odds[bags[i]])[-8:].mean() for i in bad])
    _, group = np.unique(texts[bad], return_inverse=True)

    def tops(z: np.ndarray) -> np.ndarray:
        best = np.full(group.max() + 1, -np.inf)
        np.maximum.at(best, group, z)
        return best[group]

    # at first the top passage of each text and those like them, later those the model finds
    # toxic, against some clean passages and all that the model took for toxic so far
    chosen, hard = bad[z >= np.minimum(tops(z), np.median(tops(z)))], np.empty(0, np.int64)
    some = np.random.default_rng(seed).permutation(good)[:max(4 * len(chosen), len(good) // 4)]
    model = None
    for r in range(rounds):
        rows = np.concatenate([chosen, np.union1d(some, hard)])
        model = _fit_softmax([bags[i] for i in rows], toxic[rows], 6, seed + r)
        z = _passage_logits(bags, *model)
        hard = np.union1d(hard, good[z[good] > -1])
        top = tops(z[bad])
        chosen = bad[(z[bad] > 0) | (z[bad] == top) & (top > -2)]
        if not len(chosen):
            break
    return Model(*model)


def calibrated(model: Model, logits: np.ndarray, toxic: np.ndarray, share: float = 0.5,
               rounds: int = 2000) -> Model:
    """Slope and shift of the score by logistic regression on the logits of labelled texts,
    weighted as if ``share`` of them were toxic."""
    if not len(logits) or toxic.min() == toxic.max():
        return model
    middle, spread = logits.mean(), logits.std() + 1e-9
    x, a, b = (logits - middle) / spread, 1.0, 0.0
    weight = np.where(toxic == 1, share / toxic.mean(), (1 - share) / (1 - toxic.mean()))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        a -= 0.5 * ((weight * (p - toxic) * x).mean() + 1e-4 * a)
        b -= 0.5 * (weight * (p - toxic)).mean()
    return Model(model.weight, model.bias, a / spread, b - a * middle / spread)


def train(docs: DataFrame, labels: DataFrame, max_texts: int = MAX_TEXTS) -> Model:
    """Fits on at most ``max_texts`` texts of either class; ``labels`` has doc_id and toxic."""
    marked = (labels.select(F.col("doc_id").cast("long").alias("doc_id"),
                            F.col("toxic").cast("int").alias("toxic"))
              .dropna().where("toxic IN (0, 1)").distinct())
    sample = None
    for value in (0, 1):
        part = (marked.where(F.col("toxic") == value)
                .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_texts))
        sample = part if sample is None else sample.union(part)
    # twice max_texts rows of two numbers
    chosen = documents(docs).join(F.broadcast(sample), "doc_id")
    toxic_of = {r.doc_id: r.toxic for r in sample.collect()}

    def passages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, data, offsets in byte_batches(batches):
            bucket, passage, ends = ngrams(data, offsets)
            order = np.argsort(passage, kind="stable")
            cuts = np.searchsorted(passage[order], np.arange((ends[-1] if len(ends) else 0) + 1))
            rows = []
            for i, (low, high) in enumerate(zip(np.append(0, ends[:-1]), ends)):
                some = np.arange(low, high)
                if len(some) > MAX_PASSAGES:
                    rng = np.random.default_rng(abs(ids[i]))
                    some = np.sort(rng.permutation(some)[:MAX_PASSAGES])
                rows += [(ids[i], bucket[order[cuts[p]:cuts[p + 1]]].astype("<i4").tobytes())
                         for p in some if cuts[p + 1] > cuts[p]]
            yield pa.RecordBatch.from_pydict({"doc_id": pa.array([r[0] for r in rows], pa.int64()),
                                              "bag": pa.array([r[1] for r in rows], pa.binary())})

    found = (chosen.select("doc_id", "text").mapInArrow(passages, "doc_id long, bag binary")
             .toArrow().sort_by([("doc_id", "ascending"), ("bag", "ascending")]))
    texts = found.column("doc_id").to_numpy()
    bags = [np.frombuffer(b, dtype="<i4") for b in found.column("bag").to_pylist()]
    model = fit(texts, np.array([toxic_of[t] for t in texts.tolist()], dtype=np.int64), bags)
    rows = _logits(chosen, model).toArrow().sort_by("doc_id")
    logits = rows.column("logit").to_numpy()
    order = rows.column("doc_id").to_pylist()
    share = marked.agg(F.avg("toxic")).first()[0]
    return calibrated(model, logits, np.array([toxic_of[i] for i in order], dtype=np.int64), share)


def _logits(docs: DataFrame, model: Model) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, data, offsets in byte_batches(batches, 1 << 20):
            z = shared.value.logits(data, offsets)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(z), pa.array(shared.value.score(z))],
                ["doc_id", "logit", "score"])

    return documents(docs).mapInArrow(run, "doc_id long, logit double, score double")


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score, predicted) of each row of ``docs``; predicted is 1 from a score of 0.5 on.

    Defined cases: a null or empty text scores as an empty bag; repeated rows are returned as
    often as they come; a null doc_id stays null; an empty table gives no rows; without labels of
    both classes every score is 0.5; other columns are ignored.
    """
    return _logits(docs, model).select(
        "doc_id", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
