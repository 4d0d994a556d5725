"""Toxicity: a factorization machine over hashed terms."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from tidelake.llm.bytewords import LETTER, PIECE, word_hashes
from tidelake.llm.common import cut, held_out, taught, whole

#: Terms of a word: the whole of it and its first bytes, as inflected words share their stem.
PREFIXES = (None, 4, 5, 6)
#: Most labelled documents that the model learns from, those with the smallest hash of their id.
SAMPLE = 8192
FACTORS, EPOCHS, BATCH, RATE, SEED = 8, 40, 64, 0.02, 11
#: Bytes of terms that the model learns from at most, and of one document's.
BYTES, TEXT_BYTES = 96 << 20, 4 << 20
#: Words that a task remembers as it scores.
KNOWN = 1 << 19
#: Slots that the terms are hashed into, each with a weight and factors.
SLOTS = 1 << 18
#: What an epoch takes from each weight and from the length of each slot's factors, before Adagrad's scale. Chosen, as epochs and batch, by a quarter
#: of the taught documents that a trial did not learn from.
LESS_WEIGHT, LESS_FACTORS = 0.02, 0.2
#: Adagrad's first scales, for each term of a mean text: many terms move together.
FIRST_WEIGHT, FIRST_FACTORS = 2e-4, 2.4e-4


def _term_hashes(values: np.ndarray, starts: np.ndarray) -> Iterator[np.ndarray]:
    """Slots of the words, then of each prefix; a word and its own prefix are terms of their own."""
    for n, prefix in enumerate(PREFIXES):
        yield (word_hashes(values, starts, prefix) >> np.uint64(32)).astype(np.uint32) + np.uint32(n) & np.uint32(SLOTS - 1)


def _words_of(texts: pa.Array) -> list[set[bytes]]:
    """The different words of every text: runs of non-blanks, A-Z in lower case."""
    return [set(text.lower().split()) for text in texts.cast(pa.binary()).to_pylist()]


def _slots_of(words: list[bytes]) -> np.ndarray:
    """The slots of each word's terms, a row each."""
    data = np.frombuffer(b" ".join(words), np.uint8)
    starts = np.cumsum([0, *(len(w) + 1 for w in words[:-1])]) if words else np.empty(0, np.int64)
    return np.column_stack(list(_term_hashes(LETTER[data], starts))) if words else np.empty((0, len(PREFIXES)), np.uint32)


def _distinct_terms(column) -> list[np.ndarray]:
    """The different terms of every row, sorted."""
    texts = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    terms: list[np.ndarray] = []
    for start, stop in cut(pc.binary_length(texts).to_numpy(zero_copy_only=False), PIECE):
        found = _words_of(texts.slice(start, stop - start))
        every = list(set().union(*found))
        number, slots = {w: n for n, w in enumerate(every)}, _slots_of(every)
        terms += [np.unique(slots[[number[w] for w in words]]) if words else np.empty(0, np.uint32) for words in found]
    return terms


@dataclass
class Machine:
    """``bias + sum of weights + half of (square of the summed factors - sum of their squares)`` over a text's terms."""

    terms: np.ndarray
    weights: np.ndarray
    factors: np.ndarray
    bias: float

    def __post_init__(self) -> None:
        self.passes = np.zeros(SLOTS, bool)
        self.passes[self.terms & np.uint32(SLOTS - 1)] = True

    def places(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which hashes are terms, and of which number."""
        some = np.flatnonzero(self.passes[hashes & np.uint32(SLOTS - 1)])
        at = np.minimum(np.searchsorted(self.terms, hashes[some]), max(len(self.terms) - 1, 0))
        true = self.terms[at] == hashes[some] if len(self.terms) else np.zeros(len(some), bool)
        return some[true], at[true]

    def logits(self, rows: np.ndarray, places: np.ndarray, n: int) -> np.ndarray:
        """Of ``n`` texts, from distinct pairs of text and term."""
        linear = np.bincount(rows, self.weights[places], n)
        cross = np.zeros(n)
        for factor in self.factors.T:
            cross += np.bincount(rows, factor[places], n) ** 2 - np.bincount(rows, factor[places] ** 2, n)
        return self.bias + linear + cross / 2


@dataclass
class _Batch:
    """Some texts as sparse rows: ``slots`` that occur, ``places`` in them row by row, and the rows of each slot one after the other."""

    texts: np.ndarray
    full: np.ndarray
    slots: np.ndarray
    places: np.ndarray
    heads: np.ndarray
    rows: np.ndarray
    slot_heads: np.ndarray

    @classmethod
    def of(cls, texts: np.ndarray, terms: list[np.ndarray], names: np.ndarray) -> _Batch:
        sizes = np.array([len(t) for t in terms])
        slots, places = np.unique(np.concatenate(terms), return_inverse=True)
        by = np.argsort(places, kind="stable")
        rows = np.repeat(np.arange(len(terms)), sizes)[by].astype(np.int32)
        full = np.flatnonzero(sizes)
        heads = (np.cumsum(sizes) - sizes)[full]
        return cls(texts, full, np.searchsorted(names, slots), places.astype(np.int32), heads, rows, np.searchsorted(places[by], np.arange(len(slots))))

    def by_text(self, values: np.ndarray) -> np.ndarray:
        sums = np.zeros((len(self.texts), *values.shape[1:]))
        if len(self.full):
            sums[self.full] = np.add.reduceat(values[self.places], self.heads, axis=0)
        return sums

    def by_slot(self, values: np.ndarray) -> np.ndarray:
        return np.add.reduceat(values[self.rows], self.slot_heads, axis=0) if len(self.slots) else values[:0]


def fit(texts: list[np.ndarray], labels: np.ndarray) -> Machine:
    """Adagrad on the labels' cross-entropy; label 1, the rarer, weighs up to four times. Equal input gives an equal model.

    Every slot that occurs learns a weight and factors, by the texts it is in; each epoch shrinks all of them, and a slot
    that comes out of one without either is left out from then on.
    """
    share = np.clip(labels.mean(), 1e-3, 1 - 1e-3) if len(labels) else 0.5
    bias = float(np.log(share / (1 - share)))
    told = len(labels) and labels.min() < labels.max()
    used = np.zeros(SLOTS, bool)
    for t in texts if told else []:
        used[t] = True
    names = np.flatnonzero(used).astype(np.uint32)
    mean = max(1.0, sum(len(t) for t in texts) / max(1, len(texts)))
    rng = np.random.default_rng(SEED)
    # Small enough that the pairs of a mean text nearly cancel out.
    factors = rng.normal(0, min(0.05, np.sqrt(0.1 / mean)), (len(names), FACTORS)).astype(np.float32)
    weights = np.zeros(len(names), np.float32)
    if not len(names):
        return Machine(names, weights, factors, bias)
    cost = np.where(labels == 1, min(4.0, (1 - share) / share), 1.0)
    order = rng.permutation(len(texts))
    parts = [order[start : start + BATCH] for start in range(0, len(order), BATCH)]
    batches = [_Batch.of(part, [texts[k] for k in part], names) for part in parts]
    weight_sums = np.full(len(names), (FIRST_WEIGHT * mean) ** 2, np.float32)
    factor_sums = np.full(factors.shape, (FIRST_FACTORS * mean) ** 2, np.float32)
    bias_sum = 1e-2
    for _ in range(EPOCHS):
        for number in rng.permutation(len(batches)):
            b = batches[number]
            w, v = weights[b.slots], factors[b.slots]
            inner = b.by_text(v)
            logit = bias + b.by_text(w) + ((inner**2).sum(1) - b.by_text((v**2).sum(1))) / 2
            delta = (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - labels[b.texts]) * cost[b.texts] / len(b.texts)
            # d logit / d v_if = x_i (sum_j v_jf x_j - v_if x_i); x is 0 or 1.
            sums = b.by_slot(np.column_stack([delta, delta[:, None] * inner]).astype(np.float32))
            dw, dv, db = sums[:, 0], sums[:, 1:] - sums[:, :1] * v, delta.sum()
            weight_sums[b.slots] += dw**2
            factor_sums[b.slots] += dv**2
            bias_sum += db**2
            weights[b.slots] -= 5 * RATE * dw / np.sqrt(weight_sums[b.slots])
            factors[b.slots] -= RATE * dv / np.sqrt(factor_sums[b.slots])
            bias -= RATE * db / np.sqrt(bias_sum)
        weights = np.sign(weights) * np.maximum(np.abs(weights) - 5 * RATE * LESS_WEIGHT / np.sqrt(weight_sums), 0)
        length = np.sqrt((factors**2).sum(1)) + 1e-12
        factors *= np.maximum(0, 1 - RATE * LESS_FACTORS / np.sqrt(factor_sums.mean(1)) / length)[:, None]
        left = np.flatnonzero((weights != 0) | (factors != 0).any(1))
        if len(left) < 0.7 * len(names):
            names, weights, factors, weight_sums, factor_sums = (a[left] for a in (names, weights, factors, weight_sums, factor_sums))
            held = np.zeros(SLOTS, bool)
            held[names] = True
            texts = [t[held[t]] for t in texts]
            batches = [_Batch.of(part, [texts[k] for k in part], names) for part in parts]
    left = np.flatnonzero((weights != 0) | (factors != 0).any(1))
    return Machine(names[left], weights[left].astype(float), factors[left], float(bias))


def _terms_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        terms = [t.astype("<u4").tobytes() for t in _distinct_terms(batch.column("text"))]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("label"), pa.array(terms, pa.binary())], names=["doc_id", "label", "terms"]
        )


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Machine:
    """A model of ``labels.toxic``, learnt from ``sample`` labelled documents at most that are not held out, and from ``BYTES`` of their terms.

    Ids that are null, or that carry both labels, teach nothing; of an id's rows one does. Without both labels every text scores their share, or one half.
    """
    rows = taught(docs, labels, "toxic", sample, _terms_of, "terms", BYTES, TEXT_BYTES)
    return fit([np.frombuffer(r["terms"], "<u4") for r in rows], np.array([r["label"] for r in rows], float))


def _scorer(model: Machine):
    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Each different word is hashed once; few of them have a term of the model.
        seen: set[bytes] = set()
        places_of: dict[bytes, list[int]] = {}
        for batch in batches:
            texts, scores = batch.column("text"), []
            for start, stop in cut(pc.binary_length(texts).to_numpy(zero_copy_only=False), PIECE):
                found = _words_of(texts.slice(start, stop - start))
                if len(seen) > KNOWN:
                    seen, places_of = set(), {}
                new = list(set().union(*found) - seen)
                seen.update(new)
                slots = _slots_of(new)
                some, places = model.places(slots.ravel())
                for word, place in zip((some // slots.shape[1]).tolist(), places.tolist(), strict=True):
                    places_of.setdefault(new[word], []).append(place)
                told = [sorted({p for w in words & places_of.keys() for p in places_of[w]}) for words in found]
                rows = np.repeat(np.arange(len(told)), [len(t) for t in told])
                logit = model.logits(rows, np.fromiter(chain.from_iterable(told), np.int64), len(told))
                scores.append(1 / (1 + np.exp(-np.clip(logit, -30, 30))))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.concatenate([*scores, np.empty(0)]))], names=["doc_id", "score"])

    return scored


def score(docs: DataFrame, model: Machine) -> DataFrame:
    """``doc_id, score`` for every row of ``docs``: how likely label 1 is for the whole text, 0 to 1.

    A score depends on the text's words only: letters and bytes beyond ASCII of runs of non-blanks, A-Z lower-cased, each term once. A
    null text is an empty one. Rows repeated or without an id are rows of their own; other columns are ignored. No shuffle.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole("text").alias("text"))
    return rows.mapInArrow(_scorer(model), "doc_id long, score double")
