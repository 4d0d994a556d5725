"""Quality classifier: attention-based multiple-instance learning over the passages of a text."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from tidelake.llm.bytewords import BLANK, Pieces, pieces, word_hashes, word_starts
from tidelake.llm.common import taught, whole

#: Words of a passage.
PASSAGE = 64
#: Most labelled documents that the model learns from, those with the smallest hash of their id.
SAMPLE = 4096
#: Bytes of encoded passages that the model learns from at most, and of one document's.
BYTES, TEXT_BYTES = 96 << 20, 8 << 20
HIDDEN, EPOCHS, BATCH, RATE, DECAY, SEED = 16, 30, 32, 3e-3, 1e-4, 7

#: Shapes of bytes; neighbouring shapes are counted.
SHAPES = 16
SHAPE = np.full(256, 15, np.uint8)
for _shape, _bytes in enumerate(
    (b" ", b"\t\n\x0b\x0c\r", b"aeiouy", b"bcdfghjklmnpqrstvwxz", b"AEIOUY", b"BCDFGHJKLMNPQRSTVWXZ", b"0123456789", b".", b",", b"!?", b"|", b"#$%&*@^~+", b"'\"()[]{}<>`", b"-_:;/=\\")
):
    SHAPE[list(_bytes)] = _shape
SHAPE[0x80:0xC0] = 14
EXTRA = 4
WIDTH = SHAPES * SHAPES + EXTRA


def encode(p: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """A vector for every passage, and the piece it is of; a piece without words is one passage.

    Square roots of the shares of neighbouring byte shapes; shares of words that repeat one of the four before and of different words;
    mean length of words; how full the passage is.
    """
    n = len(p.ends) - 1
    sizes = np.diff(p.ends)
    starts, piece = word_starts(p)
    words = np.bincount(piece, minlength=n)
    first = np.concatenate([[0], np.cumsum(words)])
    count = np.maximum(1, -(-words // PASSAGE))
    base = np.concatenate([[0], np.cumsum(count)])
    total = int(base[-1])
    of_word = base[piece] + (np.arange(len(starts)) - first[piece]) // PASSAGE
    # Each byte belongs to the passage of the last word begun, or to its piece's first.
    step = np.zeros(len(p.data) + 1, np.int64)
    heads = p.ends[:-1][sizes > 0]
    step[heads] = base[:-1][sizes > 0]
    step[starts] = np.maximum(step[starts], of_word)
    of_byte = np.maximum.accumulate(step[:-1])
    shape = SHAPE[p.data]
    after = np.append(shape[1:], 1)
    after[p.ends[1:][sizes > 0] - 1] = 1
    pairs = np.bincount(of_byte * (SHAPES * SHAPES) + shape * np.int64(SHAPES) + after, minlength=total * SHAPES * SHAPES)
    pairs = pairs.reshape(total, -1).astype(np.float32)
    held = np.bincount(of_word, minlength=total)
    seen = word_hashes(np.where(BLANK[p.data], 0, p.data), starts)
    again = np.zeros(len(starts), bool)
    for lag in range(1, 5):
        again[lag:] |= (seen[lag:] == seen[:-lag]) & (piece[lag:] == piece[:-lag])
    _, one = np.unique(seen ^ (of_word.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), return_index=True)
    some = np.maximum(held, 1)
    vectors = np.empty((total, WIDTH), np.float32)
    letters = np.maximum(pairs.sum(1, keepdims=True), 1)
    vectors[:, :-EXTRA] = np.sqrt(pairs / letters)
    vectors[:, -4] = np.bincount(of_word, again, total) / some
    vectors[:, -3] = np.bincount(of_word[one], minlength=total) / some
    vectors[:, -2] = np.minimum(letters[:, 0] / some / 16, 4) * (held > 0)
    vectors[:, -1] = held / PASSAGE
    return vectors, np.repeat(np.arange(n), count)


@dataclass
class Attention:
    """Gated attention: a passage's weight is softmax(w . (tanh(V h) * sigmoid(U h))), a text's vector the weighted sum."""

    mean: np.ndarray
    scale: np.ndarray
    v: np.ndarray
    u: np.ndarray
    w: np.ndarray
    out: np.ndarray
    bias: np.ndarray

    def pooled(self, vectors: np.ndarray, bag: np.ndarray, bags: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each bag: the largest attention, the sum of weights below it, and the weighted sum of vectors."""
        h = (vectors - self.mean) / self.scale
        with np.errstate(over="ignore"):
            a = (np.tanh(h @ self.v) / (1 + np.exp(-(h @ self.u)))) @ self.w
        starts = np.searchsorted(bag, np.arange(bags))
        most = np.maximum.reduceat(a, starts)
        e = np.exp(a - most[bag])
        return most, np.add.reduceat(e, starts), np.add.reduceat(e[:, None] * h, starts, axis=0)


def fit(bags: list[np.ndarray], labels: np.ndarray) -> Attention:
    """Adam on the labels' cross-entropy; both labels weigh alike up to a factor of four. Equal input gives an equal model."""
    rng = np.random.default_rng(SEED)
    every = np.concatenate(bags) if bags else np.zeros((1, WIDTH), np.float32)
    mean, scale = every.mean(0), every.std(0) + np.float32(0.02)
    shapes = {"v": (WIDTH, HIDDEN), "u": (WIDTH, HIDDEN), "w": (HIDDEN,), "out": (WIDTH,), "bias": (1,)}
    p = {k: rng.normal(0, 0.05, s).astype(np.float32) * (k not in ("out", "bias")) for k, s in shapes.items()}
    share = np.clip(labels.mean(), 0.01, 0.99) if len(labels) else 0.5
    if len(labels) == 0 or labels.min() == labels.max():
        p["bias"][:] = np.log(share / (1 - share))
        return Attention(mean, scale, **p)
    heavy = float(min(4, max(share, 1 - share) / min(share, 1 - share)))
    cost = np.where(labels == (share < 0.5), heavy, 1.0)
    first, second, t = {k: 0.0 for k in p}, {k: 0.0 for k in p}, 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(bags))
        for start in range(0, len(order), BATCH):
            rows = order[start : start + BATCH]
            sizes = np.array([len(bags[r]) for r in rows])
            heads = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            bag = np.repeat(np.arange(len(rows)), sizes)
            h = (np.concatenate([bags[r] for r in rows]) - mean) / scale
            tanh, gate = np.tanh(h @ p["v"]), 1 / (1 + np.exp(-np.clip(h @ p["u"], -30, 30)))
            a = (tanh * gate) @ p["w"]
            e = np.exp(a - np.maximum.reduceat(a, heads)[bag])
            e /= np.add.reduceat(e, heads)[bag]
            z = np.add.reduceat(e[:, None] * h, heads, axis=0)
            score = 1 / (1 + np.exp(-np.clip(z @ p["out"] + p["bias"], -30, 30)))
            delta = ((score - labels[rows]) * cost[rows] / len(rows)).astype(np.float32)
            # Through the softmax: a passage's attention moves the score by how its output differs from the bag's.
            outs = h @ p["out"]
            da = delta[bag] * e * (outs - (z @ p["out"])[bag])
            dt, dg = da[:, None] * p["w"] * gate * (1 - tanh**2), da[:, None] * p["w"] * tanh * gate * (1 - gate)
            grads = {"v": h.T @ dt, "u": h.T @ dg, "w": (tanh * gate).T @ da, "out": z.T @ delta, "bias": delta.sum(keepdims=True)}
            t += 1
            for k, g in grads.items():
                g = g + DECAY * p[k] * (k != "bias")
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                p[k] = (p[k] - RATE * (first[k] / (1 - 0.9**t)) / (np.sqrt(second[k] / (1 - 0.999**t)) + 1e-8)).astype(np.float32)
    return Attention(mean, scale, **p)


def _encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every row's passages as the bytes of 32-bit floats."""
    for batch in batches:
        rows: list[list[np.ndarray]] = [[] for _ in range(batch.num_rows)]
        for p in pieces(batch.column("text")):
            vectors, piece = encode(p)
            for k, row in enumerate(p.row):
                rows[row].append(vectors[piece == k])
        bags = [np.concatenate(r).tobytes() for r in rows]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("label"), pa.array(bags, pa.binary())], names=["doc_id", "label", "bag"]
        )


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Attention:
    """A model of ``labels.quality``, learnt from ``sample`` labelled documents at most that are not held out, and from ``BYTES`` of their passages.

    Ids that are null, or that carry both labels, teach nothing; of an id's rows one does. Without a labelled document every text scores one half.
    """
    rows = taught(docs, labels, "quality", sample, _encoded, "bag", BYTES, TEXT_BYTES)
    bags = [np.frombuffer(r["bag"], np.float32).reshape(-1, WIDTH) for r in rows]
    return fit(bags, np.array([r["label"] for r in rows], np.float32))


def _scorer(model: Attention):
    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            most, weight, z = np.full(n, -np.inf), np.zeros(n), np.zeros((n, WIDTH))
            for p in pieces(batch.column("text")):
                vectors, piece = encode(p)
                m, e, s = model.pooled(vectors, piece, len(p.row))
                # A long text comes in pieces, whose sums are brought to one largest attention.
                new = np.maximum(most[p.row], m)
                old, add = np.exp(most[p.row] - new), np.exp(m - new)
                weight[p.row] = weight[p.row] * old + e * add
                z[p.row] = z[p.row] * old[:, None] + s * add[:, None]
                most[p.row] = new
            logit = (z / weight[:, None]) @ model.out.astype(float) + float(model.bias[0])
            score = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
            kept = [batch.column(c) for c in batch.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(score)], names=[*(c for c in batch.schema.names if c != "text"), "score"])

    return scored


def score(docs: DataFrame, model: Attention) -> DataFrame:
    """``doc_id, text_key, score`` for every row of ``docs``: how likely label 1 is for the whole text, 0 to 1.

    A text's score depends on its bytes only: not on id, source, language or the rows beside it. A null text is an
    empty one. Rows repeated or without an id are rows of their own. ``text_key`` is the text's md5. No shuffle.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole("text").alias("text"))
    rows = rows.select("doc_id", F.md5("text").alias("text_key"), "text")
    return rows.mapInArrow(_scorer(model), "doc_id long, text_key string, score double")


def _keeper(model: Attention, least: float, at: int):
    scored = _scorer(model)

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.RecordBatch.from_arrays([batch.column(at).fill_null("")], names=["text"])
            for scores in scored(iter([texts])):
                yield batch.filter(pc.greater_equal(scores.column("score"), least))

    return kept


def keep_good(docs: DataFrame, labels: DataFrame, least: float = 0.7, sample: int = SAMPLE) -> DataFrame:
    """``docs`` whose text scores ``least`` or more; columns as they are, repeated rows and null ids included.

    Null and empty texts score alike. Rows pass through the scoring map with all their columns, so nothing is joined or shuffled.
    """
    # Numbered, as names may hold dots.
    rows = docs.toDF(*[f"c{n}" for n in range(len(docs.columns))])
    keep = _keeper(train(docs, labels, sample), least, docs.columns.index("text"))
    return rows.mapInArrow(keep, rows.schema).toDF(*docs.columns)
