"""Document fingerprints by a randomised edit embedding.

A shared random walk reads a text: at step j it emits the character it stands on and moves to the next one if a random bit
of (j, character) says so. Two texts that differ by an edit fall into step again soon, so their emitted strings have a small
Hamming distance where the texts have a small edit distance (Chakraborty, Goldenberg and Koucky, 2016). A fingerprint
samples places of the emitted string; bands of sampled places find candidates, the share of equal places verifies them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidelake.llm.common import cut, utf8, whole
from tidelake.session import staged

#: Sampled places; each gives one byte, two digits of the fingerprint.
PLACES = 64
#: Bands, and the sampled places that each compares.
BANDS, BAND_PLACES = 16, 4
#: Random bits repeat after so many steps; characters share them by class.
PERIOD, CLASSES = 1 << 13, 64
#: Code points that a task walks at once; a longer text is walked alone.
CHUNK = 1 << 21
#: Walks that are stepped together at least; fewer are walked one by one.
TOGETHER = 32


def _stays() -> np.ndarray:
    """Steps that a walk stays on a character of each class, by the step at which it comes there."""
    bits = np.random.default_rng(20160620).integers(0, 2, (CLASSES, PERIOD), np.uint8)
    bits[:, 0] = 1  # a walk leaves within a period
    stays = np.empty((CLASSES, PERIOD), np.uint8)
    ahead = np.ones(CLASSES, np.int64)
    for _ in range(2):  # the second round knows what follows the period's end
        for j in range(PERIOD - 1, -1, -1):
            ahead = np.where(bits[:, j] == 1, 1, ahead + 1)
            stays[:, j] = np.minimum(ahead, 255)
    return stays


def _records() -> list[np.ndarray]:
    """For each sampled place, where it lies by the length of what is sampled.

    It is the place of the least of random numbers below that length: uniform, and for two lengths the same with the ratio of
    the shorter to the longer as chance. Only the places where a new least comes up matter; their gaps are geometric.
    """
    rng, result = np.random.default_rng(512), []
    for _ in range(PLACES):
        at, least, places = 0, rng.random(), [0]
        while at < 1 << 40:
            at += int(rng.geometric(max(least, 1e-13)))
            least *= rng.random()
            places.append(at)
        result.append(np.array(places, np.int64))
    return result


STAYS, RECORDS = _stays(), _records()


def _classes(points: np.ndarray) -> np.ndarray:
    return ((points * np.uint32(0x9E3779B1)) >> np.uint32(26)).astype(np.uint8)


def walk(points: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The step at which each character is reached, and the step at which each text is left."""
    classes = _classes(points)
    lengths = np.diff(ends)
    order = np.argsort(-lengths, kind="stable")
    starts, sizes = ends[:-1][order], lengths[order]
    steps, reached = np.zeros(len(order), np.int64), np.empty(len(points), np.int32)
    flat, i = STAYS.ravel(), 0
    active = int(np.searchsorted(-sizes, 0))  # texts of more than i characters
    while active >= TOGETHER:
        # Until the shortest active text ends, the same texts go on.
        heads, now = starts[:active], steps[:active]
        for i in range(i, int(sizes[active - 1])):
            at = heads + i
            reached[at] = now
            now += flat[(classes[at].astype(np.int64) << 13) | (now & (PERIOD - 1))]
        i = int(sizes[active - 1])
        active = int(np.searchsorted(-sizes, -i))
    table = [row.tobytes() for row in STAYS]
    for k in range(active):
        now, times = int(steps[k]), []
        for c in classes[starts[k] + i : starts[k] + sizes[k]].tobytes():
            times.append(now)
            now += table[c][now & (PERIOD - 1)]
        reached[starts[k] + i : starts[k] + sizes[k]] = times
        steps[k] = now
    left = np.empty(len(order), np.int64)
    left[order] = steps
    return reached, left


def prints(points: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A row of ``PLACES`` bytes for each text; those of an empty text are 0."""
    reached, left = walk(points, ends)
    n = len(ends) - 1
    lengths = np.diff(ends)
    places = np.empty((n, PLACES), np.int64)
    for k, record in enumerate(RECORDS):
        # Twice its length: the steps that a walk takes on average.
        places[:, k] = record[np.searchsorted(record, np.maximum(2 * lengths - 1, 0), side="right") - 1]
    result = np.zeros((n, PLACES), np.uint8)
    for row in range(n):
        start, end = ends[row], ends[row + 1]
        if end > start:
            at = start + np.searchsorted(reached[start:end], places[row], side="right") - 1
            symbols = (points[at] * np.uint32(0x85EBCA6B)) >> np.uint32(24)
            result[row] = np.where(places[row] < left[row], symbols, 0)
    return result


def _points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    return (
        np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32),
        np.concatenate([[0], np.cumsum([len(t) for t in texts], dtype=np.int64)]).astype(np.int64),
    )


def fingerprint(texts: list[str]) -> np.ndarray:
    """The fingerprints of texts, a bounded number of characters at a time."""
    parts = [prints(*_points(texts[a:b])) for a, b in cut(np.array([len(t) for t in texts]), CHUNK)]
    return np.concatenate(parts) if parts else np.empty((0, PLACES), np.uint8)


def edited(text: str, after: str) -> str:
    """``text`` with its last half, rounded down, replaced by the first as many characters of ``after``."""
    half = len(text) // 2
    return text[: len(text) - half] + after[:half]


def _rows(ids: list, texts: list[str], more: list[str]) -> dict[str, list]:
    """Columns of the result for texts and the texts that follow them."""
    changed = [edited(t, a) for t, a in zip(texts, more, strict=True)]
    own = fingerprint([*texts, more[-1]])
    new = fingerprint(changed)
    following = own[1:]
    return {
        "doc_id": ids,
        "n_chars": [len(t) for t in texts],
        "edited_sha256": [hashlib.sha256(t.encode()).hexdigest() for t in changed],
        "fingerprint": [p.tobytes().hex() for p in own[:-1]],
        "edited_fingerprint": [p.tobytes().hex() for p in new],
        "near_edited": (own[:-1] == new).mean(1).tolist(),
        "near_next": (own[:-1] == following).mean(1).tolist(),
    }


RESULT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
_ARROW = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), *[(c, pa.string()) for c in ("edited_sha256", "fingerprint", "edited_fingerprint")], ("near_edited", pa.float64()), ("near_next", pa.float64())])
_EDGE = pa.schema([*_ARROW, ("part", pa.int32()), ("tie", pa.int64()), ("edge", pa.string())])


def _sorted_part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All rows of a sorted part but the last, each with the next; the first and the last as edges, without a result."""
    held: list = []
    first = last = None

    def edge(row: tuple, name: str) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([{"doc_id": row[0], "part": row[2], "tie": row[3], "edge": name}], schema=_EDGE)

    for batch in batches:
        rows = list(zip(*[batch.column(c).to_pylist() for c in ("doc_id", "text", "part", "tie")], strict=True))
        for start, end in cut(np.diff(utf8(batch.column("text"))[1]), CHUNK):
            held += rows[start:end]
            if first is None:
                first = held[0]
                yield edge(first, "first")
            if len(held) > 1:
                ids, texts = [r[0] for r in held[:-1]], [r[1] for r in held]
                yield pa.RecordBatch.from_pydict(_rows(ids, texts[:-1], texts[1:]) | {"part": [None] * len(ids), "tie": [None] * len(ids), "edge": [None] * len(ids)}, schema=_EDGE)
            held = held[-1:]
    if held:
        yield edge(held[0], "last")


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows that carry the next text along."""
    for batch in batches:
        for k in range(batch.num_rows):
            row = {c: batch.column(c)[k].as_py() for c in ("doc_id", "text", "after")}
            yield pa.RecordBatch.from_pydict(_rows([row["doc_id"]], [row["text"]], [row["after"]]), schema=_ARROW)


def fingerprints_with_next(docs: DataFrame) -> DataFrame:
    """Fingerprints of every row's text and of its edited text, and how like the text's is to both that and the next row's.

    Columns as in ``RESULT``. The next row is the one with the next id; null ids come first, equal ids in order of a hash of their
    texts, and the first row follows the last (a single row follows itself). The edited text is ``edited(text, next text)``. A
    null text is an empty one, whose fingerprint is zero. Repeated rows are rows of their own; other columns are ignored.

    Texts are dealt out by ranges of ids, in one shuffle, and sorted within a range. Only the last row of a range lacks its successor:
    these rows, two for each range at most, are read again with their ids broadcast.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole("text").alias("text")).withColumn("tie", F.xxhash64("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.col("tie")]
    parts = rows.repartitionByRange(*order).withColumn("part", F.spark_partition_id()).sortWithinPartitions(*order)
    columns = RESULT + ", part int, tie long, edge string"
    done = staged(parts.mapInArrow(_sorted_part, columns), "editprint")
    edges = done.filter("edge IS NOT NULL").select("part", "edge", "doc_id", "tie")
    # As many rows as ranges: the first row of the next range that has any, or of the first.
    along, everything = Window.orderBy("part"), Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    key = F.struct("doc_id", "tie").alias("key")
    firsts = edges.filter("edge = 'first'").select("part", key)
    firsts = firsts.select("part", F.coalesce(F.lead("key").over(along), F.first("key").over(everything)).alias("after_key"))
    lasts = staged(edges.filter("edge = 'last'").select("part", key).join(firsts, "part"), "editprint-edges")
    keyed = rows.withColumn("key", F.struct("doc_id", "tie"))
    wanted = lasts.select("key").union(lasts.select("after_key")).distinct().withColumnRenamed("key", "wanted")
    texts = keyed.join(F.broadcast(wanted), keyed["key"].eqNullSafe(F.col("wanted"))).groupBy("key").agg(F.first("text").alias("text"))
    texts = staged(texts, "editprint-texts")
    own = lasts.join(texts, lasts["key"].eqNullSafe(texts["key"])).select(lasts["key"], "after_key", "text")
    after = texts.select(F.col("key").alias("next_key"), F.col("text").alias("after"))
    both = own.join(after, own["after_key"].eqNullSafe(after["next_key"])).select(F.col("key.doc_id").alias("doc_id"), "text", "after")
    names = [f.split()[0] for f in RESULT.split(", ")]
    return done.filter("edge IS NULL").select(*names).union(both.mapInArrow(_pairs, RESULT).select(*names))


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, fingerprint`` of every row; null texts are empty, rows repeated or without an id are rows of their own."""

    def printed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [p.tobytes().hex() for p in fingerprint(batch.column("text").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(own, pa.string())], names=["doc_id", "fingerprint"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole("text").alias("text"))
    return rows.mapInArrow(printed, "doc_id long, fingerprint string")


def bands(print_: Column) -> Column:
    """The bits that each band samples, with the band's number in front."""
    rng = np.random.default_rng(99)
    sampled = [sorted(rng.choice(PLACES, BAND_PLACES, replace=False).tolist()) for _ in range(BANDS)]
    return F.array(*[F.concat(F.lit(f"{b}:"), *[F.substring(print_, 2 * p + 1, 2) for p in s]) for b, s in enumerate(sampled)])


def likeness(a: Column, b: Column) -> Column:
    """The share of sampled places in which two fingerprints agree, 0 to 1."""
    same = [(F.substring(a, 2 * p + 1, 2) == F.substring(b, 2 * p + 1, 2)).cast("int") for p in range(PLACES)]
    total = same[0]
    for s in same[1:]:
        total = total + s
    return total / F.lit(float(PLACES))


def search(queries: DataFrame, printed: DataFrame, least: float = 0.8) -> DataFrame:
    """``query_print, fingerprint, likeness`` of all different fingerprints that share a band and are ``least`` alike.

    Both sides have a ``fingerprint`` for each text; equal ones are one row here, whose documents the caller has in ``printed``. ``queries``
    is a stated set. A band that many fingerprints share is split by Spark where it is skewed; the larger side is never listed in pairs with itself.
    """
    mine = queries.select(F.col("fingerprint").alias("query_print")).distinct()
    mine = mine.withColumn("band", F.explode(bands(F.col("query_print"))))
    all_ = printed.select("fingerprint").distinct()
    all_ = all_.withColumn("band", F.explode(bands(F.col("fingerprint"))))
    near = mine.join(all_, "band").select("query_print", "fingerprint").withColumn("likeness", likeness(F.col("query_print"), F.col("fingerprint")))
    return near.filter(F.col("likeness") >= least).distinct()
