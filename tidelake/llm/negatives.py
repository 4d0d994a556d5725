"""Hard negatives: for each anchor and positive the best rows of other labels within a range of scores that the positive's sets.

Anchors meet all rows in cells, of some anchors and some of the rows; a task holds a cell's anchors and lets the cell's rows pass by. The positives'
upper limits split an anchor's scores into disjoint slots, of which a task keeps the best few; a positive's range is its own slot and
the ones below, down to its lower limit, so merged slots answer all of an anchor's overlapping ranges at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidelake.llm.common import runs_of
from tidelake.session import staged

#: Anchors of a cell, rows of a cell at least, and cells at most: beyond, a cell has more rows.
ANCHORS, ROWS, CELLS = 1 << 17, 1 << 14, 1024
#: Anchors and rows whose scores are held at once.
TILE = (512, 4096)
NONE = np.iinfo(np.int64).min + 1


def quantised(embedding: Column, scale: int) -> Column:
    """``floor(scale * x)`` of every component as a double; null if the vector or a component is null, or one not finite.

    What lies beyond 64 bits becomes their largest or smallest number.
    """
    bad = F.exists(embedding, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(~bad, F.transform(embedding, lambda x: F.floor(x.cast("double") * scale)))


@dataclass
class _Anchors:
    """A cell's anchors whose vectors are of one length, and for each of their slots the best rows so far, by score, then by id."""

    place: np.ndarray
    vec_id: np.ndarray
    label: np.ndarray
    vectors: np.ndarray
    #: Upper limits from the largest to the smallest, and the smallest lower one; rows of other labels are looked for. Without: of the same.
    upper: np.ndarray | None
    lowest: np.ndarray | None
    keep: int

    def __post_init__(self) -> None:
        self.slots = 1 if self.upper is None else self.upper.shape[1]
        self.scores = np.full((len(self.place) * self.slots, self.keep), NONE)
        self.ids = np.zeros_like(self.scores)
        self.largest = _size(self.vectors)

    def meet(self, vec_id: np.ndarray, label: np.ndarray, vectors: np.ndarray) -> None:
        # Scores are exact in the smallest type that holds them all; beyond 64 bits they wrap.
        bound = self.largest * _size(vectors) * max(1, vectors.shape[1])
        kind = np.float32 if bound < 1 << 24 else np.float64 if bound < 1 << 53 else np.int64
        for a in range(0, len(self.place), TILE[0]):
            mine = slice(a, a + TILE[0])
            left = self.vectors[mine].astype(kind)
            for b in range(0, len(vec_id), TILE[1]):
                its = slice(b, b + TILE[1])
                self._tile(mine, left @ vectors[its].astype(kind).T, vec_id[its], label[its])

    def _tile(self, mine: slice, scores: np.ndarray, vec_id: np.ndarray, label: np.ndarray) -> None:
        same = self.label[mine, None] == label
        if self.upper is None:
            least = self.scores[mine, -1, None]
            hits = same & (self.vec_id[mine, None] != vec_id) & (scores >= least.astype(scores.dtype))
            row, column = np.nonzero(hits)
            found, slot = scores[row, column].astype(np.int64), row + mine.start
        else:
            upper = self.upper[mine]
            hits = ~same & (scores <= upper[:, :1].astype(scores.dtype)) & (scores >= self.lowest[mine, None].astype(scores.dtype))
            row, column = np.nonzero(hits)
            found = scores[row, column].astype(np.int64)
            # The last of the upper limits that a score does not exceed.
            slot = (row + mine.start) * self.slots + (found[:, None] <= upper[row]).sum(1) - 1
            some = found >= self.scores[slot, -1]
            found, slot, column = found[some], slot[some], column[some]
        if len(found):
            self._merge(slot, found, vec_id[column])

    def _merge(self, slot: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        touched, at = np.unique(slot, return_inverse=True)
        group = np.concatenate([np.repeat(np.arange(len(touched)), self.keep), at])
        scores = np.concatenate([self.scores[touched].ravel(), scores])
        ids = np.concatenate([self.ids[touched].ravel(), ids])
        order = np.lexsort((ids, -scores, group))
        first = np.searchsorted(group[order], np.arange(len(touched)))
        best = order[first[:, None] + np.arange(self.keep)]
        self.scores[touched], self.ids[touched] = scores[best], ids[best]

    def told(self) -> pa.RecordBatch:
        slot, rank = np.nonzero(self.scores != NONE)
        anchor, number = np.divmod(slot, self.slots)
        columns = [self.place[anchor], number, self.scores[slot, rank], self.ids[slot, rank]]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["place", "slot", "score", "vec_id"])


def _size(vectors: np.ndarray) -> int:
    return int(np.abs(vectors.astype(float)).max(initial=0))


def _matrices(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each length of vectors: the length, rows that have it, and their vectors."""
    lists = batch.column("vector")
    offsets, flat = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False)
    sizes = np.diff(offsets)
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        yield int(size), rows, flat[offsets[rows][:, None] + np.arange(size)]


def _passing(keep: int):
    """Each cell's anchors first, then its rows."""

    def passing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, parts in runs_of(batches, "cell"):
            waiting: dict[int, list] = {}
            held: dict[int, _Anchors] | None = None
            for part in parts:
                is_row = part.column("is_row").to_numpy(zero_copy_only=False)
                turn = int(np.searchsorted(is_row, True))
                if turn:
                    some = part.slice(0, turn)
                    for size, rows, vectors in _matrices(some):
                        waiting.setdefault(size, []).append((some.take(pa.array(rows)), vectors))
                if turn == len(is_row):
                    continue
                if held is None:
                    held = {size: _gathered(found, keep) for size, found in waiting.items()}
                some = part.slice(turn)
                vec_id, label = (some.column(c).to_numpy() for c in ("vec_id", "label"))
                for size, rows, vectors in _matrices(some):
                    if size in held:
                        held[size].meet(vec_id[rows], label[rows], vectors)
            for anchors in (held or {}).values():
                yield anchors.told()

    return passing


def _gathered(found: list, keep: int) -> _Anchors:
    table = pa.Table.from_batches([rows for rows, _ in found]).combine_chunks()
    columns = [table[c].to_numpy() for c in ("place", "vec_id", "label")]
    upper = lowest = None
    if table["upper"].null_count == 0:
        upper = np.array(table["upper"].to_pylist(), np.int64)
        lowest = table["lowest"].to_numpy()
    return _Anchors(*columns, np.concatenate([v for _, v in found]), upper, lowest, keep)


def _best(rows: DataFrame, anchors: DataFrame, blocks: int, chunks: int, keep: int) -> DataFrame:
    """``place, slot, score, vec_id``: of every anchor's slots, the ``keep`` best rows at least."""
    deal = F.pmod(F.xxhash64("place"), F.lit(blocks * chunks))
    block, chunk = F.floor(deal / chunks), deal % chunks
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(chunks - 1).cast("long")))
    kept = ["place", "vec_id", "label", "vector"]
    asked = anchors.select(*kept, "upper", "lowest", block.alias("block"), every.alias("chunk"), F.lit(False).alias("is_row"))
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")))
    none = [F.lit(None).cast("array<bigint>").alias("upper"), F.lit(None).cast("bigint").alias("lowest")]
    passing = rows.select(*kept, *none, every.alias("block"), chunk.alias("chunk"), F.lit(True).alias("is_row"))
    both = asked.unionByName(passing).withColumn("cell", F.col("block") * chunks + F.col("chunk"))
    both = both.select(*kept, "upper", "lowest", "is_row", "cell").repartition(blocks * chunks, "cell").sortWithinPartitions("cell", "is_row")
    found = both.mapInArrow(_passing(keep), "place long, slot long, score long, vec_id long")
    return _first(found, keep, "place", "slot")


def _first(found: DataFrame, n: int, *group: str) -> DataFrame:
    place = F.row_number().over(Window.partitionBy(*group).orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("nth", place).filter(F.col("nth") <= n)


def mine(vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 3, least: int = 50, most: int = 95) -> DataFrame:
    """``anchor_id, positive_id, positive_rank, rank, negative_id, positive_score, negative_score`` of ``vectors(vec_id, label, vector)``.

    A score is the integer inner product with the anchor; higher scores come first, then smaller ids. An anchor's positives are its first
    ``positives`` rows of its label and another id; a positive's negatives are the first ``negatives`` rows of another label whose score is
    ``least`` to ``most`` hundredths of the positive's. A score of zero or less has a range only if it is zero.

    Rows with a null id, label or vector take no part. Vectors of different lengths have no score. Rows repeated are rows of their own: each
    repeated anchor has results, and rows of the anchor's own id are no positives of it. Other columns are ignored. Without rows or anchors
    there are no results.

    Every anchor meets every row, so the work grows with their product; what is written and shuffled does not: anchors go to a cell for each chunk of
    rows, rows to a cell for each block of ``ANCHORS`` anchors. A cell gives ``negatives`` rows for each slot of its anchors at most.
    """
    # An anchor that repeats is told apart by its place, which the written table keeps.
    rows = vectors.select(
        F.monotonically_increasing_id().alias("place"),
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("long").alias("label"),
        F.col("vector").cast("array<bigint>").alias("vector"),
        F.coalesce(is_anchor, F.lit(False)).alias("is_anchor"),
    )
    rows = staged(rows.filter("vec_id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL"), "vectors")
    total, asked = rows.agg(F.count("*"), F.count_if("is_anchor")).first()
    blocks = max(1, -(-asked // ANCHORS))
    chunks = max(1, min(-(-total // ROWS), CELLS // blocks))
    anchors = rows.filter("is_anchor")
    unlimited = anchors.withColumns({"upper": F.lit(None).cast("array<bigint>"), "lowest": F.lit(None).cast("bigint")})
    best = _best(rows, unlimited, blocks, chunks, positives)
    # Limits of the positives' ranges: 100 * score between least and most times the positive's.
    wide = F.col("score").cast("decimal(20,0)")
    upper, lower = F.floor(wide * F.lit(most) / F.lit(100)).cast("long"), F.ceil(wide * F.lit(least) / F.lit(100)).cast("long")
    ranked = best.select("place", (F.col("nth") - 1).alias("window"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"), upper.alias("upper"), lower.alias("lower"))
    ranked = staged(ranked, "positives")
    by_rank = F.sort_array(F.collect_list(F.struct("window", "upper")))
    # As many limits for every anchor: the last stands for those that it lacks, so that their slots are empty.
    limits = ranked.groupBy(F.col("place").alias("of")).agg(F.transform(by_rank, lambda x: x["upper"]).alias("some"), F.min("lower").alias("lowest"))
    padded = F.slice(F.concat("some", F.array_repeat(F.element_at("some", -1), positives)), 1, positives)
    limited = anchors.join(limits.select("of", padded.alias("upper"), "lowest"), F.col("place") == F.col("of"))
    slots = _best(rows, limited, blocks, chunks, negatives)
    # A slot belongs to the ranges of its own positive and all before it.
    merged = slots.select("place", "score", "vec_id", F.explode(F.sequence(F.lit(0).cast("long"), F.col("slot"))).alias("window"))
    merged = merged.join(ranked.withColumn("window", F.col("window").cast("long")), ["place", "window"]).filter("score >= lower")
    names = anchors.select("place", F.col("vec_id").alias("anchor_id"))
    return _first(merged, negatives, "place", "window").join(names, "place").select(
        "anchor_id",
        "positive_id",
        (F.col("window") + 1).cast("int").alias("positive_rank"),
        F.col("nth").cast("int").alias("rank"),
        F.col("vec_id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )
