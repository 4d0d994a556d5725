"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import string
from collections.abc import Callable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidelake.session import staged

#: Runs of anything but the six ASCII blanks.
WORD = r"[^\x20\x09-\x0D]+"


def whole(text: str | Column) -> Column:
    """The text; a null one is empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def numbered(docs: DataFrame, name: str) -> DataFrame:
    """``row, own`` of every row: written once, so that numbers stay; ``own`` has all columns of ``docs``, whatever their names."""
    own = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("own")
    return staged(docs.select(F.monotonically_increasing_id().alias("row"), own), name)


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, every other letter as it is."""
    only_ascii = F.length(text) == F.octet_length(text)
    return F.when(only_ascii, F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    )


def words(text: Column, pattern: str = WORD) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def positions(first: int | Column, count: Column) -> Column:
    """``count`` successive integers; none for zero or less."""
    first = F.lit(first) if isinstance(first, int) else first
    return F.when(count > 0, F.sequence(first, first + count - 1)).otherwise(F.array().cast("array<int>"))


def held_out(doc_id: str | Column, modulus: int, remainder: int = 2) -> Column:
    """Whether crc32 of the id as text leaves ``remainder``; a null id is not held out."""
    doc_id = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % modulus == remainder, F.lit(False))


def with_labels(docs: DataFrame, labels: DataFrame, label: str) -> DataFrame:
    """Rows of ``docs`` that carry one plain 0 or 1 as ``label``; ids with both labels, or a null id, have none."""
    one = (
        labels.select("doc_id", F.col(label).cast("int").alias("label"))
        .filter("doc_id IS NOT NULL AND label IN (0, 1)")
        .groupBy("doc_id")
        .agg(F.min("label").alias("label"), F.max("label").alias("other"))
        .filter("label = other")
        .select("doc_id", "label")
    )
    return docs.join(one, "doc_id")


def taught(docs: DataFrame, labels: DataFrame, label: str, sample: int, encode: Callable, column: str, most: int, longest: int) -> list[dict]:
    """``doc_id, label`` and the encoded text of the documents that a model learns from, in order of ids.

    Labelled ids that are not held out, ``sample`` at most by the hash of the id; of an id's rows the one with the smallest encoded text. Of
    these, in the order of the hash, as many as ``most`` bytes hold; a text of over ``longest`` encoded bytes teaches nothing.
    """
    known = labels.filter(~held_out("doc_id", 4))
    ids = with_labels(known.select("doc_id").distinct(), known, label)
    ids = ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample).select(F.col("doc_id").alias("taught_id"), "label")
    rows = docs.select("doc_id", whole("text").alias("text")).join(F.broadcast(ids), F.col("doc_id") == F.col("taught_id"))
    rows = rows.select(F.col("doc_id").cast("long").alias("doc_id"), "label", "text")
    encoded = rows.mapInArrow(encode, f"doc_id long, label int, {column} binary").filter(F.length(column) <= longest)
    encoded = encoded.groupBy("doc_id").agg(F.min("label").alias("label"), F.min(column).alias(column))
    # A row for each sampled id at most.
    so_far = F.sum(F.length(column)).over(Window.orderBy(F.xxhash64("doc_id"), "doc_id").rowsBetween(Window.unboundedPreceding, 0))
    found = encoded.withColumn("so_far", so_far).filter(F.col("so_far") <= most).drop("so_far")
    return sorted(found.toArrow().to_pylist(), key=lambda r: r["doc_id"])


def cut(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of successive rows whose sizes add up to ``most`` at most, or of one larger row."""
    start = total = 0
    for row, size in enumerate(sizes):
        if row > start and total + size > most:
            yield start, row
            start, total = row, 0
        total += int(size)
    if len(sizes) > start:
        yield start, len(sizes)


def utf8(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of an Arrow string column without nulls."""
    kind = np.int64 if str(column.type).startswith("large") else np.int32
    offsets = np.frombuffer(column.buffers()[1], kind, len(column) + 1, column.offset * kind().itemsize)
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], (offsets - offsets[0]).astype(np.int64)


def runs_of(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[tuple[int, Iterator[pa.RecordBatch]]]:
    """Runs of rows that share a value, one value at a time."""

    def parts() -> Iterator[tuple[int, pa.RecordBatch]]:
        for batch in batches:
            values = batch.column(column).to_numpy(zero_copy_only=False)
            edges = [0, *(np.flatnonzero(np.diff(values)) + 1).tolist(), len(values)]
            for start, stop in zip(edges[:-1], edges[1:], strict=True):
                if stop > start:
                    yield int(values[start]), batch.slice(start, stop - start)

    for value, run in groupby(parts(), key=lambda p: p[0]):
        yield value, (p[1] for p in run)
