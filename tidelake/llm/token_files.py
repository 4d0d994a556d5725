"""Token counts of documents in flat token files, which hold identifiers and separators and nothing else.

A file is scanned in blocks by many tasks. Each block gives the places of its separators; the last separator before a block comes
from a prefix scan over the blocks' last separators, which stitches documents that lie across blocks.
"""

from __future__ import annotations

import base64
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tidelake.llm.common import whole
from tidelake.session import staged

#: Bytes of a block.
BLOCK = 4 << 20
#: Fixed value: how the rank files' tokenizer splits a text before its merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def tokenizer(ranks_path: str):
    """A byte-level BPE tokenizer from its rank file."""
    import tiktoken

    with open(ranks_path, "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def _open(uri: str) -> tuple[pafs.FileSystem, str]:
    """Any file system that Arrow knows by URI; a plain path is the shared local one."""
    return pafs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (pafs.LocalFileSystem(), uri)


def write_token_files(docs: DataFrame, folder: str, ranks_path: str, separator: int, kind: str = "<u2") -> DataFrame:
    """Flat files of every row's tokens, each text closed by ``separator``; returns ``doc_id, file, nth`` of every row.

    A task writes one file, under another name first, so a task run again leaves the same file. The order of texts in a file is all
    that tells them apart. Null texts are empty ones: a separator alone. Rows repeated or without an id are written like others.
    """

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, name = tokenizer(ranks_path).encode_ordinary, f"part-{TaskContext.get().partitionId():08d}.bin"
        files, root = _open(folder)
        files.create_dir(root)
        nth, draft = 0, f"{root}/_{name}-{uuid.uuid4().hex}"
        with files.open_output_stream(draft) as out:
            for batch in batches:
                for text in batch.column("text").to_pylist():
                    out.write(np.array([*encode(text), separator], kind).tobytes())
                places = pa.array(range(nth, nth + batch.num_rows), pa.int64())
                nth += batch.num_rows
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([name] * batch.num_rows), places], names=["doc_id", "file", "nth"])
        if nth:
            files.move(draft, f"{root}/{name}")
        else:
            files.delete_file(draft)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole("text").alias("text"))
    return staged(rows.mapInArrow(written, "doc_id long, file string, nth long"), "token-rows")


def _scanned(separator: int, kind: str):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start, size in zip(*[batch.column(c).to_pylist() for c in ("path", "start", "size")], strict=True):
                files, name = _open(path)
                with files.open_input_file(name) as file:
                    tokens = np.frombuffer(file.read_at(size, start), kind)
                ends = np.flatnonzero(tokens == separator) + start // np.dtype(kind).itemsize
                yield pa.RecordBatch.from_arrays(
                    [pa.array([path]), pa.array([start], pa.int64()), pa.array([ends], pa.list_(pa.int64())), pa.array([len(tokens)], pa.int64())],
                    names=["path", "start", "ends", "tokens"],
                )

    return scan


def count_tokens(spark: SparkSession, folder: str, separator: int, kind: str = "<u2", block: int = BLOCK) -> DataFrame:
    """``file, nth, n_tokens, closed`` of every document in the flat token files of ``folder``.

    A document is what stands between two separators, or before a file's first one; its separator does not count. What follows a file's last
    separator, if anything, is a document that is not closed. Empty files have none. Files are split into blocks of ``block`` bytes, however
    large they are; a task holds one block and the places of its separators. Bytes beyond the last whole token are ignored.
    """
    item = np.dtype(kind).itemsize
    if block % item:
        raise ValueError("a block holds whole tokens")
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "[!_.]*").load(folder).select("path", "length")
    whole_bytes = (F.col("length") - F.col("length") % item).alias("bytes")
    starts = F.explode(F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(block).cast("long"))).alias("start")
    blocks = listed.select("path", whole_bytes).filter("bytes > 0").select("path", "bytes", starts)
    blocks = blocks.select("path", "start", F.least(F.lit(block), F.col("bytes") - F.col("start")).alias("size"))
    # Files that hold most of the tokens are dealt out block by block.
    found = blocks.repartition("path", "start").mapInArrow(_scanned(separator, kind), "path string, start long, ends array<long>, tokens long")
    found = staged(found, "token-blocks")
    before = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    # A row for each block: a few bytes for each block of a file.
    every = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    stop = F.col("start") / item + F.col("tokens")
    ends = found.select("path", "start", F.size("ends").alias("n"), F.array_max("ends").alias("last"), stop.cast("long").alias("stop"))
    scan = ends.select(
        F.col("path").alias("of"),
        F.col("start").alias("at"),
        F.coalesce(F.max("last").over(before), F.lit(-1)).alias("previous"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"),
        F.max("stop").over(every).alias("file_stop"),
        (F.max("start").over(every) == F.col("start")).alias("is_last"),
    )
    joined = found.join(scan, (F.col("path") == F.col("of")) & (F.col("start") == F.col("at")))
    tail = F.greatest(F.coalesce(F.array_max("ends"), F.lit(-1)), F.col("previous"))
    open_tail = F.when(F.col("is_last") & (tail + 1 < F.col("file_stop")), F.array(F.col("file_stop"))).otherwise(F.array().cast("array<bigint>"))
    marks = joined.select("path", "first", "previous", "ends", F.size("ends").alias("n"), F.posexplode(F.concat("ends", open_tail)).alias("k", "end"))
    start = F.when(F.col("k") == 0, F.col("previous")).otherwise(F.get("ends", F.col("k") - 1))
    return marks.select(
        F.element_at(F.split("path", "/"), -1).alias("file"),
        (F.col("first") + F.col("k")).alias("nth"),
        (F.col("end") - start - 1).alias("n_tokens"),
        (F.col("k") < F.col("n")).alias("closed"),
    )


def document_token_counts(docs: DataFrame, folder: str, ranks_path: str, separator: int) -> DataFrame:
    """``doc_id, n_tokens`` of every row of ``docs``: its text is tokenised into flat files, the files are scanned, and counts return by place."""
    rows = write_token_files(docs, folder, ranks_path, separator)
    if not rows.take(1):
        return rows.select("doc_id", F.lit(0).cast("long").alias("n_tokens"))
    return rows.join(count_tokens(docs.sparkSession, folder, separator), ["file", "nth"]).select("doc_id", "n_tokens")
