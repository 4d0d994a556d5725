"""CSV records that hold line breaks, and elements of one JSON array, read from one file by many tasks.

A file is read as short pieces: CSV as lines, JSON as what ends with a closing brace. Whether a piece ends a record depends on all before it in
the file, that is on quotes still open and, in JSON, on how deep it lies. So each block of a file tells first what it does to that state; a prefix scan
over the blocks gives the state at each block's start; then every block cuts its pieces into records. A record that lies across
blocks comes as one fragment from each of them, and only these fragments are shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

#: Of a record or fragment: the block, whether it is the first in its file, begins here and ends here, and the depth that elements of its file have.
_FOUND = "path string, block long, is_first boolean, begins boolean, part int, ends boolean, level int, text string"
_NAMES = [f.split()[0] for f in _FOUND.split(", ")]


def _pieces(spark: SparkSession, paths: str | Sequence[str], delimiter: str, block_bytes: int | None) -> DataFrame:
    """``path, block, file_size, value``: pieces of all files, block by block, within a task in the order of the file."""
    if block_bytes is not None:
        # The size of a block is the reading session's own.
        own, options = spark.newSession(), spark.conf.getAll
        for key in options:
            if spark.conf.isModifiable(key):
                own.conf.set(key, options[key])
        spark = own
        spark.conf.set("spark.sql.files.maxPartitionBytes", block_bytes)
        spark.conf.set("spark.sql.files.openCostInBytes", block_bytes)
    metadata = [F.col(f"_metadata.{name}").alias(alias) for name, alias in (("file_path", "path"), ("file_block_start", "block"), ("file_size", "file_size"))]
    return spark.read.option("lineSep", delimiter).text(paths if isinstance(paths, str) else list(paths)).select(*metadata, "value")


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, Iterator[pa.RecordBatch]]]:
    """Batches of one block after the other, as the scan reads them."""
    current, waiting = None, None

    def cut_up() -> Iterator[tuple[tuple, pa.RecordBatch]]:
        for batch in batches:
            if not batch.num_rows:
                continue
            path, block = batch.column("path"), batch.column("block").to_numpy()
            same = pc.equal(path.slice(1), path.slice(0, len(path) - 1)).to_numpy(zero_copy_only=False) & (np.diff(block) == 0)
            edges = [0, *(np.flatnonzero(~same) + 1).tolist(), batch.num_rows]
            for start, stop in zip(edges[:-1], edges[1:], strict=True):
                yield (path[start].as_py(), int(block[start])), batch.slice(start, stop - start)

    source = cut_up()
    waiting = next(source, None)

    def of_block(name: tuple) -> Iterator[pa.RecordBatch]:
        nonlocal waiting
        while waiting is not None and waiting[0] == name:
            batch, waiting = waiting[1], next(source, None)
            yield batch

    while waiting is not None:
        current = waiting[0]
        parts = of_block(current)
        yield current, parts
        for _ in parts:
            pass


def _quotes(value: pa.Array) -> np.ndarray:
    return pc.count_substring(value, '"').to_numpy(zero_copy_only=False).astype(np.int64)


def _assembled(ends_of, delimiter: str):
    """Records out of each block's pieces.

    ``ends_of`` takes a block's first piece and tells whether a record begins there, the depth of elements, whether a fragment is due at the block's end in any
    case, and how to find which pieces end a record. What a block begins with belongs to a record from before it unless one begins there: part
    0. What it ends with goes on in the next block: part 1. A block without an end gives one fragment.
    """

    def rows(path: str, block: int, level: int, first: bool, begins: bool, part: int, ends: bool, texts: pa.Array) -> pa.RecordBatch:
        n = len(texts)
        heads = [first] + [False] * (n - 1), [begins] + [True] * (n - 1)
        columns = [pa.array([path] * n), pa.array([block] * n, pa.int64()), *map(pa.array, heads), pa.array([part] * n, pa.int32()), pa.array([ends] * n), pa.array([level] * n, pa.int32())]
        return pa.RecordBatch.from_arrays([*columns, texts], names=_NAMES)

    def assembled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (path, block), parts in _blocks(batches):
            find, held, part = None, [], 0
            for batch in parts:
                if find is None:
                    begins, level, due, find = ends_of(batch)
                    first = block == 0
                value = batch.column("value")
                stops = np.flatnonzero(find(value)) + 1
                if not len(stops):
                    held += value.to_pylist()
                    continue
                starts = np.concatenate([[0], stops[:-1]])
                single = stops - starts == 1
                single[0] &= not held
                texts = [None] * len(stops)
                for k in np.flatnonzero(~single):
                    texts[k] = delimiter.join([*held, *value.slice(int(starts[k]), int(stops[k] - starts[k])).to_pylist()])
                    held = []
                joined = pc.if_else(pa.array(single), value.take(pa.array(starts)), pa.array(texts, value.type))
                yield rows(path, block, level, first, begins, 0, True, joined)
                first, begins, part, held = False, True, 1, value.slice(int(stops[-1])).to_pylist()
            if held or due:
                yield rows(path, block, level, first, begins, part, False, pa.array([delimiter.join(held)]))

    return assembled


def _stitched(found: DataFrame, delimiter: str) -> DataFrame:
    """``path, is_first, ends, level, text`` of all records: whole ones as they are, fragments joined.

    There are two fragments for each block at most. A file's last record may lack its end.
    """
    kept = ["path", "is_first", "ends", "level", "text"]
    by_place = Window.partitionBy("path").orderBy("block", "part").rowsBetween(Window.unboundedPreceding, 0)
    fragments = found.filter("NOT (begins AND ends)").withColumn("number", F.sum(F.col("begins").cast("int")).over(by_place))
    texts = F.sort_array(F.collect_list(F.struct("block", "part", "text")))
    joined = fragments.groupBy("path", "number").agg(F.max("is_first").alias("is_first"), F.max("ends").alias("ends"), F.max("level").alias("level"), texts.alias("texts"))
    joined = joined.withColumn("text", F.array_join(F.transform("texts", lambda t: t["text"]), delimiter))
    return found.filter("begins AND ends").select(*kept).unionByName(joined.select(*kept))


def _csv_ends(batch: pa.RecordBatch):
    """A line ends a record if no quoted field is open behind it: quotes inside a field are doubled."""
    is_open = bool(batch.column("is_open")[0].as_py())
    parity = int(is_open)

    def ends(value: pa.Array) -> np.ndarray:
        nonlocal parity
        after = (parity + np.cumsum(_quotes(value))) % 2
        parity = int(after[-1])
        return after == 0

    return not is_open, 0, False, ends


def csv_records(spark: SparkSession, paths: str | Sequence[str], block_bytes: int | None = None) -> DataFrame:
    """``path, is_first, record``: every CSV record of the files, line breaks in quoted fields included; blank lines are none.

    Lines end with a line feed, with or without a carriage return before it. Quotes are as PostgreSQL writes them: around fields that hold quotes, which are doubled. A file is split
    into blocks as Spark splits text, or of ``block_bytes``. Its text is read twice, the first time to count quotes; a row for each block with an open quote is
    broadcast. A field open at a file's end is a record that no parser takes.
    """
    lines = _pieces(spark, paths, "\n", block_bytes)
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    parity = lines.groupBy("path", "block").agg((F.sum(quotes) % 2).alias("parity"))
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    is_open = F.coalesce(F.sum("parity").over(before) % 2 == 1, F.lit(False))
    open_blocks = parity.withColumn("is_open", is_open).filter("is_open").select("path", "block", "is_open")
    dealt = lines.join(F.broadcast(open_blocks), ["path", "block"], "left").select("path", "block", "value", F.coalesce("is_open", F.lit(False)).alias("is_open"))
    found = _stitched(dealt.mapInArrow(_assembled(_csv_ends, "\n"), _FOUND), "\n")
    record = F.regexp_replace("text", "\r$", "")
    return found.select("path", "is_first", record.alias("record")).filter(F.trim("record") != "")


def read_csv(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType, options: dict, file_column: str | None = None, block_bytes: int | None = None) -> DataFrame:
    """Rows of CSV files with a header, which is not a row and must name the columns of ``schema``; a malformed record is an error."""
    options = {k: str(v).lower() if isinstance(v, bool) else v for k, v in options.items()} | {"mode": "FAILFAST", "multiLine": "true", "lineSep": "\n"}
    records = csv_records(spark, paths, block_bytes)
    names = T.StructType([T.StructField(f"c{n}", T.StringType()) for n in range(len(schema))])
    told = F.lower(F.to_json(F.from_csv("record", names.simpleString()[7:-1].replace(":", " "), options)))
    wanted = F.lower(F.to_json(F.struct(*[F.lit(f.name).alias(f"c{n}") for n, f in enumerate(schema)])))
    other = F.raise_error(F.concat(F.lit("header "), F.col("record"), F.lit(" in "), F.col("path"))).cast("boolean")
    rows = records.filter(F.when(F.col("is_first"), F.when(told == wanted, F.lit(False)).otherwise(other)).otherwise(F.lit(True)))
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    path = [F.col("path").alias(file_column)] if file_column else []
    return rows.select(F.from_csv("record", ddl, options).alias("row"), *path).select("row.*", *([file_column] if file_column else []))


def _strings_out(value: pa.Array) -> pa.Array:
    """Pieces without escaped characters; what is left of quotes begins and ends strings."""
    escaped = pc.match_substring(value, "\\")
    return pc.replace_substring_regex(value, r"\\.", "") if pc.any(escaped).as_py() else value


def _depths(value: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of every piece: its quotes modulo 2, and how much deeper it leads if it begins outside a string, or within one; its own brace not counted."""
    bare = _strings_out(value)

    def deeper(text: pa.Array) -> np.ndarray:
        text = pc.replace_substring_regex(text, r'"[^"]*("|$)', "")
        count = [pc.count_substring(text, c).to_numpy(zero_copy_only=False).astype(np.int64) for c in "{[]"]
        return count[0] + count[1] - count[2]

    return _quotes(bare) % 2, deeper(bare), deeper(pc.replace_substring_regex(bare, r'^[^"]*("|$)', ""))


def _running(value: pa.Array, inside: int, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """String state and depth behind each piece and its brace."""
    parity, outer, inner = _depths(value)
    after = (inside + np.cumsum(parity)) % 2
    before = np.concatenate([[inside], after[:-1]])
    step = np.where(before == 1, inner, outer) - (after == 0)
    return after, depth + np.cumsum(step)


def _json_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What each block does to the state: one that begins outside a string, and one that begins within."""
    for (path, block), parts in _blocks(batches):
        inside, depth, first, count, size = [0, 1], [0, 0], "", 0, 0
        for batch in parts:
            value = batch.column("value")
            count, size = count + len(value), size + len(value) + int(pc.sum(pc.binary_length(value)).as_py())
            for k in range(2):
                after, deep = _running(value, inside[k], depth[k])
                inside[k], depth[k] = int(after[-1]), int(deep[-1])
            if not first:
                first = next((t[:1] for t in pc.utf8_ltrim_whitespace(value).to_pylist() if t), "")
        columns = [[path], [block], [inside[0] == 1], depth[:1], depth[1:], [first], [count], [size], [batch.column("file_size")[0].as_py()]]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["path", "block", "flips", "outer", "inner", "first", "pieces", "bytes", "file_size"])


def _json_ends(batch: pa.RecordBatch):
    """A piece ends an element if its brace is no part of a string and leads back to the depth of elements."""
    inside, depth, level, begins, due, bare = (batch.column(c)[0].as_py() for c in ("inside", "depth", "level", "begins", "is_last", "bare"))

    def ends(value: pa.Array) -> np.ndarray:
        nonlocal inside, depth, bare
        after, deep = _running(value, inside, depth)
        inside, depth = int(after[-1]), int(deep[-1])
        found = (after == 0) & (deep == level)
        if 0 <= bare < len(found):
            found[bare] = False
        bare -= len(found)
        return found

    return begins, level, due, ends


#: How a file's list begins, by whether it is wrapped.
_OPENS = {False: r"\[", True: r'\{\s*"data"\s*:\s*\['}
_CLOSES = {False: r"\]", True: r"\]\s*\}"}


def json_elements(spark: SparkSession, paths: str | Sequence[str], wrapped: bool = False, block_bytes: int | None = None) -> DataFrame:
    """``path, element``: the text of every object in the files' arrays; null where a file is none.

    A file holds one array of objects, or several one after the other, on one line or many; ``wrapped`` ones are ``{"data": [...]}``. Not wrapped, it may hold
    objects alone. A file's text is read twice, the first time to count strings and braces; a row for each block is broadcast. An
    object that something else than a comma stands before, and a file that does not end as it should, are one null each; the objects before it are whole.
    """
    pieces = _pieces(spark, paths, "}", block_bytes)
    told = "path string, block long, flips boolean, outer long, inner long, first string, pieces long, bytes long, file_size long"
    told = pieces.mapInArrow(_json_blocks, told)
    in_file = Window.partitionBy("path").orderBy("block")
    before, whole = in_file.rowsBetween(Window.unboundedPreceding, -1), in_file.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    inside = F.coalesce(F.sum(F.col("flips").cast("int")).over(before) % 2, F.lit(0)).cast("int")
    own = F.when(F.col("inside") == 1, F.col("inner")).otherwise(F.col("outer"))
    kind = F.first(F.when(F.col("first") != "", F.col("first")), ignorenulls=True).over(whole)
    level = F.lit(2) if wrapped else F.when(kind == "[", 1).otherwise(0)
    states = told.withColumns({"inside": inside, "level": F.when(kind.isNull(), 0).otherwise(level).cast("int"), "is_last": F.max("block").over(whole) == F.col("block")})
    # What a file ends with has no brace behind it, unless the file ends with one.
    bare = F.col("is_last") & (F.sum("bytes").over(whole) == F.col("file_size") + 1)
    states = states.withColumn("bare", F.when(bare, F.col("pieces") - 1).otherwise(-1))
    states = states.withColumn("depth", F.coalesce(F.sum(own).over(before), F.lit(0)))
    begins = (F.col("block") == 0) | ((F.col("inside") == 0) & (F.col("depth") == F.col("level")))
    states = states.select("path", "block", "inside", "depth", "level", "is_last", "bare", begins.alias("begins"))
    dealt = pieces.join(F.broadcast(states), ["path", "block"])
    found = _stitched(dealt.mapInArrow(_assembled(_json_ends, "}"), _FOUND), "}")
    opens, closes, listed = _OPENS[wrapped], _CLOSES[wrapped], F.col("level") > 0
    full = F.concat("text", F.lit("}"))

    def behind(lead: str) -> Column:
        return F.regexp_extract(full, rf"^\s*{lead}\s*(\{{[\s\S]*)$", 1)

    element = F.when(listed & F.col("is_first"), behind(opens)).when(listed, behind(f"(?:,|{closes}\\s*{opens})")).otherwise(behind(""))
    empty = rf"^\s*({opens}\s*)?\]\s*(\}}\s*)?$" if wrapped else r"^\s*(\[\s*)?\]\s*$"
    is_good = F.when(listed, F.col("text").rlike(empty)).otherwise(F.col("text").rlike(r"^\s*$"))
    found = found.filter(F.col("ends") | ~is_good)
    return found.select("path", F.when(F.col("ends") & (element != ""), element).alias("element"))


def read_json(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType, wrapped: bool = False, file_column: str | None = None, block_bytes: int | None = None) -> DataFrame:
    """A row for each element; one that can't be read is a row of nulls, a value of another type a null."""
    elements = json_elements(spark, paths, wrapped, block_bytes)
    path = [F.col("path").alias(file_column)] if file_column else []
    return elements.select(F.from_json("element", schema).alias("row"), *path).select("row.*", *([file_column] if file_column else []))
