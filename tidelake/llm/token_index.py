"""Token ids of documents as flat binary shards, and keyed access to them by minimal perfect hashing.

A folder holds three things. ``ids-<shard>.bin``: raw little-endian ids of successive documents, in ascending order of their keys, shard after
shard, each document closed by an end id. ``keys-<bucket>.mph``: for a bucket of keys a minimal perfect hash, and in its order an entry
for each key: a fingerprint, the shard, the offset and the number of ids. ``manifest``: a row for each shard. A document's text may itself
encode to the end id, so lengths are kept and never searched for.
"""

from __future__ import annotations

import json
import re
import sys
import types
import uuid
import zlib
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidelake.llm.common import cut, runs_of, whole
from tidelake.llm.token_files import _open
from tidelake.session import staged

#: Bytes of texts that a task encodes at once; ids that it reads at once.
PIECE, SPAN = 8 << 20, 1 << 20
#: Words whose ids a Python process remembers, with those of one more piece.
WORDS = 3 << 18
#: Keys of a bucket, at least and at most; in between there are 256 buckets.
LEAST_KEYS, MOST_KEYS, BUCKETS = 1 << 15, 1 << 20, 256
#: Places for each key that a level of the hash has.
ROOM = 2

ENTRY = np.dtype([("print", "<u4"), ("shard", "<u4"), ("offset", "<u8"), ("n", "<u8")])

#: Fixed value: white space as the byte-level tokenizers' pattern has it.
BLANK = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_PIECES = re.compile(f"[{BLANK}]*[^{BLANK}]+|[{BLANK}]+")
#: Letters up to U+024F, where neither tables nor versions of Unicode differ; texts of these, digits and ASCII; the pattern's parts of them.
_LETTER = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
_KNOWN = re.compile(f"[\x00-\x7f{_LETTER}]+")
_PARTS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTER}]+| ?[0-9]+| ?[^\t-\r {_LETTER}0-9]+|[\t-\r ]+(?![^\t-\r ])|[\t-\r ]+")
#: Bytes as the byte-level vocabulary writes them: letters and marks as they are, the others from U+0100 on.
_AS_LETTERS = np.arange(256, dtype="<u4")
_AS_LETTERS[[*range(0x21), *range(0x7F, 0xA1), 0xAD]] = np.arange(0x100, 0x144)
_GAP = "[\\t-\\r \\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}] "


def _gathered(values: np.ndarray, starts: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs ``at`` of ``values``, one after the other, and their lengths; run ``k`` is from ``starts[k]`` to the next."""
    sizes = np.diff(starts)[at]
    ends = np.cumsum(sizes)
    return values[np.repeat(starts[at] - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)], sizes


def _in_order(counts: np.ndarray, *some: np.ndarray) -> np.ndarray:
    """Where values of rows stand that were listed by ``some`` masks of rows, in the order of all rows."""
    return np.argsort(np.concatenate([np.repeat(np.flatnonzero(mask), counts[mask]) for mask in some]), kind="stable")


class _Numbers(dict):
    """Words numbered as they come."""

    def __missing__(self, key):
        self[key] = n = len(self)
        return n


class Encoder:
    """Ids of texts by a tokenizer of the ``tokenizers`` library, each word encoded once.

    A byte-level tokenizer's pattern never runs from anything else into white space, so a text may be cut there and its pieces encoded one
    by one. Any other tokenizer is given whole texts. Names of special tokens within a text are ordinary text.
    """

    def __init__(self, path: str, end: int) -> None:
        from tokenizers import Tokenizer

        self.tokenizer, self.end = Tokenizer.from_file(path), end
        self.tokenizer.encode_special_tokens = True
        self.merges = Tokenizer(self.tokenizer.model)
        told = json.loads(self.tokenizer.to_str())
        split = told.get("pre_tokenizer") or {}
        self.by_words = told.get("normalizer") is None and (split.get("type"), split.get("use_regex"), split.get("add_prefix_space")) == ("ByteLevel", True, False)
        self.forget()

    def forget(self) -> None:
        # Number 0 is the end. A word is named without its one leading blank; one that has none is named with a blank before it.
        self.numbers, self.ids, self.starts = _Numbers({None: 0}), np.array([self.end], np.uint32), np.array([0, 1])

    def _encoded(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [e.ids for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]
        return np.fromiter(chain.from_iterable(found), np.uint32), np.fromiter(map(len, found), np.int64, len(found))

    def _encoded_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """As ``_encoded``: words of known letters are cut by the pattern, and the merges run once for each different part."""
        known = np.array([_KNOWN.fullmatch(w) is not None for w in words], bool)
        numbers, counts = _Numbers(), np.zeros(len(words), np.int64)
        cut_up = [_PARTS.findall(w) for w, k in zip(words, known, strict=True) if k]
        counts[known] = [len(c) for c in cut_up]
        at = np.fromiter(map(numbers.__getitem__, chain.from_iterable(cut_up)), np.int64)
        ids, sizes = np.empty(0, np.uint32), np.empty(0, np.int64)
        if numbers:
            # No text has the byte 255.
            letters = _AS_LETTERS[np.frombuffer("\ud800".join(numbers).encode("utf-8", "surrogatepass").replace(b"\xed\xa0\x80", b"\xff"), np.uint8)]
            parts = letters.tobytes().decode("utf-32-le").split("\xff")
            merged = self.merges.encode(parts, is_pretokenized=True, add_special_tokens=False)
            ids, sizes = np.array(merged.ids, np.uint32), np.bincount(np.array(merged.word_ids, np.int64), minlength=len(parts))
        ids, sizes = _gathered(ids, np.concatenate([[0], np.cumsum(sizes)]), at)
        of_word = np.repeat(np.flatnonzero(known), counts[known])
        total = np.bincount(of_word, sizes, len(words)).astype(np.int64)
        if known.all():
            return ids, total
        others, total[~known] = self._encoded([w for w, k in zip(words, known, strict=True) if not k])
        return np.concatenate([ids, others])[_in_order(total, known, ~known)], total

    def _numbered(self, words: pa.Array) -> np.ndarray:
        """Numbers of words; each different one is looked up once."""
        coded = words.dictionary_encode()
        number = np.fromiter(map(self.numbers.__getitem__, coded.dictionary.to_pylist()), np.int64, len(coded.dictionary))
        return number[coded.indices.to_numpy(zero_copy_only=False)]

    def _words(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of all texts' words, and how many words each text has."""
        gaps = pc.match_substring_regex(texts, _GAP).to_numpy(zero_copy_only=False)
        lists = pc.split_pattern(texts.filter(pa.array(~gaps)), " ")
        plain, counts = lists.flatten(), np.zeros(len(texts), np.int64)
        counts[~gaps] = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
        numbers, heads = self._numbered(plain), (np.cumsum(counts[~gaps]) - counts[~gaps])
        numbers[heads] = self._numbered(pa.array([" " + w for w in plain.take(pa.array(heads)).to_pylist()], pa.string()))
        if not gaps.any():
            return numbers, counts
        # Blanks in a row belong to one piece.
        found = [_PIECES.findall(t) for t in texts.filter(pa.array(gaps)).to_pylist()]
        counts[gaps] = [len(f) for f in found]
        named = [p[1:] if p[0] == " " and p[1:2] != " " else " " + p for p in chain.from_iterable(found)]
        both = np.concatenate([numbers, self._numbered(pa.array(named, pa.string()))])
        return both[_in_order(counts, ~gaps, gaps)], counts

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each closed by the end, and how many each has."""
        if not self.by_words:
            ids, sizes = self._encoded(texts.to_pylist())
            return np.insert(ids, np.cumsum(sizes), self.end).astype(np.uint32), sizes + 1
        if len(self.numbers) > WORDS:
            self.forget()
        known = len(self.numbers)
        words, counts = self._words(texts)
        words, counts = np.insert(words, np.cumsum(counts), 0), counts + 1
        new = list(islice(self.numbers, known, None))
        if new:
            ids, sizes = self._encoded_words([w[1:] if w[:1] == " " else " " + w for w in new])
            self.ids, self.starts = np.concatenate([self.ids, ids]), np.concatenate([self.starts, self.starts[-1] + np.cumsum(sizes)])
        ids, sizes = _gathered(self.ids, self.starts, words)
        return ids, np.diff(np.cumsum(sizes)[np.cumsum(counts) - 1], prepend=0)


def _encoder(path: str, end: int) -> Encoder:
    """The encoder of this Python process, whose words outlast a task where the worker is used again."""
    kept = sys.modules.setdefault("_token_index_words", types.ModuleType("_token_index_words")).__dict__
    if (name := f"{path}:{end}") not in kept:
        kept[name] = Encoder(path, end)
    return kept[name]


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def _hashes(keys: np.ndarray, seed: int) -> np.ndarray:
    """64 bits of every key, a pair of 64-bit numbers; keys that differ in the first alone never share them."""
    return _mixed(keys[0] ^ _mixed(keys[1] + np.uint64(seed * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)))


class KeyIndex:
    """A minimal perfect hash: level after level, a key that alone falls on a place has it, the others go on to the next level.

    A key's slot is the number of taken places before its own, over all levels.
    """

    def __init__(self, levels: np.ndarray, words: np.ndarray, entries: np.ndarray) -> None:
        self.levels, self.words, self.entries = levels, words, entries
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)])

    @classmethod
    def of(cls, keys: np.ndarray, shard: np.ndarray, offset: np.ndarray, n: np.ndarray) -> KeyIndex:
        """``keys``: two rows of unsigned 64-bit numbers, all pairs different."""
        left, levels, words = np.arange(keys.shape[1]), [], []
        while len(left):
            size = -(-len(left) * ROOM // 64) * 64
            place = (_hashes(keys[:, left], len(levels)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(place, minlength=size) == 1
            words.append(np.packbits(alone, bitorder="little").view("<u8"))
            levels.append(size)
            left = left[~alone[place]]
        index = cls(np.array(levels, "<u8"), np.concatenate([*words, np.empty(0, "<u8")]), np.empty(keys.shape[1], ENTRY))
        slots = index.slots(keys)
        for name, values in (("print", cls._prints(keys)), ("shard", shard), ("offset", offset), ("n", n)):
            index.entries[name][slots] = values
        return index

    @staticmethod
    def _prints(keys: np.ndarray) -> np.ndarray:
        return (_hashes(keys, 0xFFFF) >> np.uint64(32)).astype(np.uint32)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """A key's slot; any other key has some slot, or -1."""
        slots, left, base = np.full(keys.shape[1], -1), np.arange(keys.shape[1]), 0
        for level, size in enumerate(self.levels):
            place = (_hashes(keys[:, left], level) % np.uint64(size)).astype(np.int64) + base
            word, bit = place >> 6, (place & 63).astype(np.uint64)
            taken = (self.words[word] >> bit & np.uint64(1)).astype(bool)
            below = np.bitwise_count(self.words[word] & ((np.uint64(1) << bit) - np.uint64(1)))
            slots[left[taken]] = (self.before[word] + below)[taken]
            left, base = left[~taken], base + int(size)
        return slots

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which keys are held (a strange one is taken for held once in 2^32 times), and the entries of those."""
        slots = self.slots(keys)
        held = slots >= 0
        held[held] = self.entries["print"][slots[held]] == self._prints(keys[:, held])
        return held, self.entries[slots[held]]

    def to_bytes(self) -> bytes:
        head = np.array([len(self.levels), len(self.words)], "<u8")
        return b"".join(a.tobytes() for a in (head, self.levels, self.words, self.entries))

    @classmethod
    def from_bytes(cls, data: bytes) -> KeyIndex:
        n_levels, n_words = (int(x) for x in np.frombuffer(data, "<u8", 2))
        at = 16 + 8 * n_levels
        words = np.frombuffer(data, "<u8", n_words, at)
        return cls(np.frombuffer(data, "<u8", n_levels, 16), words, np.frombuffer(data, ENTRY, -1, at + 8 * n_words))


def _keys(batch: pa.RecordBatch) -> np.ndarray:
    """A key is an id, or none, and which of the rows of this id it is, from 0."""
    doc_id, copy = batch.column("doc_id"), batch.column("copy").to_numpy(zero_copy_only=False).astype(np.uint64)
    absent = doc_id.is_null().to_numpy(zero_copy_only=False).astype(np.uint64)
    return np.stack([doc_id.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64), copy * np.uint64(2) + absent])


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("doc_id", "copy", F.col("doc_id").isNull()), F.lit(buckets)).cast("int").alias("bucket")


def _write(path: str, data: bytes) -> None:
    """The whole file at once, so that a task run again leaves the same."""
    files, name = _open(path)
    draft = f"{name}.{uuid.uuid4().hex}.draft"
    with files.open_output_stream(draft) as out:
        out.write(data)
    files.move(draft, name)


def _written(folder: str, tokenizer_path: str, end: int, kind: str):
    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, shard = _encoder(tokenizer_path, end), TaskContext.get().partitionId()
        files, root = _open(folder)
        files.create_dir(root)
        draft = f"{root}/ids-{shard:08d}.{uuid.uuid4().hex}.draft"
        offset, last, copy, most = 0, (), -1, np.iinfo(np.dtype(kind)).max
        with files.open_output_stream(draft) as out:
            for batch in batches:
                sizes = pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False)
                for start, stop in cut(sizes, PIECE):
                    some = batch.slice(start, stop - start)
                    ids, counts = encode(some.column("text"))
                    if len(ids) and int(ids.max()) > most:
                        raise ValueError(f"id {int(ids.max())} does not fit {kind}")
                    out.write(ids.astype(kind).tobytes())
                    copies = []
                    for doc_id in some.column("doc_id").to_pylist():
                        copy, last = (copy + 1 if last == (doc_id,) else 0), (doc_id,)
                        copies.append(copy)
                    places = offset + np.cumsum(counts) - counts
                    offset += int(counts.sum())
                    columns = [some.column("doc_id"), pa.array(copies, pa.int64()), pa.array([shard] * len(copies), pa.int32()), pa.array(places, pa.int64()), pa.array(counts, pa.int64())]
                    yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "copy", "shard", "offset", "n_tokens"])
        if offset:
            files.move(draft, f"{root}/ids-{shard:08d}.bin")
        else:
            files.delete_file(draft)

    return written


def _indexed(folder: str):
    """Batches sorted by bucket, to a file for each bucket."""

    def indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def closed(bucket: int, parts: list[pa.RecordBatch]) -> pa.RecordBatch:
            rows = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
            shard, offset, n = (rows.column(c).to_numpy() for c in ("shard", "offset", "n_tokens"))
            _write(f"{folder}/keys-{bucket:08d}.mph", KeyIndex.of(_keys(rows), shard, offset, n).to_bytes())
            return pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32()), pa.array([rows.num_rows], pa.int64())], names=["bucket", "keys"])

        for bucket, parts in runs_of(batches, "bucket"):
            yield closed(bucket, list(parts))

    return indexed


def write(docs: DataFrame, folder: str, tokenizer_path: str, end: int, kind: str = "<u2") -> DataFrame:
    """Every row's whole text as ids in the new ``folder``, with manifest and index; returns the keys, ``doc_id, copy``.

    Rows stand in ascending order of ``doc_id``, none first; rows of one id by their text's hash. ``copy`` numbers the rows of one id from
    0, also where they go on from shard to shard. A null text is an empty one: the end alone. Other columns are ignored. Rows are dealt
    by ranges of id, text hash and place, so a hot id does not meet in one task; each task writes one shard. ``kind`` is the type of an id in
    the files; one that does not fit is an error. Without rows there are no shards and no buckets.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole("text").alias("text"))
    rows = rows.withColumns({"of_text": F.xxhash64("text"), "place": F.monotonically_increasing_id()})
    order = ("doc_id", "of_text", "place")
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    schema = "doc_id long, copy long, shard int, offset long, n_tokens long"
    placed = staged(ordered.mapInArrow(_written(folder, tokenizer_path, end, kind), schema), "token-places")
    # A row for each task of the write.
    shards = (
        placed.groupBy("shard")
        .agg(
            F.sum("n_tokens").alias("ids"),
            F.count("*").alias("docs"),
            F.min_by("doc_id", "offset").alias("first_id"),
            F.max_by(F.struct("doc_id", "copy"), "offset").alias("last"),
        )
        .orderBy("shard")
        .collect()
    )
    manifest, base, carry, total = [], 0, 0, sum(s["docs"] for s in shards)
    buckets = max(1, -(-total // min(MOST_KEYS, max(LEAST_KEYS, total // BUCKETS))))
    before: tuple = ()
    for s in shards:
        carry = carry if before == (s["first_id"],) else 0
        manifest.append((s["shard"], s["first_id"], carry, base, s["ids"], s["docs"], kind, buckets))
        tail = s["last"]["copy"] + 1
        carry = tail + (carry if s["first_id"] == s["last"]["doc_id"] else 0)
        before, base = (s["last"]["doc_id"],), base + s["ids"]
    names = "shard int, first_id long, carry long, base long, ids long, docs long, kind string, buckets int"
    about = spark.createDataFrame(manifest, names).coalesce(1)
    about.write.parquet(f"{folder}/manifest")
    carried = F.when(F.col("doc_id").eqNullSafe(F.col("first_id")), F.col("copy") + F.col("carry")).otherwise(F.col("copy"))
    keyed = placed.join(F.broadcast(about.select("shard", "first_id", "carry")), "shard").withColumn("copy", carried)
    keyed = keyed.select("doc_id", "copy", "shard", "offset", "n_tokens", _bucket(buckets))
    indexed = keyed.repartition(buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(_indexed(folder), "bucket int, keys long")
    held = indexed.agg(F.coalesce(F.sum("keys"), F.lit(0))).first()[0]
    if held != total:
        raise RuntimeError(f"{held} of {total} keys indexed")
    return keyed.select("doc_id", "copy")


def lookup(spark: SparkSession, folder: str, keys: DataFrame) -> DataFrame:
    """``doc_id, copy, shard, offset, start, n_tokens`` of every row of ``keys`` (``doc_id``, and ``copy``, else 0), from the index alone.

    ``offset`` counts ids within the shard, ``start`` those of all documents before it. Keys not held have nulls. Each bucket's keys meet its
    file in one task; a key asked for again is looked up again.
    """
    manifest = spark.read.parquet(f"{folder}/manifest")
    first = manifest.select("buckets").take(1)
    buckets = first[0]["buckets"] if first else 1
    copy = F.col("copy").cast("long") if "copy" in keys.columns else F.lit(0).cast("long")
    asked = keys.select(F.col("doc_id").cast("long").alias("doc_id"), copy.alias("copy"))
    asked = asked.select("doc_id", "copy", _bucket(buckets)).repartition(buckets, "bucket").sortWithinPartitions("bucket")

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, parts in runs_of(batches, "bucket"):
            files, name = _open(f"{folder}/keys-{bucket:08d}.mph")
            index = None
            if files.get_file_info(name).type != pafs.FileType.NotFound:
                with files.open_input_file(name) as file:
                    index = KeyIndex.from_bytes(file.read())
            for part in parts:
                held, entries = index.find(_keys(part)) if index else (np.zeros(part.num_rows, bool), np.empty(0, ENTRY))
                columns = []
                for field, kind in (("shard", pa.int32()), ("offset", pa.int64()), ("n", pa.int64())):
                    values = np.zeros(part.num_rows, np.int64)
                    values[held] = entries[field]
                    columns.append(pa.array(values, pa.int64(), mask=~held).cast(kind))
                names = ["doc_id", "copy", "shard", "offset", "n_tokens"]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("copy"), *columns], names=names)

    places = asked.mapInArrow(found, "doc_id long, copy long, shard int, offset long, n_tokens long")
    bases = manifest.select(F.col("shard").alias("of"), "base")
    places = places.join(F.broadcast(bases), F.col("shard") == F.col("of"), "left")
    return places.select("doc_id", "copy", "shard", "offset", (F.col("base") + F.col("offset")).alias("start"), "n_tokens")


def _payload(folder: str, kind: str, places: Iterator[tuple[int, int, int]]) -> Iterator[Iterator[np.ndarray]]:
    """The ids of each place in turn, in pieces; neighbours within a span are read at once, whatever the order."""
    item, current, file, held, base = np.dtype(kind).itemsize, None, None, np.empty(0, kind), 0

    def ids(offset: int, n: int) -> Iterator[np.ndarray]:
        nonlocal held, base
        while n:
            if not base <= offset < base + len(held):
                held, base = np.frombuffer(file.read_at(SPAN * item, offset * item), kind), offset
            some = held[offset - base : offset - base + n]
            if not len(some):
                raise EOFError(f"shard {current} ends before id {offset}")
            yield some
            offset, n = offset + len(some), n - len(some)

    for shard, offset, n in places:
        if shard != current:
            files, name = _open(f"{folder}/ids-{shard:08d}.bin")
            current, file, held, base = shard, files.open_input_file(name), np.empty(0, kind), 0
        yield ids(offset, n)


def _fetched(spark: SparkSession, folder: str, keys: DataFrame, column: str, data_type: str, value) -> DataFrame:
    first = spark.read.parquet(f"{folder}/manifest").select("kind").take(1)
    kind = first[0]["kind"] if first else "<u2"
    places = lookup(spark, folder, keys).filter("shard IS NOT NULL")
    # A span's documents are read by one task, whichever shard they are in.
    span = (F.col("offset") / F.lit(8 * SPAN)).cast("long")
    places = places.withColumn("span", span).repartition("shard", "span").sortWithinPartitions("shard", "offset")
    kept = ["doc_id", "copy", "start", "n_tokens"]

    def fetched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            where = zip(*[batch.column(c).to_pylist() for c in ("shard", "offset", "n_tokens")], strict=True)
            sizes = batch.column("n_tokens").to_numpy()
            read = _payload(folder, kind, where)
            for start, stop in cut(sizes, 4 * SPAN):
                values = value(islice(read, stop - start))
                some = batch.slice(start, stop - start)
                yield pa.RecordBatch.from_arrays([*[some.column(c) for c in kept], values], names=[*kept, column])

    return places.mapInArrow(fetched, f"doc_id long, copy long, start long, n_tokens long, {column} {data_type}")


def read_ids(spark: SparkSession, folder: str, keys: DataFrame) -> DataFrame:
    """``doc_id, copy, start, n_tokens, ids`` of every key that is held: its ids with the end id, read at its place."""

    def arrays(read: Iterator[Iterator[np.ndarray]]) -> pa.Array:
        return pa.array([np.concatenate(list(parts)).astype(np.int64) for parts in read], pa.list_(pa.int64()))

    return _fetched(spark, folder, keys, "ids", "array<long>", arrays)


def checksums(spark: SparkSession, folder: str, keys: DataFrame) -> DataFrame:
    """``doc_id, copy, start, n_tokens, ids_crc32`` of every key that is held; crc32 of its ids as little-endian 32-bit numbers."""

    def crc(parts: Iterator[np.ndarray]) -> int:
        value = 0
        for ids in parts:
            value = zlib.crc32(ids.astype("<u4").tobytes(), value)
        return value

    return _fetched(spark, folder, keys, "ids_crc32", "long", lambda read: pa.array([crc(p) for p in read], pa.int64()))
