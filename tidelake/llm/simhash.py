"""SimHash near-duplicates by pigeonhole blocks."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidelake.llm.common import ascii_lower, cut, positions, whole, words
from tidelake.llm.components import connected_components
from tidelake.session import staged

BITS = 64
#: Fingerprints of one block key that are compared in pairs; larger groups are linked by shared neighbours.
PAIRED = 16
#: Shingle hashes that a task unpacks into bits at once.
CHUNK = 1 << 18


def shingle_hashes(text: str | Column, shingle: int) -> Column:
    """XXH64 (seed 42) of every run of ``shingle`` words, repeats included; of all words where they are fewer."""

    def of(w: Column) -> Column:
        run = lambda i: F.xxhash64(F.concat_ws(" ", *[F.get(w, i + k) for k in range(shingle)]))
        few = F.when(F.size(w) > 0, F.array(F.xxhash64(F.concat_ws(" ", w)))).otherwise(F.array().cast("array<bigint>"))
        return F.when(F.size(w) >= shingle, F.transform(positions(0, F.size(w) - shingle + 1), run)).otherwise(few)

    # A lambda's argument is computed once; a plain expression would be for every shingle.
    return F.get(F.transform(F.array(words(ascii_lower(whole(text)))), of), F.lit(0))


def _majority(hashes: np.ndarray) -> int:
    """The bits that are set in over half the hashes."""
    counts = np.zeros(BITS, np.int64)
    for start in range(0, len(hashes), CHUNK):
        part = hashes[start : start + CHUNK].astype("<u8").view(np.uint8)
        counts += np.unpackbits(part, bitorder="little").reshape(-1, BITS).sum(0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<i8")[0])


def _fingerprint_batches(batches):
    for batch in batches:
        lists = batch.column("hashes")
        ends = np.asarray(lists.offsets)
        values = np.asarray(lists.values)
        prints = np.empty(len(lists), np.int64)
        for start, end in cut(np.diff(ends), CHUNK):
            if end == start + 1:
                prints[start] = _majority(values[ends[start] : ends[end]])
                continue
            bits = np.unpackbits(values[ends[start] : ends[end]].astype("<u8").view(np.uint8), bitorder="little")
            total = np.zeros((end - start, BITS), np.int64)
            sizes = np.diff(ends[start : end + 1])
            full = np.flatnonzero(sizes)
            if len(full):
                firsts = (ends[start:end] - ends[start])[full]
                total[full] = np.add.reduceat(bits.reshape(-1, BITS), firsts, axis=0, dtype=np.int64)
            packed = np.packbits(total * 2 > sizes[:, None], axis=1, bitorder="little")
            prints[start:end] = np.ascontiguousarray(packed).view("<i8")[:, 0]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(prints)], names=["doc_id", "simhash"])


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """``doc_id, simhash`` (64 bits as a long) for every row of ``docs``, repeated rows and null ids included.

    Words are runs of non-blanks of the whole text with A-Z lower-cased. A null or empty text has
    fingerprint 0. Spark hashes the shingles; tasks count the bits, a bounded number of hashes at a time. No shuffle.
    """
    hashed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), shingle_hashes("text", shingle).alias("hashes"))
    return hashed.mapInArrow(_fingerprint_batches, "doc_id bigint, simhash bigint")


def _block_keys(value: Column, max_bits: int) -> Column:
    """Keys of which two fingerprints within ``max_bits`` share one at least.

    ``max_bits + 2`` blocks: differing bits touch at most ``max_bits`` of them, so two blocks stay
    equal. A key is the number of a pair of blocks and their bits, so that it narrows more than one block would.
    """
    blocks = max_bits + 2
    edges = [BITS * k // blocks for k in range(blocks + 1)]
    masks = [((1 << edges[k + 1]) - 1) ^ ((1 << edges[k]) - 1) for k in range(blocks)]

    def kept(mask: int) -> Column:
        return value.bitwiseAND(F.lit(mask - (1 << BITS) if mask >> (BITS - 1) else mask))

    pairs = [(masks[i] | masks[j]) for i, j in combinations(range(blocks), 2)]
    return F.array(*[F.struct(F.lit(n).alias("blocks"), kept(m).alias("bits")) for n, m in enumerate(pairs)])


def _flipped(value: Column, radius: int) -> Column:
    """All fingerprints within ``radius`` bits of one."""
    masks = [sum(1 << b for b in bits) for n in range(radius + 1) for bits in combinations(range(BITS), n)]
    signed = [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]
    table = F.expr(f"array({', '.join(f'{m}L' if m != -(1 << 63) else 'shiftleft(1L, 63)' for m in signed)})")
    return F.transform(table, lambda m: value.bitwiseXOR(m))


def near_links(prints: DataFrame, max_bits: int = 2) -> DataFrame:
    """Links ``a, b`` over distinct fingerprints ``simhash`` that connect exactly those within ``max_bits``, directly or by steps.

    Fingerprints are joined on block keys and verified by their Hamming distance. A key that over ``PAIRED``
    fingerprints share is not compared in pairs: each of its fingerprints meets the others at a common
    neighbour half way, where all link to the smallest. Two fingerprints share such a neighbour if and only if they are within
    ``max_bits``, so no link is lost or added, and the rows grow with the fingerprints, not with their pairs.
    Half way is ``max_bits // 2`` flipped bits: meant for distances of up to 3.
    """
    keyed = prints.select("simhash", F.explode(_block_keys(F.col("simhash"), max_bits)).alias("key"))
    counts = keyed.groupBy("key").count().filter("count > 1")
    shared = staged(keyed.join(counts, "key"), "simhash-blocks")
    few = shared.filter(F.col("count") <= PAIRED)
    a = few.select("key", F.col("simhash").alias("a"))
    b = few.select("key", F.col("simhash").alias("b"))
    pairs = a.join(b, "key").filter("a < b").select("a", "b")
    crowd = shared.filter(F.col("count") > PAIRED).select("simhash").distinct()
    near, far = max_bits // 2, max_bits - max_bits // 2
    own = crowd.select(F.col("simhash").alias("a"), F.explode(_flipped(F.col("simhash"), near)).alias("middle"))
    heads = own.groupBy("middle").agg(F.min("a").alias("b"))
    wide = crowd.select(F.col("simhash").alias("a"), F.explode(_flipped(F.col("simhash"), far)).alias("middle"))
    stars = wide.join(heads, "middle").filter("a <> b").select("a", "b")
    return pairs.union(stars).filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits).distinct()


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row of ``docs``.

    ``component_id`` is the smallest non-null id reachable over fingerprints that differ in at most ``max_bits``
    bits; null if no row of the component has an id. Texts without a word have fingerprint
    zero and link like any other. Equal fingerprints are one node, so copies are never paired. Other
    columns of ``docs`` are ignored; an empty table gives an empty one.
    """
    prints = staged(fingerprints(docs, shingle), "simhash")
    nodes = prints.groupBy("simhash").agg(F.min("doc_id").alias("least_id"))
    nodes = staged(nodes, "simhash-nodes")
    roots = connected_components(near_links(nodes, max_bits), "simhash-components")
    roots = staged(roots.withColumnRenamed("node", "simhash"), "simhash-roots")
    member = nodes.join(roots, "simhash")
    least = member.groupBy("root").agg(F.min("least_id").alias("component_id"))
    linked = member.join(least, "root").select("simhash", "component_id")
    own_or_least = F.coalesce("component_id", "least_id").alias("component_id")
    classes = staged(nodes.join(linked, "simhash", "left").select("simhash", own_or_least), "simhash-classes")
    return prints.join(classes, "simhash").select(
        "doc_id", F.lower(F.lpad(F.hex("simhash"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_first(docs: DataFrame, shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """``docs`` with the smallest id of each component; its columns stay as they are.

    A row without an id can't be named and stays; a row repeated with its id stays repeated.
    """
    classes = near_duplicates(docs, shingle, max_bits)
    # Written, so that its size tells whether the rows have to be shuffled.
    gone = staged(classes.filter("doc_id <> component_id").select(F.col("doc_id").alias("gone_id")).distinct(), "simhash-gone")
    return docs.join(gone, docs["doc_id"] == gone["gone_id"], "left_anti")
