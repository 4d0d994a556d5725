"""Spelling variants: words that differ by one inserted, deleted or replaced character, found among sorted permuterm rotations.

A word's rotations are those of the word and a terminator: ``rest, terminator, beginning``. What two near words have in common then is a prefix: the
rotation that begins behind the edited character ends with that character, or, where it is missing, before it. So sorted rotations bring near
words together, a word that lacks the character before those that have one there. Such a group has one word for each character of the alphabet at most.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from tidelake.llm.common import whole
from tidelake.session import staged

#: Letters of words once A-Z are lower case.
LETTERS = "a-zÀ-ÿ"
#: Stands behind a word's end; no word has it.
TERMINATOR = "\0"
#: Different words that a task counts before it passes them on.
COUNTED = 1 << 18


def _counter(least_chars: int, drop_every: int | None):
    runs = re.compile(f"[{LETTERS}]{{{least_chars},}}")

    def told(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                # Bytes know ASCII's capitals only.
                found = Counter(runs.findall(text.as_py().encode().lower().decode()))
                begun = None if drop_every is None or doc_id is None else zlib.crc32(b"%d:" % doc_id)
                for word, n in found.items():
                    if begun is not None and (h := zlib.crc32(word.encode(), begun)) % drop_every == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1 :]
                        if len(word) < least_chars:
                            continue
                    counts[word] += n
                if len(counts) > COUNTED:
                    yield told(counts)
                    counts = Counter()
        yield told(counts)

    return counted


def word_counts(docs: DataFrame, least_chars: int, least_n: int, drop_every: int | None = None) -> DataFrame:
    """``word, n``: how often each word of ``least_chars`` characters or more occurs in all texts, if ``least_n`` times or more.

    Words are maximal runs of ``LETTERS``, A-Z in lower case. With ``drop_every`` a word whose crc32 after its document's id and a colon that number divides
    loses its character number crc32 modulo its length; a document without an id loses none. A null text has no words; rows that repeat
    count again. Words are added up within each task first.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole("text").alias("text"))
    counts = rows.mapInArrow(_counter(least_chars, drop_every), "word string, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_n)


def rotations(words: DataFrame) -> DataFrame:
    """``prefix, has, first, word, n``: of each word its rotations, whole, and without the character they end with (``has``).

    ``first``: of equal characters in a row it is the first one, so that a word that lacks one of them is met once.
    """
    at, word = F.col("at"), F.col("word")
    every = words.select("word", "n", F.explode(F.sequence(F.lit(0), F.length("word"))).alias("at"))
    beginning, rest = F.substring(word, F.lit(1), at), F.concat(F.substring(word, at + 1, F.length(word)), F.lit(TERMINATOR))
    first = (at == 0) | (F.substring(word, at, F.lit(1)) != F.substring(word, at + 1, F.lit(1)))
    kinds = [F.struct(F.concat(rest, beginning).alias("prefix"), F.lit(False).alias("has"), F.lit(False).alias("first"))]
    kinds.append(F.struct(F.concat(F.substring(rest, F.lit(2), F.length(word) + 1), beginning).alias("prefix"), F.lit(True).alias("has"), first.alias("first")))
    both = F.when(at < F.length(word), F.array(*kinds)).otherwise(F.array(kinds[0]))
    return every.select("word", "n", F.inline(both)).select("prefix", "has", "first", "word", "n")


def _scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Groups of one prefix, sorted by ``has``, falling ``n`` and word: each member's number of near words and the best of them."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        # A prefix may go on in the next batch: what has the last one waits.
        same = pc.equal(batch.column("prefix"), batch.column("prefix")[batch.num_rows - 1]).to_numpy(zero_copy_only=False)
        whole_until = batch.num_rows - (int(np.argmin(same[::-1])) if not same.all() else batch.num_rows)
        if whole_until:
            yield from _neighbours(pa.Table.from_batches([*held, batch.slice(0, whole_until)]))
            held = []
        held.append(batch.slice(whole_until))
    if held:
        yield from _neighbours(pa.Table.from_batches(held))


def _neighbours(rows: pa.Table) -> Iterator[pa.RecordBatch]:
    rows = rows.combine_chunks()
    prefix, word = (rows[c].chunk(0) if rows[c].num_chunks else pa.array([], pa.string()) for c in ("prefix", "word"))
    has, first = (rows[c].to_numpy().astype(bool) for c in ("has", "first"))
    n, total = rows["n"].to_numpy(), rows.num_rows
    new = np.append(True, pc.not_equal(prefix.slice(1), prefix.slice(0, total - 1)).to_numpy(zero_copy_only=False))
    starts = np.flatnonzero(new)
    group, at = np.cumsum(new) - 1, np.arange(total)
    sizes = np.diff(np.append(starts, total))
    bare = ~has[starts]
    # The best two with the character, of which a member's best other one is either; the best that counts beside the one without.
    best, with_it = (starts + bare)[group], (sizes - bare)[group]
    other = np.where(at == best, best + 1, best)
    other = np.where(has & (with_it > 1), other, -1)
    beside = np.where(has & first & bare[group], starts[group], -1)
    counted = np.where(first, at, total)
    least = np.minimum.reduceat(counted, starts)[group]
    beside = np.where(~has & (least < total), least, beside)
    near = np.where(has, with_it - 1 + (beside >= 0), np.add.reduceat(first.astype(np.int64), starts)[group])
    some = np.flatnonzero(near > 0)
    other, beside = other[some], beside[some]
    better = np.where(other < 0, beside, other)
    both = np.flatnonzero((other >= 0) & (beside >= 0))
    if len(both):
        a, b = other[both], beside[both]
        smaller = pc.less(word.take(pa.array(b)), word.take(pa.array(a))).to_numpy(zero_copy_only=False)
        better[both] = np.where((n[b] > n[a]) | ((n[b] == n[a]) & smaller), b, a)
    columns = [word.take(pa.array(some)), pa.array(near[some], pa.int64()), pa.array(n[better], pa.int64()), word.take(pa.array(better))]
    yield pa.RecordBatch.from_arrays(columns, names=["word", "n_near", "best_n", "best"])


def near_words(words: DataFrame) -> DataFrame:
    """``word, n, n_near, best, best_n`` of every row of ``words(word, n)``, a word each: how many words are near it, and the most frequent of them.

    Of equally frequent ones it is the first by code points; without any, both are null. A word meets its near words in groups of one prefix, each pair in
    one group; a group gives a row for each member, not for each pair.
    """
    entries = rotations(words).withColumn("falling", -F.col("n"))
    dealt = entries.repartition("prefix").sortWithinPartitions("prefix", "has", "falling", "word").drop("falling")
    met = dealt.mapInArrow(_scanned, "word string, n_near long, best_n long, best string")
    met = met.select("word", F.lit(None).cast("long").alias("n"), "n_near", F.struct((-F.col("best_n")).alias("falling"), "best").alias("first"))
    alone = words.select("word", F.col("n").cast("long").alias("n"), F.lit(0).cast("long").alias("n_near"), F.lit(None).cast(met.schema["first"].dataType).alias("first"))
    found = alone.unionByName(met).groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), F.min("first").alias("first"))
    return found.select("word", "n", "n_near", F.col("first.best").alias("best"), (-F.col("first.falling")).alias("best_n"))


def group_variants(words: DataFrame, ratio: int = 10) -> DataFrame:
    """``word, n, n_near, form, form_n, root`` of every word in ``words(word, n)``.

    ``form``: its most frequent near word, if that is ``ratio`` times as frequent or more, else null. ``root``: the last word that following forms
    leads to, or the word itself. Rows of one word are added up; null words and words without a count are left out, an empty word is near every word of one character. No
    word may hold U+0000. As frequencies rise by ``ratio`` with every form, chains are short: each round of joins doubles what they span.
    """
    if ratio < 2:
        raise ValueError("forms are more frequent than their words")
    words = words.select("word", F.col("n").cast("long").alias("n")).filter("word IS NOT NULL AND n > 0")
    words = staged(words.groupBy("word").agg(F.sum("n").alias("n")), "words")
    is_form = F.col("best_n") >= F.col("n") * ratio
    found = near_words(words).select("word", "n", "n_near", F.when(is_form, F.col("best")).alias("form"), F.when(is_form, F.col("best_n")).alias("form_n"))
    found = staged(found, "near-words")
    least, most = found.agg(F.coalesce(F.min("n"), F.lit(1)), F.coalesce(F.max("n"), F.lit(1))).first()
    steps, spanned = 0, 1
    while least * ratio <= most:
        least, steps = least * ratio, steps + 1
    links = found.filter("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while spanned < steps:
        on = links.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        links = staged(links.join(on, "root", "left").select("word", F.coalesce("beyond", "root").alias("root")), "roots")
        spanned *= 2
    return found.join(links, "word", "left").withColumn("root", F.coalesce("root", "word"))
