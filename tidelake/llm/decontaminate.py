"""Benchmark decontamination by a hash set of the benchmark's word windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidelake.llm.common import ascii_lower, numbered, positions, whole, words
from tidelake.session import staged

#: Runs of ASCII digits, letters (lower-cased before) and anything beyond ASCII.
ITEM_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The same words in a text whose letters are as they were.
CASED_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Windows up to which the set is broadcast: 13 words each, some 60 MB. Beyond, Catalyst joins by shuffles.
BROADCAST_WINDOWS = 200_000
#: Words whose hash is looked up first; the whole window's is only where that passes.
HEAD = 3
#: Bits of the filter for each window, and the most bits it may have (128 KB). A fuller filter lets more windows pass to the join.
BITS_A_WINDOW, MOST_BITS = 16, 1 << 20


def _item_words(text: str | Column) -> Column:
    return words(ascii_lower(whole(text)), ITEM_WORD)


def _run(array: str, start: Column, n: int) -> list[Column]:
    return [F.get(array, start + k) for k in range(n)]


def _run_hash(window: str, head: int | None = None) -> Column:
    """The hash of a run of words, or of its first ``head``; chained over the words' hashes, so an array and its elements hash alike."""
    hashes = F.transform(window, lambda w: F.xxhash64(w))
    return F.xxhash64(hashes if head is None else F.slice(hashes, 1, head))


def benchmark_windows(benchmark: DataFrame, window: int = 13) -> DataFrame:
    """``n, hash, window, items``: each distinct run of ``window`` words, the ids (as text) that have it.

    An item of fewer words is one run; one of none has no run. Runs of items without an id have an empty list.
    """
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), _item_words("text").alias("w"))
    n = F.least(F.size("w"), F.lit(window))
    runs = items.filter(F.size("w") > 0).select(
        "item", n.alias("n"), F.explode(F.transform(positions(1, F.size("w") - n + 1), lambda i: F.slice("w", i, n))).alias("window")
    )
    sets = runs.groupBy("n", "window").agg(F.collect_set("item").alias("items"))
    return sets.select("n", _run_hash("window").alias("hash"), "window", "items")


def _filter_bits(windows: DataFrame, bits: int) -> Column:
    """One constant array of ``bits`` bits, 64 to a long, in which the slots of every window's and its head's hash are set.

    It passes through the driver: ``MOST_BITS`` bound it.
    """
    slot = F.col("hash").bitwiseAND(F.lit(bits - 1))
    hashes = windows.select("hash").union(windows.select(_run_hash("window", HEAD)))
    longs = hashes.groupBy(F.shiftright(slot, 6).alias("place")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(hash & 63 AS int))")).alias("long")
    )
    table = [0] * (bits // 64)
    for row in longs.collect():
        table[row["place"]] = row["long"]
    return F.split(F.lit(",".join(map(str, table))), ",").cast("array<bigint>")


def find_hits(docs: DataFrame, benchmark: DataFrame, window: int = 13) -> DataFrame:
    """For every row of ``docs``: ``doc_id, text_key, n_words, n_hit, runs, items``.

    ``runs`` holds the place (``first`` word, ``n`` words) of every occurrence of a benchmark window in the whole
    text, ``n_hit`` the words inside any of them, ``items`` the ids whose windows occur, as sorted strings.
    ``text_key`` is the text's md5. Null texts have no words; rows repeated or without an id are
    rows of their own; other columns are ignored. Without windows nothing is hit.

    Each task looks up the hash of every window of its texts in a bit array of bounded size and keeps the few
    that pass, with their words. These are joined with the set on hash and words, so a passing hash alone is no
    hit. Texts are not shuffled, only counts and hits.
    """
    windows = staged(benchmark_windows(benchmark, window), "benchmark-windows")
    sizes = windows.groupBy("n").count().collect()  # at most one row for each n up to ``window``
    total = sum(r["count"] for r in sizes)
    bits = min(MOST_BITS, max(1 << 12, 1 << (BITS_A_WINDOW * total - 1).bit_length() if total else 0))
    table = _filter_bits(windows, bits)
    rows = docs.select("doc_id", F.monotonically_increasing_id().alias("row"), whole("text").alias("text"))
    rows = rows.select("doc_id", "row", F.md5("text").alias("text_key"), _item_words("text").alias("w"))
    rows = rows.withColumn("h", F.transform("w", lambda w: F.xxhash64(w)))

    def passing(n: int) -> Column:
        def in_table(i: Column, count: int) -> Column:
            hash = F.xxhash64(*_run("h", i, count))
            place = F.shiftright(hash.bitwiseAND(F.lit(bits - 1)), 6).cast("int")
            return F.getbit(F.get(table, place), hash.bitwiseAND(F.lit(63)).cast("int")) == 1

        places = F.filter(positions(0, F.size("h") - n + 1), lambda i: in_table(i, min(HEAD, n)) & in_table(i, n))
        return F.transform(places, lambda i: F.struct(i.alias("first"), F.array(*_run("w", i, n)).alias("window")))

    found = F.concat(F.array(F.lit(None).cast("struct<first:int,window:array<string>>")), *[passing(r["n"]) for r in sizes])
    # The null in front keeps a row for each text, so that counts and hits need one scan and one shuffle.
    spread = rows.select("doc_id", "row", "text_key", F.size("w").alias("n_words"), F.explode(found).alias("found"))
    spread = spread.withColumn("hash", _run_hash("found.window"))
    lookup = windows.select(F.col("hash").alias("set_hash"), F.col("window").alias("set_window"), "n", "items")
    lookup = F.broadcast(lookup) if total <= BROADCAST_WINDOWS else lookup
    matches = (F.col("hash") == F.col("set_hash")) & (F.col("found.window") == F.col("set_window"))
    hits = spread.join(lookup, matches, "left").filter("found IS NULL OR set_hash IS NOT NULL")
    runs = F.array_sort(F.collect_list(F.when(F.col("n").isNotNull(), F.struct(F.col("found.first").alias("first"), "n"))))
    per_row = hits.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"),
        F.first("text_key").alias("text_key"),
        F.first("n_words").cast("long").alias("n_words"),
        runs.alias("runs"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
    )
    start = F.struct(F.lit(0).cast("long").alias("hit"), F.lit(0).alias("end"))

    def covered(acc: Column, run: Column) -> Column:
        end = run["first"] + run["n"]
        fresh = F.greatest(F.lit(0), end - F.greatest(acc["end"], run["first"]))
        return F.struct((acc["hit"] + fresh).alias("hit"), F.greatest(acc["end"], end).alias("end"))

    n_hit = F.aggregate("runs", start, covered, lambda acc: acc["hit"])
    return per_row.select("doc_id", "text_key", "n_words", n_hit.alias("n_hit"), "runs", "items")


def contaminated(least_share: int = 20) -> Column:
    """At least one word in ``least_share`` is hit."""
    return (F.col("n_hit") > 0) & (F.col("n_hit") * least_share >= F.col("n_words"))


def remove_documents(docs: DataFrame, benchmark: DataFrame, window: int = 13, least_share: int = 20) -> DataFrame:
    """``docs`` without contaminated texts; columns as they are, whatever their names.

    Null and empty texts stay, as nothing is hit in them; repeated rows and null ids are judged row by row. Only the numbers of contaminated
    rows meet the rows, which do not meet by their texts.
    """
    rows = numbered(docs, "decontaminate-rows")
    hits = find_hits(rows.select(F.col("row").alias("doc_id"), "own.text"), benchmark, window)
    # Written, so that its size tells whether the rows have to be shuffled.
    bad = staged(hits.filter(contaminated(least_share)).select(F.col("doc_id").alias("row")), "contaminated")
    return rows.join(bad, "row", "left_anti").select("own.*")


def remove_spans(docs: DataFrame, benchmark: DataFrame, window: int = 13) -> DataFrame:
    """``docs`` with every hit word, and what stands between it and the next word, cut out of ``text``.

    A text without hits stays as it is, a null one null. ``n_chars``, where there is such a column, follows.
    """
    rows = numbered(docs, "decontaminate-rows")
    hits = find_hits(rows.select(F.col("row").alias("doc_id"), "own.text"), benchmark, window)
    joined = rows.join(staged(hits.filter("n_hit > 0").select(F.col("doc_id").alias("row"), "runs"), "hit-runs"), "row", "left")
    text = F.col("own.text")
    every, gaps = words(text, CASED_WORD), F.split(text, CASED_WORD, -1)
    inside = F.flatten(F.transform("runs", lambda r: F.sequence(r["first"], r["first"] + r["n"] - 1)))
    kept = F.array_except(positions(0, F.size(every)), inside)

    def rest(parts: Column) -> Column:
        pieces = F.transform(kept, lambda i: F.concat(F.get(parts["every"], i), F.get(parts["gaps"], i + 1)))
        return F.concat(F.get(parts["gaps"], F.lit(0)), F.array_join(pieces, ""))

    parts = F.array(F.struct(every.alias("every"), gaps.alias("gaps")))
    new = F.when(F.col("runs").isNull(), text).otherwise(F.get(F.transform(parts, rest), F.lit(0)))
    follows = {"text": F.col("new")}
    if "n_chars" in docs.columns:
        follows["n_chars"] = F.length("new").cast(docs.schema["n_chars"].dataType)
    return joined.select("own", new.alias("new")).select(*[follows.get(c, F.col(f"own.`{c}`")).alias(c) for c in docs.columns])
