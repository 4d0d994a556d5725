"""Benchmark decontamination against brute force."""

import random
import re

import pytest

from tidelake.llm import decontaminate

PATTERN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def item_words(text):
    return PATTERN.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, benchmark, window):
    result = []
    for doc_id, text in docs:
        words, hit, items, runs = item_words(text), set(), set(), set()
        for item_id, item in benchmark:
            parts = item_words(item)
            n = min(window, len(parts))
            for s in range(len(parts) - n + 1 if n else 0):
                for p in range(len(words) - n + 1):
                    if words[p : p + n] == parts[s : s + n]:
                        hit |= set(range(p, p + n))
                        runs.add((p, n))
                        items |= {str(item_id)} if item_id is not None else set()
        result.append((doc_id, len(words), len(hit), sorted(runs), sorted(items)))
    return sorted(result, key=repr)


def found(spark, docs, benchmark, window):
    hits = decontaminate.find_hits(
        spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(benchmark, "item_id bigint, text string"), window
    ).collect()
    return sorted(((r.doc_id, r.n_words, r.n_hit, [tuple(x) for x in r.runs], r["items"]) for r in hits), key=repr)


def random_tables(seed):
    r = random.Random(seed)

    def text(n):
        return "".join(r.choice(["a", "B", "ccc", "Éa", "9", "x"]) + r.choice([" ", ", ", "\n", "!-"]) for _ in range(n))

    benchmark = [(n, text(r.randint(0, 12))) for n in range(12)] + [(None, text(6)), (3, None), (100, "a"), (101, ""), (5, "A b ccc A b ccc a")]
    docs = [(n, text(r.randint(0, 60))) for n in range(40)] + [(50, None), (51, ""), (52, " , "), (1, "a b ccc"), (1, "a b ccc"), (None, "a B CCC x")]
    docs += [(60, "q " * 30 + benchmark[4][1] + " q" * 500)]
    return docs, benchmark


@pytest.mark.parametrize("window", [1, 3, 13])
def test_hits(spark, window):
    docs, benchmark = random_tables(window)
    assert found(spark, docs, benchmark, window) == brute(docs, benchmark, window)


def test_full_filter_and_shuffled_set(spark, monkeypatch):
    """A bit array in which every hash passes, and a set over the broadcast bound."""
    docs, benchmark = random_tables(8)
    want = brute(docs, benchmark, 4)
    monkeypatch.setattr(decontaminate, "MOST_BITS", 64)
    monkeypatch.setattr(decontaminate, "BROADCAST_WINDOWS", 0)
    assert found(spark, docs, benchmark, 4) == want


def test_empty_tables(spark):
    assert found(spark, [], [(1, "a b")], 3) == []
    assert found(spark, [(1, "a b")], [], 3) == [(1, 2, 0, [], [])]
    assert found(spark, [(1, "a b")], [(1, " ")], 3) == [(1, 2, 0, [], [])]


def test_removal_keeps_columns(spark):
    frame = spark.createDataFrame(
        [(1, "One, two; THREE four five.", 9, "h", 1), (2, "clean text", 9, "h", 1), (3, None, 9, "h", 1), (None, "two three four", 9, "h", 1)],
        "doc_id bigint, text string, n_chars bigint, hash string, row int",
    )
    benchmark = spark.createDataFrame([(1, "two three four")], "item_id bigint, text string")
    kept = decontaminate.remove_documents(frame, benchmark)
    assert kept.columns == frame.columns and {r.doc_id for r in kept.collect()} == {2, 3}
    cut = decontaminate.remove_spans(frame, benchmark, 2)
    assert cut.schema == frame.schema
    assert {r.doc_id: (r.text, r.n_chars) for r in cut.collect()} == {1: ("One, five.", 10), 2: ("clean text", 10), 3: (None, None), None: ("", 0)}
