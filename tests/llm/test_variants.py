"""Spelling variants against comparing all pairs of words."""

import random
import re
import zlib
from collections import Counter

import pytest

from tidelake.llm import queries, variants


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(counts, ratio=10):
    rows, form = [], {}
    for w, n in counts.items():
        others = sorted((-m, v) for v, m in counts.items() if near(w, v))
        form[w] = others[0][1] if others and -others[0][0] >= ratio * n else None
        rows.append((w, n, len(others)))

    def root(w):
        return w if form[w] is None else root(form[w])

    return sorted((w, n, k, form[w], counts.get(form[w]), root(w)) for w, n, k in rows)


def grouped(spark, rows, **options):
    frame = spark.createDataFrame(rows, "word string, n int")
    return sorted(tuple(r) for r in variants.group_variants(frame, **options).collect())


def made(seed, letters, longest, size, most):
    r = random.Random(seed)
    return {"".join(r.choice(letters) for _ in range(r.randint(1, longest))): int(10 ** r.uniform(0, most)) for _ in range(size)}


@pytest.mark.parametrize("letters, longest, size", [("ab", 7, 150), ("abcé÷", 5, 300), ("a", 30, 40), ("漢a👩", 4, 60)])
def test_equals_all_pairs(spark, conf, letters, longest, size):
    conf("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    counts = made(size, letters, longest, size, 6)
    assert grouped(spark, list(counts.items())) == brute(counts)


def test_long_chains_and_ties(spark):
    chain = {"word" + "s" * k: 10**k for k in range(1, 9)}
    ties = {"tie": 1, "tiea": 50, "tieb": 50, "ties": 50, "te": 50}
    assert grouped(spark, list((chain | ties).items())) == brute(chain | ties)
    assert {r[5] for r in grouped(spark, list(chain.items()))} == {"word" + "s" * 8}
    assert grouped(spark, list(chain.items()), ratio=11) == brute(chain, 11)


def test_odd_words(spark):
    assert grouped(spark, []) == []
    rows = [("a", 1), ("", 30), (None, 5), ("b", None), ("b", 2), ("b", 3), ("c", 0)]
    assert grouped(spark, rows) == brute({"a": 1, "": 30, "b": 5})


def counted(docs, least_chars, least_n, every):
    counts = Counter()
    for doc_id, text in docs:
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for run in re.findall("[A-Za-zÀ-ÿ]+", lowered):
            if doc_id is not None and (h := zlib.crc32(f"{doc_id}:{run}".encode())) % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= least_chars and n >= least_n}


def test_counts(spark, monkeypatch):
    monkeypatch.setattr(variants, "COUNTED", 5)
    r = random.Random(4)
    docs = [(n, " ".join(r.choice(["Straße", "ÉTÉ", "étés", "naïvely", "Words", "a×b÷c", "œuvres", "x1y", "don't", "ŷword"]) for _ in range(60))) for n in range(40)]
    docs += [(None, "Naïvely naïvely"), (3, None), (3, ""), (7, "twice"), (7, "twice"), (-5, "minus minus"), (8, "a" * 70_000 + " " + "a" * 70_000)]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    for least_chars, least_n in ((1, 1), (5, 2)):
        got = {r.word: r.n for r in variants.word_counts(frame, least_chars, least_n, drop_every=3).collect()}
        assert got == counted(docs, least_chars, least_n, 3)
    assert variants.word_counts(frame.limit(0), 1, 1).count() == 0
    extra = spark.createDataFrame([(1, "one", 5, 6)], "doc_id int, text string, word int, n int")
    assert [tuple(r) for r in variants.word_counts(extra, 1, 1).collect()] == [("one", 1)]


def test_query(spark, tmp_path):
    """A small corpus of words and their slips, through the registered query."""
    r = random.Random(9)
    base = ["".join(r.choice("abcdeé") for _ in range(9)) for _ in range(30)]
    docs = [(n, " ".join(r.choices(base, range(1, 31), k=200))) for n in range(60)]
    spark.createDataFrame(docs, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.queries()["op12_spelling_variants"](spark, str(tmp_path)).select("word", "n", "n_near", "form", "form_n", "root")
    want = brute(counted(docs, 7, 2, 31))
    assert sorted(tuple(r) for r in got.collect()) == want and sum(w[3] is not None for w in want) > 30
