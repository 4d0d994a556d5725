"""The trie against plain searches, the scores against counting."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tidelake.llm import lm
from tidelake.llm.eliasfano import Sequence, Trie, quantised

SCHEMA = "doc_id bigint, text string, block string, score int"


@pytest.mark.parametrize(("n", "universe"), [(0, 1), (1, 1), (1, 10**12), (5, 5), (1000, 1000), (1000, 10**9), (50_000, 1 << 40), (3000, 100)])
def test_sequence(n, universe):
    r = np.random.default_rng(n)
    values = np.sort(r.integers(0, universe, n)).astype(np.uint64)
    sequence, _ = Sequence.read(Sequence.of(values).to_bytes(), 0)
    assert (sequence.get(np.arange(n)) == values).all()
    asked = np.concatenate([values, r.integers(0, universe + 5, 500).astype(np.uint64), [0, universe + 10]]).astype(np.uint64)
    assert (sequence.find(asked) == np.searchsorted(values, asked)).all()


def test_sequence_is_compact():
    values = np.sort(np.random.default_rng(1).integers(0, 10**9, 100_000)).astype(np.uint64)
    assert len(Sequence.of(values).to_bytes()) * 8 / len(values) < 2.3 + math.log2(10**9 / len(values))


def test_trie():
    r = random.Random(2)
    words = sorted(r.sample(range(1, 10**6), 400))
    pairs = sorted({(r.choice(words[:50]), r.choice(words)) for _ in range(3000)} | {(words[0], words[0]), (words[-1], words[-1])})
    own, left, seen = [[-r.random() * 6 for _ in range(n)] for n in (len(words), len(words), len(pairs))]
    built = Trie.build(words, own, left, np.array([p[0] for p in pairs], np.uint64), np.array([p[1] for p in pairs], np.uint64), seen)
    trie = Trie.open(built.to_bytes())
    asked = pairs + [(r.choice(words), r.choice(words)) for _ in range(3000)]
    got = trie.score(*[np.array([a[k] for a in asked], np.uint64) for k in (0, 1)])
    number, known = {w: k for k, w in enumerate(words)}, dict(zip(pairs, seen, strict=True))
    want = [known[a, b] if (a, b) in known else left[number[a]] + own[number[b]] for a, b in asked]
    assert np.abs(got - want).max() < 0.1 and np.abs(got - want).mean() < 0.02


def test_quantised():
    codes, book = quantised(np.repeat([-1.0, -2.0, -3.0], [5, 1, 9]))
    assert len(book) == 3 and sorted(set(book[codes])) == [-3, -2, -1]
    values = np.random.default_rng(0).normal(0, 1, 10_000)
    codes, book = quantised(values)
    assert codes.max() <= 255 and np.abs(book[codes] - values).mean() < 0.02


def plain(docs):
    """By counting, without quantising."""
    rows = []
    for doc_id, text in docs:
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        held = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2
        rows.append((doc_id, held, [*re.findall(r"[^\x20\x09-\x0D]+", lowered), "\nend"]))
    count, pairs, contexts = Counter(), Counter(), Counter()
    for _, held, tokens in rows:
        if not held:
            count.update(tokens)
            pairs.update(zip(["\nstart", *tokens], tokens))
            contexts.update(["\nstart", *tokens[:-1]])
    total, types, result = sum(count.values()), len(count), []
    own = lambda w: (count[w] + 1) / (total + types + 1)
    for doc_id, held, tokens in rows:
        base = sum(math.log10(own(w)) for w in tokens)
        score = 0.0
        for v, w in zip(["\nstart", *tokens], tokens):
            score += math.log10((pairs[v, w] + lm.PRIOR * own(w)) / (contexts[v] + lm.PRIOR))
        result.append((doc_id, held, len(tokens), sum(count[w] > 0 for w in tokens), total, base, score))
    return sorted(result, key=lambda r: (r[0] is None, r))


def got(spark, docs):
    frame = spark.createDataFrame([(*d, "x", 1) for d in docs], SCHEMA)
    return sorted((tuple(r) for r in lm.score(frame).collect()), key=lambda r: (r[0] is None, r))


@pytest.mark.parametrize("block", [50, 1 << 20])
def test_scores(spark, monkeypatch, block):
    monkeypatch.setattr(lm, "BLOCK", block)
    r = random.Random(block)
    vocabulary = [f"w{n}" for n in range(40)] + ["The", "THE", "é", "É", "\U0001f600"]
    docs = [(n, " ".join(r.choice(vocabulary[: r.choice([3, 45])]) for _ in range(r.choice([0, 1, 5, 60])))) for n in range(80)]
    docs += [(100, None), (101, "the \x0b\x0c\x1c the x"), (None, "the w1"), (3, docs[3][1]), (102, "unseen words only"), (103, "the " * 3000)]
    want, found = plain(docs), got(spark, docs)
    assert [f[:5] for f in found] == [w[:5] for w in want]
    assert [f[5] for f in found] == pytest.approx([w[5] for w in want], rel=1e-9)
    assert [f[6] for f in found] == pytest.approx([w[6] for w in want], rel=0.01, abs=0.05)


def test_empty_and_single(spark):
    assert got(spark, []) == []
    want, found = plain([(1, "a")])[0], got(spark, [(1, "a")])[0]
    assert found[:5] == want[:5] and found[5:] == pytest.approx(want[5:], rel=1e-4)


def test_probabilities_sum_to_one():
    """Over all known words and the class of unknown ones, after a context."""
    counts, times = np.array([5, 3, 2, 1]), np.array([2, 1])
    trie = lm.build_trie(np.array([2, 3, 4, 5]), counts, np.array([0, 0]), np.array([1, 2]), times, 11, 4)
    context = np.array([2, 2, 2, 2])
    known = (10 ** trie.score(context, np.array([2, 3, 4, 5]))).sum()
    # The context came five times but is followed three times here, as one's followers may lie in two shards.
    unknown = lm.PRIOR / (5 + lm.PRIOR) / 16
    assert known + unknown == pytest.approx((3 + lm.PRIOR) / (5 + lm.PRIOR))
