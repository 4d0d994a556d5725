"""Fingerprints against a walk step by step, the successor by sorting, the search against all pairs."""

import hashlib
import random

import numpy as np
import pytest

from tidelake.llm import editprint

SCHEMA = "doc_id bigint, text string, part int, band string"


def plain_walk(text):
    """What the walk emits: one character a step, moving on when a random bit says so."""
    emitted, now = [], 0
    for c in text:
        kind = int(editprint._classes(np.array([ord(c)], np.uint32))[0])
        stay = int(editprint.STAYS[kind, now % editprint.PERIOD])
        emitted += [c] * stay
        now += stay
    return emitted


def plain_print(text):
    if not text:
        return bytes(editprint.PLACES)
    emitted, result = plain_walk(text), []
    for record in editprint.RECORDS:
        place = max(int(r) for r in record if r < 2 * len(text))
        result.append(ord(emitted[place]) * 0x85EBCA6B % 2**32 >> 24 if place < len(emitted) else 0)
    return bytes(result)


def random_texts(seed, n):
    r = random.Random(seed)
    return ["".join(r.choice("abcdeé \U0001f600\n") for _ in range(r.choice([0, 1, 2, 7, 50, 400]))) for _ in range(n)]


def test_stays_follow_the_bits():
    moves = editprint.STAYS == 1
    for k in range(editprint.CLASSES):
        for j in range(0, editprint.PERIOD, 97):
            steps = 1
            while not moves[k, (j + steps - 1) % editprint.PERIOD]:
                steps += 1
            assert editprint.STAYS[k, j] == steps


@pytest.mark.parametrize("together", [1, 8, 1000])
def test_fingerprints(monkeypatch, together):
    monkeypatch.setattr(editprint, "TOGETHER", together)
    texts = random_texts(1, 60) + ["x" * 20_000]
    got = [p.tobytes() for p in editprint.fingerprint(texts)]
    assert got == [plain_print(t) for t in texts]
    monkeypatch.setattr(editprint, "CHUNK", 500)
    assert got == [p.tobytes() for p in editprint.fingerprint(texts)]


def test_few_edits_few_differences():
    r = random.Random(4)
    texts = ["".join(r.choice("abcdefgh ") for _ in range(3000)) for _ in range(40)]

    def changed(text):
        text = list(text)
        for _ in range(5):
            at = r.randrange(len(text))
            text[at : at + r.randint(0, 1)] = r.choice(["", "q", "zz"])
        return "".join(text)

    own, new = editprint.fingerprint(texts), editprint.fingerprint([changed(t) for t in texts])
    assert np.median((own == new).mean(1)) > 0.9 and (own == np.roll(own, 1, 0)).mean() < 0.3


def expected(docs):
    rows = sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0))
    result = []
    for (doc_id, text), (_, after) in zip(rows, rows[1:] + rows[:1], strict=True):
        half = len(text) // 2
        new = text[: len(text) - half] + after[:half]
        own, other, third = plain_print(text), plain_print(new), plain_print(after)
        near = [sum(a == b for a, b in zip(own, x, strict=True)) / len(own) for x in (other, third)]
        result.append((doc_id, len(text), hashlib.sha256(new.encode()).hexdigest(), own.hex(), other.hex(), *near))
    return sorted(result, key=repr)


def got(spark, docs):
    frame = spark.createDataFrame([(*d, 1, "x") for d in docs], SCHEMA)
    return sorted((tuple(r) for r in editprint.fingerprints_with_next(frame.repartition(5)).collect()), key=repr)


def test_successors(spark, monkeypatch):
    texts = random_texts(2, 50)
    ids = random.Random(3).sample(range(-5, 1000), 50)
    docs = list(zip(ids, texts, strict=True))
    assert got(spark, docs) == expected(docs)


def test_odd_rows(spark):
    assert got(spark, []) == []
    assert got(spark, [(3, "ab")]) == expected([(3, "ab")])
    # Equal ids: which of their texts comes first is a matter of hashes, so they are equal here.
    docs = [(None, "null id"), (5, "same é"), (5, "same é"), (7, ""), (8, "long " * 9000)]
    assert got(spark, docs) == expected(docs)
    assert got(spark, [(1, None), (2, "ab")]) == expected([(1, ""), (2, "ab")])


def test_search(spark):
    r = random.Random(5)
    base = ["".join(r.choice("abcdefgh ") for _ in range(500)) for _ in range(30)]
    texts = base + [t[:480] + "zzzz" + t[480:] for t in base] + base[:5]
    frame = spark.createDataFrame([(n, t, 1, "x") for n, t in enumerate(texts)], SCHEMA)
    printed = editprint.fingerprints(frame)
    queries = printed.filter("doc_id % 3 = 0")
    found = {(a, b): s for a, b, s in editprint.search(queries, printed, 0.8).collect()}
    prints = [p.tobytes().hex() for p in editprint.fingerprint(texts)]
    alike = lambda a, b: sum(a[2 * k : 2 * k + 2] == b[2 * k : 2 * k + 2] for k in range(64)) / 64
    every = {(a, b): alike(a, b) for a in prints[::3] for b in prints if alike(a, b) >= 0.8}
    assert set(found) <= set(every) and all(found[p] == every[p] for p in found)
    assert len(found) >= 0.95 * len(every) > 15
