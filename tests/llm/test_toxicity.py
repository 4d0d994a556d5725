"""Toxicity: the machine against its definition, an interaction that sums miss, held-out accuracy."""

import random

import numpy as np
import pyarrow as pa
import pytest

from tidelake.llm import bytewords, toxicity
from tidelake.llm.common import held_out

DIR = "/root/testdata/sf0.1"


def scores(model, texts):
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["doc_id", "text"])
    return np.array(next(iter(toxicity._scorer(model)([batch]))).column("score"))


def learn(texts, labels):
    return toxicity.fit(toxicity._distinct_terms(pa.array(texts)), np.array(labels, float))


def test_scores_are_the_definition(monkeypatch):
    """Every pair of terms by its own product, whatever the pieces."""
    texts = ["Clown town, clown!", "", "éa clowns " * 30, "x" * 100 + " town"]
    terms = toxicity._distinct_terms(pa.array(texts))
    names = np.unique(np.concatenate(terms))
    rng = np.random.default_rng(0)
    model = toxicity.Machine(names, rng.normal(0, 1, len(names)) / 9, rng.normal(0, 1, (len(names), 3)) / 9, -0.5)
    want = []
    for mine in terms:
        at = np.searchsorted(names, mine)
        pairs = sum(model.factors[a] @ model.factors[b] for k, a in enumerate(at) for b in at[:k])
        want.append(1 / (1 + np.exp(-(model.bias + model.weights[at].sum() + pairs))))
    for piece in (1 << 20, 16):
        monkeypatch.setattr(bytewords, "PIECE", piece)
        if piece == 1 << 20:
            assert np.allclose(scores(model, texts), want)
        assert scores(model, texts[:2])[1] == pytest.approx(want[1])


def test_interaction():
    """A villager insulted is toxic, and so is weather praised; no sum over single terms tells more than half of it."""
    r = random.Random(0)
    texts, labels = [], []
    for n in range(1600):
        insult, group = n % 2, n // 2 % 2
        fill = [r.choice(["plain", "words", "here", "and", "there"]) for _ in range(12)]
        fill += ["scoundrel" if insult else "friend", "villagers" if group else "weather"]
        r.shuffle(fill)
        texts.append(" ".join(fill))
        labels.append(int(insult == group))
    got = scores(learn(texts[:1200], labels[:1200]), texts[1200:]) >= 0.3
    assert (got == np.array(labels[1200:], bool)).mean() > 0.95


def test_interaction_of_rare_words():
    """Words that tell in pairs alone, rarer than 200 common terms, amid thousands of others."""
    r = random.Random(0)
    common = [f"stop{chr(97 + n // 26)}{chr(97 + n % 26)}" for n in range(100)]
    others = ["".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(8)) for _ in range(3000)]
    texts, labels = [], []
    for n in range(4000):
        words = r.sample(common, 25) + [r.choice(others) for _ in range(15)]
        first, second = n // 5 % 2, n // 10 % 2
        if n % 5 < 2:
            words += ["scoundrel" if first else "friend", "villagers" if second else "weather"]
            labels.append(int(first == second))
        else:
            words.append("awful" if first else "lovely")
            labels.append(first)
        r.shuffle(words)
        texts.append(" ".join(words))
    got = scores(learn(texts[:3000], labels[:3000]), texts[3000:]) >= 0.5
    in_pairs = np.arange(3000, 4000) % 5 < 2
    assert (got == np.array(labels[3000:], bool))[in_pairs].mean() > 0.95


def test_held_out_accuracy_and_repeatability(spark):
    docs, labels = (spark.read.parquet(f"{DIR}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.train(docs, labels)
    table = toxicity.score(docs, model).join(labels, "doc_id").withColumn("held", held_out("doc_id", 4)).filter("held").toPandas()
    toxic, clean = table[table.toxic == 1], table[table.toxic == 0]
    assert (toxic.score >= 0.3).mean() > 0.85 and (clean.score < 0.3).mean() > 0.98
    again = toxicity.train(docs.repartition(7), labels)
    assert np.array_equal(again.weights, model.weights) and np.array_equal(again.factors, model.factors)


def test_odd_rows(spark):
    docs = [(1, "idiot", 3), (2, "", 3), (3, None, 3), (None, "idiot", 3), (1, "idiot", 3), (4, "a " * 300_000, 3)]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string, label int")
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, None), (None, 1), (8, 1), (4, 0), (4, 1)], "doc_id bigint, toxic int")
    model = toxicity.train(frame, labels)
    got = toxicity.score(frame, model).collect()
    assert len(got) == len(docs) and all(0 < r.score < 1 for r in got)
    empty = toxicity.train(frame.limit(0), labels)
    assert {r.score for r in toxicity.score(frame, empty).collect()} == {0.5}
    assert toxicity.score(frame.limit(0), model).count() == 0
