"""Helpers of several operators: exact words, and what a model learns from."""

import numpy as np
import pyarrow as pa
import pytest

from tidelake.llm import lm
from tidelake.llm.bytewords import word_hashes
from tidelake.llm.common import taught


def test_long_words_are_told_apart():
    """Blocks or bytes exchanged over any distance, and the same beginnings."""
    half = bytes(range(1, 65))
    words = [half + half[::-1], half[::-1] + half, b"a" * 64 + b"b" * 64, b"b" * 64 + b"a" * 64, half, half * 2, half * 3, b"a" + b"c" * 9999 + b"b", b"b" + b"c" * 9999 + b"a"]
    data = np.frombuffer(b"".join(words), np.uint8)
    starts = np.cumsum([0, *map(len, words[:-1])])
    assert len(set(word_hashes(data, starts).tolist())) == len(words)
    first = word_hashes(data, starts, 64)
    assert first[0] == first[4] == first[5] == first[6] and len(set(first.tolist())) == len(words) - 3


def test_language_model_knows_long_words(spark):
    x, y = "0123456789abcdef" * 4, "fedcba9876543210" * 4
    docs = [(n, x + y) for n in range(20)] + [(n, y + x) for n in range(20, 60)]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    learnt = lm.held_out("doc_id", 7)
    taught_ids = {r.doc_id for r in frame.filter(~learnt).collect()}
    told = frame.filter((frame.text == x + y) | learnt)
    for row in lm.score(told, modulus=7, remainder=2).collect():
        known = docs[row.doc_id][1] == x + y and any(n in taught_ids for n in range(20))
        assert row.n_known == 1 + known, row


@pytest.mark.parametrize("most, longest, expected", [(1 << 20, 1 << 10, 5), (250, 1 << 10, 2), (1 << 20, 99, 0)])
def test_taught_rows_are_bounded(spark, most, longest, expected):
    """One row of an id repeated 10,000 times, and no more bytes than are allowed."""

    def encode(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"), batch.column("text").cast(pa.binary())], names=["doc_id", "label", "code"])

    ids = [n for n in range(40)]
    docs = spark.createDataFrame([(n, "x" * 100) for n in ids] + [(None, "y")], "doc_id bigint, text string")
    docs = docs.union(spark.range(10_000).selectExpr("3L AS doc_id", "repeat('x', 100) AS text"))
    labels = spark.createDataFrame([(n, n % 2) for n in ids] + [(5, 0), (5, 1), (None, 1)], "doc_id bigint, toxic int")
    rows = taught(docs, labels, "toxic", 5, encode, "code", most, longest)
    assert len(rows) == expected and len({r["doc_id"] for r in rows}) == expected
