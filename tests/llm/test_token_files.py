"""Flat token files: counts against splitting the whole file, and a round trip through a tokenizer."""

import random

import numpy as np
import pytest

from tidelake.llm import token_files
from tidelake.llm.queries import RANKS, SEPARATOR

SEP = 7


def plain(tokens):
    ends = [i for i, t in enumerate(tokens) if t == SEP]
    docs = [(e - s - 1, True) for s, e in zip([-1, *ends], ends)]
    last = ends[-1] if ends else -1
    return docs + ([(len(tokens) - last - 1, False)] if last + 1 < len(tokens) else [])


@pytest.mark.parametrize("kind", ["<u2", "<u4"])
@pytest.mark.parametrize("block", [8, 64, 4 << 20])
def test_counts(spark, tmp_path, block, kind):
    r = random.Random(block)
    files = {
        "random.bin": [r.choice([SEP, 1, 2, 300, 50_000]) for _ in range(500)],
        "long.bin": [1] * 300 + [SEP] + [2] * 100,
        "empty.bin": [],
        "none.bin": [5] * 40,
        "separators.bin": [SEP] * 33,
        "odd.bin": [1, 2, SEP, 4],
    }
    for name, tokens in files.items():
        (tmp_path / name).write_bytes(np.array(tokens, kind).tobytes() + (b"x" if name == "odd.bin" else b""))
    (tmp_path / "_draft").write_bytes(b"1234")
    got = token_files.count_tokens(spark, str(tmp_path), SEP, kind, block).collect()
    found = {name: [(r.n_tokens, r.closed) for r in sorted(got, key=lambda r: r.nth) if r.file == name] for name in files}
    assert found == {name: plain(tokens) for name, tokens in files.items()}
    assert all([r.nth for r in sorted(got, key=lambda r: r.nth) if r.file == n] == list(range(len(found[n]))) for n in files)


def test_documents(spark, tmp_path, monkeypatch):
    r = random.Random(1)
    texts = ["".join(r.choice("abc é\n\U0001f600,1") for _ in range(r.choice([0, 3, 200, 3000]))) for _ in range(60)] + ["<|endoftext|>"]
    docs = [(n, t, 1, "x") for n, t in enumerate(texts)] + [(100, None, 1, "x"), (None, "no id", 1, "x"), (3, texts[3], 1, "x")]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string, nth int, file string").repartition(3)
    encode = token_files.tokenizer(RANKS).encode_ordinary
    got = token_files.document_token_counts(frame, f"file://{tmp_path}/tokens", RANKS, SEPARATOR).collect()
    want = [(d, len(encode(t or ""))) for d, t, *_ in docs]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert token_files.document_token_counts(frame.limit(0), f"{tmp_path}/none", RANKS, SEPARATOR).count() == 0
