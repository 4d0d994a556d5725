"""Token shards and their key index against encoding every text by itself."""

import random
import zlib
from functools import cache
from itertools import accumulate

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tidelake.llm import token_index
from tidelake.session import scratch_dir

PATH = public_tokenizers.path("byte_bpe_50k.json")
END = 2
ODD = [
    "", " ", "  ", "a", " a", "a ", "a  b", "a\nb c", "a \n b", "x\xa0 y", "x \xa0y", "x\u2003\n z", "\u3000 q", "it's we'll  do 'tis", "#", "# # ##", "<|endoftext|> in a text",
    "tab\t two\t\tx", "\x1c a\x1c b\x1d\x1d c", "\x85 next\x85line", "na\xefve \u0153uvre \xc0\xc9 \u6f22\u5b57 \u304b\u306a", "12 345,6 7  8", "\r\n\r\n end\r\n", "emoji \U0001f469\u200d\U0001f469\u200d\U0001f467 x", "\x00 nul", "a" * 3000, "word " * 5000,
]


@cache
def plain_tokenizer():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    return tokenizer


def whole_ids(text):
    return [*plain_tokenizer().encode(text or "", add_special_tokens=False).ids, END]


def expected(docs):
    """In ascending order of ids; rows of one id in any order, so these give their sizes only."""
    ordered = sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0))
    ids = [whole_ids(t) for _, t in ordered]
    starts = accumulate([len(i) for i in ids], initial=0)
    return [(d, s, len(i), zlib.crc32(np.array(i, "<u4").tobytes())) for (d, _), s, i in zip(ordered, starts, ids, strict=False)]


def stored(spark, docs, **options):
    folder = scratch_dir(spark, "store")
    keys = token_index.write(spark.createDataFrame(docs, "doc_id long, text string"), folder, PATH, END, **options)
    return folder, keys


def test_words_encode_as_the_text_does():
    encoder = token_index.Encoder(PATH, END)
    r = random.Random(3)
    made = ["".join(r.choice(" \n\tab'sé1,# \x1c") for _ in range(r.randint(0, 40))) for _ in range(3000)]
    for texts in (ODD, made):
        ids, sizes = encoder(pa.array(texts))
        assert [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])] == [whole_ids(t) for t in texts]


def test_other_tokenizers_get_whole_texts():
    encoder = token_index.Encoder(public_tokenizers.path("word_bpe_49k.json"), END)
    assert not encoder.by_words
    ids, sizes = encoder(pa.array(["Two  words", "", "More"]))
    want = [encoder.tokenizer.encode(t, add_special_tokens=False).ids + [END] for t in ("Two  words", "", "More")]
    assert ids.tolist() == sum(want, []) and sizes.tolist() == [len(w) for w in want]


def test_index_is_minimal_and_perfect():
    r = np.random.default_rng(1)
    for n in (0, 1, 2, 5000):
        keys = np.stack([np.arange(n, dtype=np.uint64), r.integers(0, 3, n).astype(np.uint64)])
        index = token_index.KeyIndex.from_bytes(token_index.KeyIndex.of(keys, np.arange(n), np.arange(n) * 7, np.arange(n) + 1).to_bytes())
        assert sorted(index.slots(keys).tolist()) == list(range(n))
        held, entries = index.find(keys)
        assert held.all() and entries["offset"].tolist() == (np.arange(n) * 7).tolist()
        strange = keys.copy()
        strange[0] += np.uint64(1 << 40)
        assert not index.find(strange)[0].any()


@pytest.mark.parametrize("partitions", [1, 7])
def test_round_trip(spark, conf, monkeypatch, partitions):
    conf("spark.sql.shuffle.partitions", partitions)
    conf("spark.sql.adaptive.enabled", False)
    monkeypatch.setattr(token_index, "LEAST_KEYS", 10)
    docs = [(n * 3 - 20, t) for n, t in enumerate(ODD + [None])]
    random.Random(0).shuffle(docs)
    folder, keys = stored(spark, docs)
    got = sorted(tuple(r) for r in token_index.checksums(spark, folder, keys).collect())
    assert got == [(d, 0, s, n, c) for d, s, n, c in expected(docs)]
    read = {r.doc_id: r.ids for r in token_index.read_ids(spark, folder, keys).collect()}
    assert read == {d: whole_ids(t) for d, t in docs}


def test_repeated_and_absent_ids(spark, conf):
    """Rows of one id over several shards are numbered through; strange keys are not held."""
    conf("spark.sql.shuffle.partitions", 5)
    conf("spark.sql.adaptive.enabled", False)
    docs = [(5, f"text {n}") for n in range(30)] + [(5, "same")] * 30 + [(None, "none"), (None, None), (-9, "first"), (8, "last")]
    folder, keys = stored(spark, docs)
    rows = token_index.read_ids(spark, folder, keys).collect()
    assert sorted(r.copy for r in rows if r.doc_id == 5) == list(range(60))
    assert sorted(map(repr, ((r.doc_id, r.ids) for r in rows))) == sorted(map(repr, ((d, whole_ids(t)) for d, t in docs)))
    ordered = sorted(rows, key=lambda r: r.start)
    assert [r.start for r in ordered] == list(accumulate([r.n_tokens for r in ordered], initial=0))[:-1]
    assert [r.doc_id for r in ordered][:3] == [None, None, -9] and ordered[-1].doc_id == 8
    asked = spark.createDataFrame([(8, 9), (6, 9), (None, 9), (8, 9)], "doc_id int, shard int")
    found = sorted((tuple(r[:2]) + (r.shard is not None,) for r in token_index.lookup(spark, folder, asked).collect()), key=repr)
    assert found == sorted([(6, 0, False), (8, 0, True), (8, 0, True), (None, 0, True)], key=repr)


def test_small_spans_and_wide_ids(spark, monkeypatch):
    docs = [(n, "one two three " * n) for n in range(20)]
    folder, keys = stored(spark, docs, kind="<u4")
    assert sorted(tuple(r)[0:1] + tuple(r)[2:] for r in token_index.checksums(spark, folder, keys).collect()) == expected(docs)
    places = [(0, 0, 5), (0, 3, 40), (0, 1, 2)]
    monkeypatch.setattr(token_index, "SPAN", 4)
    single, _ = stored(spark, [(1, "a b c d e f g h i j k l m n o p q r s t u v w x y z " * 3)])
    want = whole_ids("a b c d e f g h i j k l m n o p q r s t u v w x y z " * 3)
    name = spark.read.parquet(f"{single}/manifest").first()["shard"]
    got = [np.concatenate(list(p)).tolist() for p in token_index._payload(single, "<u2", iter([(name, o, n) for _, o, n in places]))]
    assert got == [want[o : o + n] for _, o, n in places]


def test_ids_that_do_not_fit_and_no_rows(spark):
    with pytest.raises(Exception, match="does not fit"):
        stored(spark, [(1, "word")], kind="<u1")
    folder, keys = stored(spark, [])
    assert token_index.checksums(spark, folder, keys).count() == 0
    asked = spark.createDataFrame([(1,)], "doc_id long")
    assert [tuple(r) for r in token_index.lookup(spark, folder, asked).collect()] == [(1, 0, None, None, None, None)]


def test_clashing_columns(spark):
    frame = spark.createDataFrame([(1, "a b", 2, 3, 4, 5)], "doc_id int, text string, copy int, shard int, place int, of_text int")
    folder = scratch_dir(spark, "store")
    keys = token_index.write(frame, folder, PATH, END)
    assert [r.ids for r in token_index.read_ids(spark, folder, keys).collect()] == [whole_ids("a b")]
