"""Language-model scoring with an Elias-Fano bigram trie in shards.

The model is p(w | v) = (c(v w) + m p(w)) / (c(v) + m) with p(w) = (c(w) + 1) / (N + V + 1): counts of the training texts, drawn
towards the word's own probability. It sums to one over the known words and one class of unknown ones.

Texts are cut into blocks of a bounded number of tokens, in which words and pairs are counted first, so that frequent ones cross
the cluster once for each block. Three exchanges of packed arrays follow. Words go to shards by hash, are numbered
and counted, and the numbers come back to the blocks; pairs go to shards by context, which build their part of the trie, look
up every pair in it, and send each block the sums of its texts; blocks give rows. Shards follow the number of blocks. No task holds the whole vocabulary or trie.
"""

from __future__ import annotations

import mmap
import struct
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tidelake.llm.bytewords import BLANK, mixed, pieces, word_hashes, word_starts
from tidelake.llm.common import held_out, whole
from tidelake.llm.eliasfano import Trie
from tidelake.session import staged

#: Tokens of a block, but for one longer text, which is a block of its own.
BLOCK = 1 << 20
#: Blocks whose tokens a shard holds on average, at most: with more there are more shards.
SHARD_BLOCKS = 4
#: m: what a context's occurrences are weighed against.
PRIOR = 20.0
#: Words in code: unknown ones, and what stands before a text. Others are numbered from 2.
UNKNOWN, START, FIRST = 0, 1, 2
#: Fixed point of log10 probabilities, so that sums do not depend on their order.
FIXED = 1 << 20
#: The hash of a text's end.
END = np.uint64(0x5DEECE66D1234567)
_LOWER = np.arange(256, dtype=np.uint16) + 1
_LOWER[0x41:0x5B] += 32
_LOWER[BLANK] = 0


def pack(arrays: list[np.ndarray]) -> bytes:
    """Integer arrays as bytes, plane by plane, compressed."""
    parts, codec = [struct.pack("<q", len(arrays))], pa.Codec("zstd")
    for a in arrays:
        raw = np.ascontiguousarray(a).view(np.uint8).reshape(len(a), -1).T.tobytes() if len(a) else b""
        body = codec.compress(raw, asbytes=True) if raw else b""
        parts.append(struct.pack("<8s3q", a.dtype.str.encode(), len(a), len(raw), len(body)) + body)
    return b"".join(parts)


def unpack(data: bytes) -> list[np.ndarray]:
    (n,), at, result, codec = struct.unpack_from("<q", data), 8, [], pa.Codec("zstd")
    for _ in range(n):
        kind, count, size, body = struct.unpack_from("<8s3q", data, at)
        at += 32
        kind = np.dtype(kind.rstrip(b"\0").decode())
        if count:
            raw = np.frombuffer(codec.decompress(data[at : at + body], size), np.uint8)
            result.append(np.ascontiguousarray(raw.reshape(kind.itemsize, count).T).view(kind)[:, 0])
        else:
            result.append(np.empty(0, kind))
        at += body
    return result


def _small(values: np.ndarray) -> np.ndarray:
    """In as few bytes as the largest value needs."""
    most = int(values.max()) if len(values) else 0
    return values.astype(np.min_scalar_type(most))


def _tokens(column) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Groups of word hashes, and the row of each; rows ascend."""
    for p in pieces(column):
        starts, piece = word_starts(p)
        yield word_hashes(_LOWER[p.data], starts), p.row[piece]


BLOCKS = "block long, ids array<long>, sizes binary, held binary, words binary, tokens binary"


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Successive texts as blocks; a block's number tells the task, so a task run again gives the same."""
    task, made = TaskContext.get().partitionId(), 0

    def block(rows: list[tuple]) -> pa.RecordBatch:
        nonlocal made
        hashes = np.concatenate([r[2] for r in rows])
        sizes = np.array([len(r[2]) for r in rows], np.int32)
        held = np.array([r[1] for r in rows], np.uint8)
        names, tokens = np.unique(hashes, return_inverse=True)
        counts = np.bincount(tokens[np.repeat(held == 0, sizes)], minlength=len(names))
        made += 1
        values = [[(task << 24) + made - 1], [[r[0] for r in rows]], [pack([sizes])], [pack([held])], [pack([names, _small(counts)])], [pack([_small(tokens)])]]
        types = [pa.int64(), pa.list_(pa.int64()), *[pa.binary()] * 4]
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, types, strict=True)], names=[f.split()[0] for f in BLOCKS.split(", ")])

    waiting, size = [], 0
    for batch in batches:
        ids, held = batch.column("doc_id").to_pylist(), batch.column("held").to_pylist()
        parts: list = []
        row = 0

        def finished(upto: int) -> Iterator[pa.RecordBatch]:
            """Rows before ``upto`` have all their words."""
            nonlocal row, parts, waiting, size
            while row < upto:
                mine = [h[a:b] for h, r in parts for a, b in [np.searchsorted(r, [row, row + 1])] if b > a]
                words = np.concatenate([*mine, np.array([END])])
                if waiting and size + len(words) > BLOCK:
                    yield block(waiting)
                    waiting, size = [], 0
                waiting.append((ids[row], held[row], words))
                size += len(words)
                row += 1
            parts = [(h, r) for h, r in parts if len(r) and r[-1] >= row]

        for hashes, rows in _tokens(batch.column("text")):
            parts.append((hashes, rows))
            if len(rows):
                yield from finished(int(rows[-1]))
        yield from finished(batch.num_rows)
    if waiting:
        yield block(waiting)


def _cuts(hashes: np.ndarray, shards: int) -> np.ndarray:
    """Where sorted hashes pass from one of ``shards`` equal ranges to the next."""
    shard = ((hashes >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)
    return np.searchsorted(shard, np.arange(shards + 1))


def _word_pieces(shards: int):
    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, packed in zip(batch.column("block").to_pylist(), batch.column("words").to_pylist(), strict=True):
                names, counts = unpack(packed)
                at = _cuts(names, shards)
                some = np.flatnonzero(np.diff(at))
                parts = [pack([names[at[s] : at[s + 1]], counts[at[s] : at[s + 1]]]) for s in some]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(some, pa.int32()), pa.array([number] * len(some), pa.int64()), pa.array(parts, pa.binary())], names=["shard", "block", "words"]
                )

    return cut_up


NUMBERED = "shard int, block long, words binary, types long, known long, tokens long"


def _number(group: pa.Table) -> pa.Table:
    """A shard's words in order of hash: each block gets their places and counts; one row without a block tells how many there are."""
    parts = [unpack(b) for b in group.column("words").to_pylist()]
    names, inverse = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    counts = _sums(inverse, np.concatenate([p[1].astype(np.int64) for p in parts]), len(names))
    ends = np.cumsum([0, *[len(p[0]) for p in parts]])
    places = [inverse[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
    # Places ascend: their steps are small.
    words = [pack([_small(np.diff(p, prepend=0)), _small(counts[p])]) for p in places]
    n = len(words)
    shard = group.column("shard")[0].as_py()
    return pa.Table.from_arrays(
        [
            pa.array([shard] * (n + 1), pa.int32()),
            pa.array([*group.column("block").to_pylist(), None], pa.int64()),
            pa.array([*words, None], pa.binary()),
            *[pa.array([None] * n + [int(x)], pa.int64()) for x in (len(names), np.count_nonzero(counts), counts.sum())],
        ],
        names=[f.split()[0] for f in NUMBERED.split(", ")],
    )


ROUTED = "shard int, block long, ids array<long>, body binary"
_ROUTED = pa.schema([("shard", pa.int32()), ("block", pa.int64()), ("ids", pa.list_(pa.int64())), ("body", pa.binary())])


def _sums(place: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Exact sums of integers by place: in doubles where these hold them, else one by one."""
    if not len(values) or int(np.abs(values).max()) * len(values) < 1 << 53:
        return np.bincount(place, values, n).astype(np.int64)
    result = np.zeros(n, np.int64)
    np.add.at(result, place, values)
    return result


def _own(counts: np.ndarray, total: int, types: int) -> np.ndarray:
    return np.log10((counts + 1) / (total + types + 1))


def _left(counts: np.ndarray) -> np.ndarray:
    return np.log10(PRIOR / (counts + PRIOR))


def _pairs(offsets: list[int], total: int, types: int, texts: int, shards: int):
    """Base sums of a block's texts, and its pairs of known words by shard.

    A shard is a hash of the context; a context of over ``1 / shards`` of all tokens is spread by the next word as well.
    """

    def routed(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return _ROUTED.empty_table()
        row = {c: left.column(c)[0].as_py() for c in left.column_names}
        found = sorted(zip(right.column("shard").to_pylist(), right.column("words").to_pylist(), strict=True))
        numbers, counts = [], []
        for shard, packed in found:
            steps, count = unpack(packed)
            numbers.append(np.cumsum(steps, dtype=np.int64) + offsets[shard] + FIRST)
            counts.append(count.astype(np.int64))
        number, count = np.concatenate(numbers), np.concatenate(counts)
        (sizes,), (held,), (tokens,) = unpack(row["sizes"]), unpack(row["held"]), unpack(row["tokens"])
        n, heads = len(sizes), np.concatenate([[0], np.cumsum(sizes)[:-1]])
        tokens = tokens.astype(np.int64)
        doc = np.repeat(np.arange(n, dtype=np.int32), sizes)
        seen = count[tokens]
        base = np.add.reduceat(_own(seen, total, types), heads)
        known = np.add.reduceat((seen > 0).astype(np.int64), heads)
        # The context is the token before; the last place stands for a text's start.
        number, count = np.append(number, START), np.append(count, texts)
        context = np.concatenate([[len(number) - 1], tokens[:-1]])
        context[heads] = len(number) - 1
        inside = (count[context] > 0) & (seen > 0)
        alone = ~inside
        outside = _left(count[context[alone]]) + _own(seen[alone], total, types)
        sums = _sums(doc[alone], np.rint(outside * FIXED).astype(np.int64), n)
        key = (context[inside] << 32) | tokens[inside]
        order = np.argsort(key, kind="stable")
        key, whose = key[order], doc[inside][order]
        train = (held[whose] == 0).astype(np.int64)
        new = np.ones(len(key), bool)
        new[1:] = key[1:] != key[:-1]
        first = np.flatnonzero(new)
        pair = np.cumsum(new) - 1
        times = np.bincount(pair, train, len(first)).astype(np.int64)
        # Texts ascend within a pair: one posting for each, with how often.
        post = new.copy()
        post[1:] |= whose[1:] != whose[:-1]
        at = np.flatnonzero(post)
        often = np.diff(np.append(at, len(key)))
        a, b = key[first] >> 32, key[first] & 0xFFFFFFFF
        spread = 1 + count[a] * shards // max(total, 1)
        part = mixed(number[b].astype(np.uint64)) % spread.astype(np.uint64)
        shard = (mixed(number[a].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + part) % np.uint64(shards)).astype(np.int64)
        by = np.argsort(shard, kind="stable")
        post_shard = shard[pair[at]]
        post_by = np.argsort(post_shard, kind="stable")
        posts = np.bincount(pair[at], minlength=len(first))
        ends, post_ends = np.searchsorted(shard[by], np.arange(shards + 1)), np.searchsorted(post_shard[post_by], np.arange(shards + 1))
        rows = [(int(row["block"] % shards), row["block"], row["ids"], pack([sizes, held, known, base.view(np.int64), sums]))]
        for s in range(shards):
            mine, mine_posts = by[ends[s] : ends[s + 1]], at[post_by[post_ends[s] : post_ends[s + 1]]]
            if not len(mine):
                continue
            words, where = np.unique(np.concatenate([a[mine], b[mine]]), return_inverse=True)
            # Numbers ascend with hashes, but for the start's.
            ascending = np.argsort(number[words], kind="stable")
            rank = np.empty(len(words), np.int64)
            rank[ascending] = np.arange(len(words))
            words = words[ascending]
            body = [
                np.diff(number[words], prepend=0),
                count[words],
                *[rank[where[x]] for x in (slice(0, len(mine)), slice(len(mine), None))],
                times[mine],
                posts[mine],
                whose[mine_posts],
                often[np.searchsorted(at, mine_posts)],
            ]
            rows.append((s, row["block"], None, pack([_small(x) for x in body])))
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _ROUTED.types, strict=True)], schema=_ROUTED)

    return routed


def build_trie(words: np.ndarray, counts: np.ndarray, first: np.ndarray, second: np.ndarray, times: np.ndarray, total: int, types: int) -> Trie:
    """From sorted word numbers with their counts, and sorted pairs of places in ``words`` with theirs (over 0)."""
    own = _own(counts, total, types)
    pair = np.log10((times + PRIOR * 10 ** own[second]) / (counts[first] + PRIOR))
    return Trie.build(words, own, _left(counts), words[first], words[second], pair)


def _look_up(total: int, types: int):
    """A shard's trie from all its pairs, written to a file of the task's own and mapped; then every pair's probability from it."""

    def looked_up(group: pa.Table) -> pa.Table:
        rows = list(zip(*[group.column(c).to_pylist() for c in ("shard", "block", "ids", "body")], strict=True))
        result = [r for r in rows if r[2] is not None]
        asked = [(block, unpack(body)) for _, block, ids, body in rows if ids is None]
        if asked:
            names = [np.cumsum(p[0], dtype=np.int64) for _, p in asked]
            words, index = np.unique(np.concatenate(names), return_index=True)
            counts = np.concatenate([p[1] for _, p in asked])[index].astype(np.int64)
            place = [np.searchsorted(words, n) for n in names]
            width = max(1, int(len(words)).bit_length())
            keys = [(w[p[2]] << width) | w[p[3]] for w, (_, p) in zip(place, asked, strict=True)]
            pairs, inverse = np.unique(np.concatenate(keys), return_inverse=True)
            times = _sums(inverse, np.concatenate([p[4].astype(np.int64) for _, p in asked]), len(pairs))
            first, second = pairs >> width, pairs & ((1 << width) - 1)
            seen = times > 0
            built = build_trie(words, counts, first[seen], second[seen], times[seen], total, types).to_bytes()
            with tempfile.TemporaryFile() as file:
                file.write(built)
                file.flush()
                del built
                trie = Trie.open(mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ))
                score = np.rint(trie.score(words[first], words[second]) * FIXED).astype(np.int64)
            at = 0
            for (block, p), key in zip(asked, keys, strict=True):
                mine = score[inverse[at : at + len(key)]]
                at += len(key)
                sums = _sums(p[6].astype(np.int64), np.repeat(mine, p[5]) * p[7], int(p[6].max()) + 1)
                texts = np.flatnonzero(sums)
                # log10 probabilities are below 0.
                result.append((0, block, None, pack([_small(np.diff(texts, prepend=0)), _small(-sums[texts])])))
        columns = list(zip(*result, strict=True)) if result else [[], [], [], []]
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, _ROUTED.types, strict=True)], schema=_ROUTED)

    return looked_up


RESULT = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def _gather(group: pa.Table) -> pa.Table:
    """The sums of a block's texts."""
    ids, bodies = group.column("ids").to_pylist(), [unpack(b) for b in group.column("body").to_pylist()]
    own = next(k for k, i in enumerate(ids) if i is not None)
    sizes, held, known, base, sums = bodies[own]
    sums = sums.copy()
    for k, body in enumerate(bodies):
        if k != own:
            sums[np.cumsum(body[0], dtype=np.int64)] -= body[1].astype(np.int64)
    columns = [pa.array(ids[own], pa.int64()), pa.array(held == 1), *[pa.array(c.astype(np.int64)) for c in (sizes, known)], pa.array(base.view(np.float64)), pa.array(sums / FIXED)]
    return pa.Table.from_arrays(columns, names=[f.split()[0] for f in RESULT.split(", ")])


def score(docs: DataFrame, modulus: int = 7, remainder: int = 2) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` for every row of ``docs``.

    The model learns from the whole texts of rows that are not held out (crc32 of the id as text leaves ``remainder``; a null id is
    not held out). Tokens are runs of non-blanks, A-Z lower-cased, and one end for each text; a null text is an empty one. ``base_score`` is the
    words' own add-one log10 probability, ``score`` the model's, whose quantised pairs are read from the trie. Rows repeated or without an
    id are rows of their own, and teach as often as they come; other columns are ignored. An empty table gives an empty one.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out("doc_id", modulus, remainder).alias("held"), whole("text").alias("text"))
    blocks = staged(rows.mapInArrow(_blocks, BLOCKS), "lm-blocks")
    # As many as Spark shuffles to, or more where the text is large.
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-blocks.count() // SHARD_BLOCKS))
    words = blocks.select("block", "words").mapInArrow(_word_pieces(shards), "shard int, block long, words binary")
    numbered = staged(words.groupBy("shard").applyInArrow(_number, NUMBERED), "lm-words")
    # One row for each shard.
    facts = {r["shard"]: r for r in numbered.filter("block IS NULL").select("shard", "types", "known", "tokens").collect()}
    sizes = [facts[s]["types"] if s in facts else 0 for s in range(shards)]
    offsets = [0, *np.cumsum(sizes).tolist()]
    total, types = sum(f["tokens"] for f in facts.values()), sum(f["known"] for f in facts.values())
    texts = docs.filter(~held_out("doc_id", modulus, remainder)).count()
    bodies = blocks.select("block", "ids", "sizes", "held", "tokens").groupBy("block")
    back = numbered.filter("block IS NOT NULL").select("shard", "block", "words").groupBy("block")
    routed = bodies.cogroup(back).applyInArrow(_pairs(offsets, total, types, texts, shards), ROUTED)
    sums = routed.groupBy("shard").applyInArrow(_look_up(total, types), ROUTED)
    return sums.groupBy("block").applyInArrow(_gather, RESULT).select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score"
    )
