"""SimHash near-duplicates against brute force."""

import random
import re

import pytest
import xxhash

from tidelake.llm import simhash
from tidelake.llm.components import connected_components

SCHEMA = "doc_id bigint, text string"


def brute_print(text, shingle=3):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    runs = [words[i : i + shingle] for i in range(len(words) - shingle + 1)] or ([words] if words else [])
    hashes = [xxhash.xxh64(" ".join(r).encode(), seed=42).intdigest() for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, max_bits):
    """Smallest id reachable of (id, print) pairs, by comparing all."""
    parent = list(range(len(prints)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i][1] ^ prints[j][1]).bit_count() <= max_bits:
                parent[top(i)] = top(j)
    ids = {}
    for i, (doc_id, _) in enumerate(prints):
        ids.setdefault(top(i), []).append(doc_id)
    return [min((d for d in ids[top(i)] if d is not None), default=None) for i in range(len(prints))]


def near(spark, docs, **options):
    frame = spark.createDataFrame(docs, SCHEMA)
    got = simhash.near_duplicates(frame, **options).collect()
    return sorted(((r.doc_id, r.fingerprint, r.component_id) for r in got), key=repr)


def expected(docs, max_bits=2):
    prints = [(d, brute_print(t)) for d, t in docs]
    roots = brute_components(prints, max_bits)
    return sorted(((d, f"{p:016x}", root) for (d, p), root in zip(prints, roots, strict=True)), key=repr)


def test_texts(spark):
    r = random.Random(1)
    base = [" ".join(r.choice("the of and ab ÀB Éc x1 Zz").lower() + str(r.randint(0, 9)) for _ in range(300)) for _ in range(4)]
    docs = [(n, base[n % 4]) for n in range(12)]
    docs += [(20 + n, base[0] + f" extra{n}") for n in range(8)]
    docs += [(40, None), (41, ""), (42, " \t\n"), (43, "one"), (44, "ONE"), (45, "one two"), (46, "É é"), (46, "É é"), (None, "one")]
    docs += [(50, "word\x0b\x0c\x1c \x85 next three four"), (51, " ".join(f"w{n}" for n in range(70_000)))]
    assert near(spark, docs) == expected(docs)


def test_no_rows_and_other_columns(spark):
    assert near(spark, []) == []
    frame = spark.createDataFrame([(7, "a b c", 1, 2, "x")], "doc_id int, text string, simhash int, key int, hashes string")
    assert [tuple(r)[::2] for r in simhash.near_duplicates(frame).collect()] == [(7, 7)]
    assert simhash.keep_first(frame).columns == frame.columns
    assert simhash.keep_first(frame).count() == 1


@pytest.mark.parametrize("paired", [1, 16])
@pytest.mark.parametrize("max_bits", [0, 1, 2, 3])
def test_links_reach_what_pairs_reach(spark, monkeypatch, paired, max_bits):
    """Random balls and chains of fingerprints, compared in pairs or met half way."""
    monkeypatch.setattr(simhash, "PAIRED", paired)
    r = random.Random(paired * 10 + max_bits)
    prints = set()
    for _ in range(6):
        center = r.getrandbits(64)
        prints |= {center ^ sum(1 << b for b in r.sample(range(64), r.randint(0, 3))) for _ in range(15)}
    step = r.getrandbits(64)
    for n in range(12):
        prints.add(step)
        step ^= sum(1 << b for b in r.sample(range(64), max_bits or 1))
    prints = sorted(prints | {0, (1 << 64) - 1, 1 << 63})
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    links = simhash.near_links(spark.createDataFrame([(p,) for p in signed], "simhash bigint"), max_bits)
    assert all(((a ^ b) & (2**64 - 1)).bit_count() <= max_bits for a, b in links.collect())
    roots = {row.node: row.root for row in connected_components(links).collect()}
    want = brute_components([(p, q) for p, q in zip(signed, prints, strict=True)], max_bits)
    assert [roots.get(p, p) for p in signed] == want


def test_components_of_a_long_chain_and_a_star(spark):
    chain = [(n, n + 1) for n in range(60)] + [(1000, 1000 + n) for n in range(1, 100)] + [(5, 5), (None, 3), (2000, 1999)]
    links = spark.createDataFrame(chain, "a bigint, b bigint")
    roots = {r.node: r.root for r in connected_components(links).collect()}
    assert roots == {n: 0 for n in range(61)} | {1000 + n: 1000 for n in range(100)} | {1999: 1999, 2000: 1999}
    assert connected_components(links.limit(0)).count() == 0


def test_keep_first(spark):
    docs = [(3, "a b c d"), (1, "A b c d"), (2, "other text here now"), (None, "a b c d"), (2, "other text here now")]
    kept = simhash.keep_first(spark.createDataFrame(docs, SCHEMA)).collect()
    assert sorted((tuple(r) for r in kept), key=repr) == sorted([docs[1], docs[2], docs[3], docs[4]], key=repr)
