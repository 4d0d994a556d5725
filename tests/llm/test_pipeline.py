"""The pipeline's stages, each against a plain version of its decision."""

import pytest
from test_decontaminate import brute as brute_hits
from test_secrets import brute as brute_secrets
from test_simhash import brute_components, brute_print

import corpus_pipeline
from tidelake.llm import quality, secrets

DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def kept(spark, tmp_path_factory):
    docs, result = spark.read.parquet(f"{DIR}/documents.parquet"), {"documents": None}
    result["documents"] = docs.collect()
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp(name) / "out")
        stage(spark, docs, DIR).write.parquet(path)
        docs = spark.read.parquet(path)
        result[name] = docs.collect()
    return result


def ids(rows):
    return sorted(r.doc_id for r in rows)


def test_quality(spark, kept):
    docs, labels = (spark.read.parquet(f"{DIR}/{t}.parquet") for t in ("documents", "labels"))
    good = quality.score(docs, quality.train(docs, labels)).filter("score >= 0.7")
    assert ids(kept["quality_classifier"]) == ids(good.collect())
    assert kept["quality_classifier"][0].__fields__ == kept["documents"][0].__fields__


def test_near_dedup(kept):
    rows = kept["quality_classifier"]
    roots = brute_components([(r.doc_id, brute_print(r.text)) for r in rows], 2)
    assert ids(kept["simhash_near_dedup"]) == sorted(set(roots))


def test_decontamination(spark, kept):
    rows = kept["simhash_near_dedup"]
    benchmark = [tuple(r) for r in spark.read.parquet(f"{DIR}/benchmark.parquet").select("item_id", "text").collect()]
    hits = brute_hits([(r.doc_id, r.text) for r in rows], benchmark, 13)
    assert ids(kept["benchmark_decontamination"]) == sorted(d for d, n, hit, *_ in hits if not (hit > 0 and 20 * hit >= n))


def test_secrets(kept):
    want = []
    for r in kept["benchmark_decontamination"]:
        out, at = "", 0
        for start, _, end in brute_secrets(r.text, secrets.REACH):
            out += r.text[at:start] + "[secret]" if start >= at else ""
            at = max(at, end)
        want.append((r.doc_id, out + r.text[at:], r.lang, r.source, len(out + r.text[at:])))
    assert sorted(tuple(r) for r in kept["secret_scans"]) == sorted(want)


def test_mixing(kept):
    rows = kept["mixing_to_target_weights"]
    sizes = {}
    for r in kept["secret_scans"]:
        sizes.setdefault(r.source, {})[r.doc_id] = len(r.text.split())
    assert all(r.doc_id in sizes[r.source] for r in rows) and all(0 < r.taken <= 3 * r.size for r in rows if r.size)
    for source in {r.source for r in rows}:
        mine = [r for r in rows if r.source == source]
        assert abs(sum(r.taken for r in mine) - mine[0].target) <= max(sizes[source].values()) / 2
