"""Secret scans against brute force."""

import random
import re

import corpus_pipeline
from tidelake.llm import secrets


def brute_parts(text):
    parts = []
    for n, (kind, pattern, group, least) in enumerate((*secrets.BASE, *secrets.WEAK)):
        # Fixed as the contract words it: any run, then those that are too short go.
        for m in re.finditer({"hex": "[0-9a-f]+"}.get(kind, pattern), text or ""):
            mixed = kind != "secret_part" or all(re.search(p, m[0]) for p in ("[A-Z]", "[a-z]", "[0-9]"))
            if len(m[group]) >= least and mixed:
                parts.append((m.start(), n, m.end()))
    return parts


def brute(text, reach):
    parts = brute_parts(text)
    role = [secrets.ROLE[k] for k in secrets.KINDS]
    spans = [p for p in parts if p[1] < len(secrets.BASE)]
    for w in parts:
        if w[1] >= len(secrets.BASE):
            near = [p for p in parts if role[p[1]] != role[w[1]] and p[0] <= w[2] + reach and p[2] >= w[0] - reach]
            couple = role[w[1]] != "endpoint" and any(role[p[1]] != "endpoint" for p in near)
            if any(p[1] < len(secrets.BASE) for p in near) or len({role[p[1]] for p in near}) == 2 or couple:
                spans.append(w)
    return sorted(spans)


PIECES = [
    "password=hunter22", "Token: 'abc'", "token=token: abcdef", "api_key => x", 'API-KEY', 'apikey = "Zz9/+=.-_q"', "passwd:short",
    "AKIA" + "Q7" * 8, "AKIAAKIA12", "AKIA" + "Z" * 40, "deadbeef" * 3, "0123456789abcdef" * 2, "abc0",
    "client_id: acme-77", "user_id=bob1", "aB3" * 12, "Q" * 40, "https://api.example.org/v1?x=1", "http://x", "éé", "\U0001f600", "word", "a",
]


def random_docs(seed, n):
    r = random.Random(seed)
    fill = lambda: r.choice([" ", "\n", "é ", " plain words here and there "]) * r.randint(1, 12)
    docs = [(i, "".join(r.choice(PIECES) + fill() for _ in range(r.randint(0, 14)))) for i in range(n)]
    return docs + [(900, None), (901, ""), (902, "none here"), (1, "password=abcdefg"), (1, "password=abcdefg"), (None, "token:abcdefg")]


def test_spans(spark):
    for reach in (20, 256):
        docs = random_docs(reach, 120)
        got = secrets.find_secrets(spark.createDataFrame(docs, "doc_id bigint, text string"), reach).collect()
        want = sorted(((d, brute(t, reach)) for d, t in docs), key=repr)
        assert sorted(((r.doc_id, [tuple(s) for s in r.spans]) for r in got), key=repr) == want


def test_long_text_with_many_matches(spark):
    text = " ".join(f"password=abcdef{n} https://host{n}.org/path é" for n in range(4000))
    got = secrets.find_secrets(spark.createDataFrame([(1, text)], "doc_id bigint, text string")).collect()
    assert [tuple(s) for s in got[0].spans] == brute(text, secrets.REACH)


def test_redact(spark):
    docs = [(d, t, 5, "x", 1) for d, t in random_docs(3, 60)]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string, n_chars int, found_key string, row bigint")
    got = secrets.redact(frame)
    assert got.schema == frame.schema
    want = []
    for doc_id, text, *_ in docs:
        out, at = "", 0
        for start, _, end in brute(text, secrets.REACH):
            out += text[at:start] + "[secret]" if start >= at else ""
            at = max(at, end)
        new = text if text is None else out + text[at:]
        touched = bool(text) and any(re.search(p, text) for _, p, *_ in (*secrets.BASE, *secrets.WEAK))
        want.append((doc_id, new, len(new) if touched else 5, "x", 1))
    assert sorted((tuple(r) for r in got.collect()), key=repr) == sorted(want, key=repr)


def test_redact_keeps_clashing_columns_and_copies(spark):
    names = "doc_id bigint, text string, found_spans string, row int, own int, spans int, maybe int, `a.b` int"
    docs = [(1, "password=abcdefg", "f", 2, 3, 4, 5, 6)] * 3 + [(None, None, "f", 2, 3, 4, 5, 6), (2, "", None, None, 3, 4, 5, 6)]
    frame = spark.createDataFrame(docs, names)
    got = secrets.redact(frame)
    assert got.schema == frame.schema
    want = [(d, "[secret]" if t else t, *rest) for d, t, *rest in docs]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


def test_empty_table(spark):
    frame = spark.createDataFrame([], "doc_id bigint, text string")
    assert secrets.find_secrets(frame).count() == 0
    assert secrets.redact(frame).count() == 0


KEY = "wJalrXUtnFEMI/K7MDENG/bPxRfiCYEXAMPLEKEY"
TWO_PART = [
    f"aws_access_key_id = ASIAQ7Q7Q7Q7Q7Q7Q7Q7\naws_secret_access_key = {KEY}",
    f"client_id: acme-77 and {KEY}",
    f"{KEY} {'x ' * 100}user_id=bob1",
]
ONE_PART = [f"client_id: acme-77 {'x ' * 200}{KEY}", f"only {KEY}", "user_id=bob1", f"{KEY} https://host.org/path", "user_id=bob1 at https://host.org/path"]


def test_credentials_of_two_parts(spark):
    """An identifier beside a secret, without an endpoint; neither alone, nor with an endpoint only, nor out of reach."""
    docs = spark.createDataFrame(list(enumerate(TWO_PART + ONE_PART)), "doc_id bigint, text string")
    got = {r.doc_id: [tuple(s) for s in r.spans] for r in secrets.find_secrets(docs).collect()}
    assert got == {n: sorted(brute_parts(t)) if t in TWO_PART else [] for n, t in enumerate(TWO_PART + ONE_PART)}


def test_pipeline_redacts_credentials_of_two_parts(spark):
    docs = spark.createDataFrame(list(enumerate(TWO_PART + ONE_PART)), "doc_id bigint, text string")
    got = [r.text for r in corpus_pipeline.secret_scans(spark, docs, "").orderBy("doc_id").collect()]
    assert got[:2] == ["aws_access_[secret]\naws_secret_access_key = [secret]", "[secret] and [secret]"]
    assert got[2] == f"[secret] {'x ' * 100}[secret]" and got[3:] == ONE_PART
