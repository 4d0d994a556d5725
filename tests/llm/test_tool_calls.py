"""Tool calls against a plain linking, order by checking every need, canonical JSON by a round trip."""

import json
import random

import pytest

from tidelake.llm import tool_calls

SCHEMA = "conv_id bigint, turn bigint, kind string, role string, content string, call_id string, name string, arguments string, needs array<string>, major string, of_call int"
TOOLS = {
    "find": {
        "type": "object",
        "required": ["q"],
        "additionalProperties": False,
        "properties": {"q": {"type": "string", "minLength": 1}, "n": {"type": "integer", "minimum": 0, "maximum": 9}, "tags": {"type": "array", "maxItems": 2, "items": {"enum": ["a", "b"]}}},
    }
}


def call(conv, turn, call_id, needs=None, arguments='{"q": "x"}', name="find"):
    return (conv, turn, "call", "assistant", None, call_id, name, arguments, needs, "x", 1)


def result(conv, turn, call_id, content="r"):
    return (conv, turn, "result", "tool", content, call_id, None, None, None, "x", 1)


def message(conv, turn, content="hi"):
    return (conv, turn, "message", "user", content, None, None, None, None, "x", 1)


def formatted(spark, steps):
    return tool_calls.format_chat(spark.createDataFrame(steps, SCHEMA), TOOLS).collect()


def keyed(rows):
    return {(r.conv_id, r.kind, r.call_id): r for r in rows}


@pytest.mark.parametrize(
    ("arguments", "errors"),
    [
        ('{"q": "x"}', []),
        ('{"n": 10}', ["$.q: required", "$.n: maximum"]),
        ('{"q": "", "n": 1.5, "z": 0}', ["$.n: type", "$.q: minLength", "$.z: additional"]),
        ('{"q": "x", "n": 2.0, "tags": ["a", "c", "b"]}', ["$.tags[1]: enum", "$.tags: maxItems"]),
        ('{"q": true, "n": true}', ["$.n: type", "$.q: type"]),
        ("[1]", ["$: type"]),
        ("{broken", ["$: not JSON"]),
        ('{"q": NaN}', ["$: not JSON"]),
        (None, ["$: not JSON"]),
    ],
)
def test_validation(arguments, errors):
    ((_, made),) = [(r["kind"], r) for r in _batch([{"kind": "call", "role": None, "content": None, "call_id": "c", "call_name": None, "name": "find", "arguments": arguments}])]
    assert made["errors"] == errors
    body = json.loads(made["json"])
    assert made["json"] == json.dumps(body, sort_keys=True, separators=(",", ":"), ensure_ascii=False)
    if errors != ["$: not JSON"]:
        assert body["arguments"] == json.loads(arguments)


def _batch(rows):
    import pyarrow as pa

    full = [{"conv_id": 1, "turn": 1, "status": "linked", "major": 1, "minor": 0} | r for r in rows]
    types = {"conv_id": pa.int64(), "turn": pa.int64(), "major": pa.int64(), "minor": pa.int64()}
    names = ["conv_id", "turn", "kind", "role", "content", "call_id", "call_name", "name", "arguments", "status", "major", "minor"]
    schema = pa.schema([(n, types.get(n, pa.string())) for n in names])
    return next(iter(tool_calls._formatted(TOOLS)([pa.RecordBatch.from_pylist(full, schema)]))).to_pylist()


def test_statuses(spark):
    rows = formatted(
        spark,
        [
            message(1, 0), call(1, 1, "a"), result(1, 2, "a"), call(1, 3, "b"), result(1, 4, "zzz"), result(1, 5, None), call(1, 6, None),
            call(1, 7, "a"), result(1, 8, "a", "again"), result(2, 1, "a"), message(None, None, None), call(None, 1, "a"), call(3, None, "n"), result(3, 1, "n"),
            call(4, 1, "x", name="unknown"), call(4, 1, "x", name="unknown"),
        ],
    )
    status = sorted((r.conv_id or 0, r.turn if r.turn is not None else -1, r.kind, r.status) for r in rows)
    assert status == sorted(
        [
            (1, 0, "message", "message"), (1, 1, "call", "linked"), (1, 2, "result", "linked"), (1, 3, "call", "unanswered"), (1, 4, "result", "orphan"),
            (1, 5, "result", "orphan"), (1, 6, "call", "orphan"), (1, 7, "call", "duplicate"), (1, 8, "result", "duplicate"), (2, 1, "result", "orphan"),
            (0, -1, "message", "message"), (0, 1, "call", "orphan"), (3, -1, "call", "linked"), (3, 1, "result", "linked"),
            (4, 1, "call", "unanswered"), (4, 1, "call", "unanswered"),
        ]
    )
    found = keyed(rows)
    assert json.loads(found[1, "result", "a"].json)["name"] == "find"
    assert found[4, "call", "x"].errors == ["$: unknown tool"]


@pytest.mark.parametrize("seed", range(3))
def test_order(spark, seed):
    """Turns at random, so that many calls stand before what they need; some needs go round in circles."""
    r = random.Random(seed)
    steps, needs = [], {}
    for conv in range(12):
        ids = [f"{conv}-{n}" for n in range(r.randint(1, 8))]
        for k, name in enumerate(ids):
            pool = ids if conv % 4 == 3 else ids[:k]
            needs[conv, name] = [x for x in dict.fromkeys(r.choices(pool, k=r.randint(0, 2)) if pool else [])]
            steps.append(call(conv, r.randint(0, 6), name, [*needs[conv, name], "missing", None]))
            if r.random() < 0.9:
                steps.append(result(conv, r.randint(0, 6), name))
    r.shuffle(steps)
    found = keyed(formatted(spark, steps))
    place = {k: (v.major, v.minor, v.kind, v.turn) for k, v in found.items()}
    cyclic = set()

    def behind(conv, name, path):
        return name in path or any(behind(conv, n, [*path, name]) for n in needs[conv, name] if (conv, n) in needs)

    for (conv, name), wanted in needs.items():
        # A need counts once its result exists; without one nothing is waited for but the call.
        if behind(conv, name, []):
            cyclic.add((conv, name))
            continue
        mine = place[conv, "call", name]
        if (conv, "result", name) in place:
            assert mine < place[conv, "result", name]
        for w in wanted:
            if (conv, "result", w) in place:
                assert place[conv, "result", w] < mine
    flagged = {(c, i) for (c, kind, i), row in found.items() if kind == "call" and row.status == "cyclic"}
    assert flagged == cyclic and all(conv % 4 == 3 for conv, _ in flagged)


def test_cycles(spark):
    steps = [call(1, 1, "a", ["b"]), result(1, 2, "a"), call(1, 3, "b", ["a"]), result(1, 4, "b"), call(1, 5, "c", ["c"]), result(1, 6, "c"), call(1, 7, "d"), result(1, 8, "d"), call(1, 9, "e", ["b"])]
    got = {k[2]: v.status for k, v in keyed(formatted(spark, steps)).items() if k[1] == "call"}
    # The last one needs a call that can't be ordered.
    assert got == {"a": "cyclic", "b": "cyclic", "c": "cyclic", "d": "linked", "e": "cyclic"}


def test_ten_thousand_needs_and_a_cycle(spark, monkeypatch):
    """A chain backwards, a tree, and a cycle with a tail, in a number of rounds that follows the logarithm."""
    written, real = [], tool_calls.staged
    monkeypatch.setattr(tool_calls, "staged", lambda df, name: written.append(name) or real(df, name))
    n = 5000
    steps = [call(1, 2 * k, f"c{k}", [f"c{k + 1}"]) for k in range(n)] + [result(1, 2 * k + 1, f"c{k}") for k in range(n)]
    steps += [call(2, 2 * k, f"t{k}", [f"t{2 * k + 1}", f"t{2 * k + 2}"]) for k in range(n // 2)]
    steps += [call(3, 2 * k, f"r{k}", [f"r{(k + 1) if k < n // 2 - 1 else k - 1}"]) for k in range(n // 2)]
    found = keyed(formatted(spark, steps))
    last = 2 * n - 1
    assert [(found[1, "call", f"c{k}"].major, found[1, "call", f"c{k}"].minor) for k in range(n)] == [(last, n - 1 - k) if k < n - 1 else (last - 1, 0) for k in range(n)]
    assert {found[3, "call", f"r{k}"].status for k in range(n // 2)} == {"cyclic"}
    for k in range(n // 2):
        mine = found[2, "call", f"t{k}"]
        assert all((found[2, "call", f"t{m}"].major, found[2, "call", f"t{m}"].minor) < (mine.major, mine.minor) for m in (2 * k + 1, 2 * k + 2) if m < n // 2)
    assert written.count("tool-held") <= 18


def test_empty(spark):
    assert formatted(spark, []) == []
