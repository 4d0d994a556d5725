"""Chat formatting: tool calls linked with their results, in a topological order, checked against schemas, as canonical JSON."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidelake.session import staged

#: What Python types a JSON schema's type names.
_TYPES = {"string": str, "object": dict, "array": list, "boolean": bool, "null": type(None)}


def violations(value, schema: dict, at: str = "$") -> list[str]:
    """Where ``value`` breaks a JSON schema: type, enum, required, properties, additionalProperties, items, lengths and bounds."""
    kinds = schema.get("type")
    kinds = kinds if isinstance(kinds, list) or kinds is None else [kinds]

    def fits(kind: str) -> bool:
        if kind in ("integer", "number"):
            number = isinstance(value, (int, float)) and not isinstance(value, bool)
            return number and (kind == "number" or float(value).is_integer())
        return isinstance(value, _TYPES[kind])

    if kinds and not any(map(fits, kinds)):
        return [f"{at}: type"]
    found = [f"{at}: enum"] if "enum" in schema and value not in schema["enum"] else []
    if isinstance(value, dict):
        inner = schema.get("properties", {})
        found += [f"{at}.{name}: required" for name in sorted(set(schema.get("required", [])) - set(value))]
        for name in sorted(value):
            if name in inner:
                found += violations(value[name], inner[name], f"{at}.{name}")
            elif schema.get("additionalProperties") is False:
                found.append(f"{at}.{name}: additional")
    elif isinstance(value, list):
        for n, item in enumerate(value):
            found += violations(item, schema.get("items", {}), f"{at}[{n}]")
    sized = len(value) if isinstance(value, (str, list)) else value if isinstance(value, (int, float)) and not isinstance(value, bool) else None
    names = {str: ("minLength", "maxLength"), list: ("minItems", "maxItems")}.get(type(value), ("minimum", "maximum"))
    if sized is not None:
        found += [f"{at}: {names[0]}"] * (sized < schema.get(names[0], sized)) + [f"{at}: {names[1]}"] * (sized > schema.get(names[1], sized))
    return found


def canonical(value) -> str:
    """JSON with sorted keys, no blanks, and characters as they are."""
    return json.dumps(value, ensure_ascii=False, sort_keys=True, separators=(",", ":"), allow_nan=False)


def _strict(text: str):
    def refuse(name: str):
        raise ValueError(name)

    return json.loads(text, parse_constant=refuse)


STEPS = "conv_id long, turn long, kind string, call_id string, status string, major long, minor long, errors array<string>, json string"


def _formatted(schemas: dict[str, dict]):
    def step(row: dict) -> tuple[list[str], str]:
        errors, body = [], {"kind": row["kind"]}
        if row["kind"] == "message":
            body |= {"content": row["content"], "role": row["role"]}
        elif row["kind"] == "result":
            body |= {"call_id": row["call_id"], "content": row["content"], "name": row["call_name"]}
        else:
            try:
                arguments = _strict(row["arguments"])
            except (TypeError, ValueError, RecursionError):
                arguments, errors = None, ["$: not JSON"]
            if row["name"] not in schemas:
                errors = [*errors, "$: unknown tool"]
            elif not errors:
                errors = violations(arguments, schemas[row["name"]])
            # What isn't JSON stays readable, as a string.
            body |= {"arguments": row["arguments"] if errors[:1] == ["$: not JSON"] else arguments, "call_id": row["call_id"], "name": row["name"]}
        return errors, canonical(body)

    def formatted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [step(r) for r in batch.select(["kind", "role", "content", "call_id", "call_name", "name", "arguments"]).to_pylist()]
            kept = [batch.column(c) for c in ("conv_id", "turn", "kind", "call_id", "status", "major", "minor")]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array([m[0] for m in made], pa.list_(pa.string())), pa.array([m[1] for m in made], pa.string())],
                names=[f.split()[0] for f in STEPS.split(", ")],
            )

    return formatted


def _then(a: Column, c: Column, k: Column, b: Column, d: Column) -> tuple[Column, Column]:
    """Least place and its step of a way that goes on by another one, of ``k`` steps, whose least place is ``b`` with step ``d``."""
    return F.greatest(a, b), F.when(a > b, c + k).when(a == b, F.greatest(c + k, d)).otherwise(d)


def _ordered(pairs: DataFrame, needs: DataFrame) -> DataFrame:
    """``conv_id, call_id, major, minor, cyclic`` of the calls that have to wait, or can't be ordered: the others keep their turn.

    A call comes no sooner than the results it needs: its place is the largest of its own turn and, for each need, the place of the result's turn or
    of the call that it waits with, a step later. A need thus turns the needed call's place into one of the call: places before ``least`` into
    ``(least, step)``, later ones ``k`` steps on. Two such ways in a row are one of the same kind, which is what rounds make use of. Each round settles the calls
    all of whose needs are settled, and lets every need of a call with a single open need lead to what that one needs. So chains and trees of needs take a
    logarithmic number of rounds. A round that settles nothing leaves calls that need their own results, and those that need such a call.

    Conversations in which every result stands before the calls that need it cost one look. Calls and needs are joined by conversation and identifier; none is gathered.
    """
    edges = needs.join(pairs.select("conv_id", F.col("call_id").alias("needed"), F.greatest("call_turn", "result_turn").alias("ready")), ["conv_id", "needed"])
    edges = edges.join(pairs.select("conv_id", "call_id", "call_turn"), ["conv_id", "call_id"])
    edges = staged(edges.select("conv_id", "call_id", "needed", "call_turn", "ready"), "tool-edges")
    late = edges.filter("ready >= call_turn").select("conv_id").distinct()
    edges = staged(edges.join(late, "conv_id", "left_semi"), "tool-late-edges")
    one = ["conv_id", "call_id"]
    held = edges.select(*one, F.col("call_turn").alias("major"), F.lit(0).cast("long").alias("minor")).distinct()
    calls = pairs.join(edges.select("conv_id", F.col("needed").alias("call_id")).distinct(), one, "left_semi")
    fresh = calls.join(held, one, "left_anti").select(*one, F.col("call_turn").alias("major"), F.lit(0).cast("long").alias("minor"))
    ways = edges.select(*one, "needed", F.greatest("ready", "call_turn").alias("least"), (F.col("ready") >= F.col("call_turn")).cast("long").alias("step"), F.lit(1).cast("long").alias("k"))
    held, fresh, ways, settled = staged(held, "tool-held"), staged(fresh, "tool-fresh"), staged(ways, "tool-ways"), []
    while True:
        came = fresh.select("conv_id", F.col("call_id").alias("needed"), "major", "minor")
        major, minor = _then(F.col("major"), F.col("minor"), F.col("k"), F.col("least"), F.col("step"))
        places = ways.join(came, ["conv_id", "needed"]).select(*one, major.alias("major"), minor.alias("minor"))
        held = held.unionByName(places).groupBy(*one).agg(F.max(F.struct("major", "minor")).alias("place")).select(*one, "place.*")
        ways = staged(ways.join(came, ["conv_id", "needed"], "left_anti"), "tool-ways")
        held = staged(held, "tool-held")
        fresh = staged(held.join(ways, one, "left_anti"), "tool-fresh")
        if not fresh.take(1):
            break
        settled.append(fresh)
        held = held.join(fresh, one, "left_anti")
        # Of a call with one open need: the way to it, no sooner than what the call waits for already.
        only = ways.groupBy(*one).agg(F.count("*").alias("n"), *[F.first(c).alias(c) for c in ("needed", "least", "step", "k")]).filter("n = 1").join(held, one)
        least, step = _then(F.col("least"), F.col("step"), F.lit(0), F.col("major"), F.col("minor"))
        only = only.select("conv_id", F.col("call_id").alias("by"), F.col("needed").alias("beyond"), least.alias("least_1"), step.alias("step_1"), F.col("k").alias("k_1"))
        on = (F.col("needed") == F.col("by")) & (F.col("conv_id") == F.col("of_conv"))
        least, step = _then(F.col("least_1"), F.col("step_1"), F.col("k"), F.col("least"), F.col("step"))
        met = ways.join(only.withColumnRenamed("conv_id", "of_conv"), on, "left")
        is_met = F.col("by").isNotNull()
        ways = met.select(
            *one,
            F.coalesce("beyond", "needed").alias("needed"),
            F.when(is_met, least).otherwise(F.col("least")).alias("least"),
            F.when(is_met, step).otherwise(F.col("step")).alias("step"),
            F.when(is_met, F.col("k") + F.col("k_1")).otherwise(F.col("k")).alias("k"),
        )
        ways = staged(ways, "tool-ways")
    order = held.withColumn("cyclic", F.lit(True))
    for places in settled:
        order = order.unionByName(places.withColumn("cyclic", F.lit(False)))
    turns = pairs.select(*one, "call_turn")
    return order.join(turns, one).filter("cyclic OR major > call_turn OR minor > 0").drop("call_turn")


def format_chat(steps: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """One row of ``STEPS`` for every row of ``steps``.

    ``steps`` has ``conv_id, turn, kind`` (message, call or result), ``role, content`` of messages and results, ``call_id``, and of calls ``name``,
    ``arguments`` (JSON text) and ``needs`` (ids of calls of the conversation whose results they use). Calls and results are joined by conversation and identifier. ``status``:

    - message: not a step of a tool. linked: a call with a result, and that result.
    - unanswered: a call without a result. orphan: a result without a call, or any without an identifier.
    - duplicate: a second call, or a second result, of an identifier; the first by turn, then name or content, is taken.
    - cyclic: a call that needs its own result, over any number of steps, or needs such a call's; and its result.

    Ordered by ``(major, minor, kind, turn)``, every call precedes its result and follows the results it needs. Others stand at their turn. A
    null turn comes first; needs of calls that don't exist are ignored. ``errors`` lists where the arguments break
    their tool's schema; ``json`` is the step with sorted keys. No conversation is gathered in a task, however long it is.
    """
    rows = steps.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.coalesce(F.col("turn").cast("long"), F.lit(-1)).alias("at"),
        F.col("turn").cast("long").alias("turn"),
        *["kind", "role", "content", "call_id", "name", "arguments", "needs"],
    )
    tools = rows.filter("kind IN ('call', 'result') AND conv_id IS NOT NULL AND call_id IS NOT NULL")
    first_call = F.min(F.when(F.col("kind") == "call", F.struct("at", "name", "arguments", "needs"))).alias("call")
    first_result = F.min(F.when(F.col("kind") == "result", F.struct("at", "content"))).alias("result")
    pairs = staged(tools.groupBy("conv_id", "call_id").agg(first_call, first_result), "tool-pairs")
    places = pairs.filter("call IS NOT NULL").select("conv_id", "call_id", F.col("call.at").alias("call_turn"), F.col("result.at").alias("result_turn"))
    needs = pairs.select("conv_id", "call_id", F.explode("call.needs").alias("needed")).filter("needed IS NOT NULL").distinct()
    order = _ordered(places, needs)
    linked = pairs.join(order, ["conv_id", "call_id"], "left").select(
        F.col("conv_id").alias("of_conv"), F.col("call_id").alias("of_call"), "call", "result", "major", "minor", F.coalesce("cyclic", F.lit(False)).alias("cyclic")
    )
    joined = rows.join(linked, (F.col("conv_id") == F.col("of_conv")) & (F.col("call_id") == F.col("of_call")) & (F.col("kind") != "message"), "left")
    is_call, is_result = F.col("kind") == "call", F.col("kind") == "result"
    own = F.when(is_call, F.struct("at", "name", "arguments", "needs").eqNullSafe(F.col("call")))
    own = own.when(is_result, F.struct("at", "content").eqNullSafe(F.col("result")))
    status = (
        F.when(F.col("kind") == "message", "message")
        .when(F.col("of_call").isNull() | F.col("call").isNull(), "orphan")
        .when(~own, "duplicate")
        .when(F.col("cyclic"), "cyclic")
        .when(F.col("result").isNull(), "unanswered")
        .otherwise("linked")
    )
    placed = joined.withColumn("status", status)
    waits = F.col("status").isin("linked", "unanswered") & F.col("major").isNotNull()
    # A result stands no sooner than its call, whose kind sorts before its own.
    call_major = F.when(waits, F.col("major")).otherwise(F.when(F.col("status") == "linked", F.col("call.at")).otherwise(F.col("at")))
    call_minor = F.when(waits, F.col("minor")).otherwise(F.lit(0).cast("long"))
    major = F.when(is_result, F.greatest("at", call_major)).otherwise(call_major)
    minor = F.when(is_result & (F.col("at") > call_major), F.lit(0).cast("long")).otherwise(call_minor)
    ready = placed.select(
        *["conv_id", "turn", "kind", "role", "content", "call_id", F.col("call.name").alias("call_name"), "name", "arguments", "status"],
        major.alias("major"),
        minor.alias("minor"),
    )
    return ready.mapInArrow(_formatted(schemas), STEPS)
