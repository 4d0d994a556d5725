"""Secret scans: single credentials by pattern, multipart ones by linking their parts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidelake.llm.common import numbered, whole
from tidelake.session import staged

#: Kind, pattern, group whose length counts (0: the whole match), fewest characters.
BASE = (
    ("assign", r"""(?i:(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))""", 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    # Runs are maximal, so those of 24 and more are the same with the bound inside.
    ("hex", r"[0-9a-f]{24,}", 0, 24),
)
#: Weak candidates: too common to report alone.
WEAK = (
    ("id_part", r"""(?i:(?:client|account|tenant|user|access|key)_?id["']?\x20*[:=]\x20*["']?([A-Za-z0-9_.-]{4,}))""", 1, 4),
    ("secret_part", r"[A-Za-z0-9+/]{32,}={0,2}", 0, 32),
    ("endpoint", r"""https?://[^\x20\x09-\x0D"'<>]{4,}""", 0, 12),
)
#: What a match holds one of, in lower case: texts without any need no pattern. Kinds without an entry have no such words.
HINTS = {
    "assign": ("password", "passwd", "secret", "token", "apikey", "api_key"),
    "access": ("akia",),
    "id_part": ("client", "account", "tenant", "user", "access", "key"),
    "endpoint": ("://",),
}
KINDS = [kind for kind, *_ in (*BASE, *WEAK)]
#: What a span is a part of.
ROLE = {"assign": "secret", "hex": "secret", "secret_part": "secret", "access": "id", "id_part": "id", "endpoint": "endpoint"}
#: Code points between complementary parts of one credential, and the side of the cells in which they are joined.
REACH = 256


def _hinted(kind: str, low: Column) -> Column:
    """Whether a text, given in lower case, can have a match."""
    hint = F.lit(kind not in HINTS)
    for words in HINTS.get(kind, ()):
        hint = hint | F.contains(low, F.lit(words))
    return hint


def _occurrences(kind: str, pattern: str, group: int, least: int) -> Column:
    """The matches in ``text`` and what stands before each, whether or not they are long enough; ``low`` is the text in lower case."""
    matches = F.regexp_extract_all("text", F.lit(pattern), F.lit(0))
    found = F.when(_hinted(kind, F.col("low")), matches).otherwise(F.array().cast("array<string>"))

    def match(m: Column, i: Column, gaps: Column) -> Column:
        ok = F.length(F.regexp_extract(m, pattern, group)) >= least
        if kind == "secret_part":
            ok = ok & m.rlike("[A-Z]") & m.rlike("[a-z]") & m.rlike("[0-9]")
        return F.struct(
            F.lit(KINDS.index(kind)).alias("kind"),
            i.alias("nth"),
            F.length(F.get(gaps, i)).alias("gap"),
            F.length(m).alias("size"),
            ok.alias("ok"),
        )

    # A lambda's argument is computed once, where an expression is again at each mention.
    def with_gaps(f: Column) -> Column:
        return F.struct(f.alias("found"), F.when(F.size(f) > 0, F.split("text", pattern, -1)).alias("gaps"))

    both = F.transform(F.array(found), with_gaps)
    return F.flatten(F.transform(both, lambda p: F.transform(p["found"], lambda m, i: match(m, i, p["gaps"]))))


def _parts(matches: DataFrame) -> DataFrame:
    """``row, kind, start, end, strong``: every match that is long enough; ``kind`` numbers ``KINDS``.

    Gaps and matches of one pattern alternate, so their lengths add up to places.
    """
    each = matches.filter("match IS NOT NULL").select("row", "match.*")
    each = each.withColumn(
        "end", F.expr("sum(gap + size) OVER (PARTITION BY row, kind ORDER BY nth ROWS UNBOUNDED PRECEDING)").cast("int")
    )
    strong = F.col("kind") < len(BASE)
    return each.filter("ok").select("row", "kind", (F.col("end") - F.col("size")).alias("start"), "end", strong.alias("strong"))


def _linked(parts: DataFrame, reach: int) -> DataFrame:
    """The weak candidates that complementary parts stand beside.

    One counts if, within ``reach`` code points of the same text, there is a strong part of another role, or weak parts
    of both other roles, or, of an identifier and a secret, the other one: an endpoint may be missing. An interval join on cells of ``reach`` code points: a cell holds one row for each role and
    strength, with the first start and last end in it, so parts are met without listing pairs.
    """
    role = F.element_at(F.array(*[F.lit(ROLE[k]) for k in KINDS]), F.col("kind") + 1)
    parts = parts.withColumn("role", role)

    def cells(start: Column, end: Column) -> Column:
        return F.explode(F.sequence(F.floor(start / reach).cast("int"), F.floor(end / reach).cast("int")))

    near = (
        parts.select("row", "role", "strong", "start", "end", cells(F.col("start"), F.col("end")).alias("cell"))
        .groupBy("row", "cell", "role", "strong")
        .agg(F.min("start").alias("first"), F.max("end").alias("last"))
        .withColumnsRenamed({"role": "near_role", "strong": "near_strong"})
    )
    low, high = F.greatest(F.col("start") - reach, F.lit(0)), F.col("end") + reach
    weak = parts.filter("NOT strong").select("row", "kind", "start", "end", "role", cells(low, high).alias("cell"))
    met = weak.join(near, ["row", "cell"]).filter(
        (F.col("role") != F.col("near_role")) & (F.col("first") <= high) & (F.col("last") >= F.col("start") - reach)
    )
    couple = (F.col("role") != "endpoint") & (F.col("near_role") != "endpoint")
    beside = met.groupBy("row", "kind", "start", "end").agg(
        F.max("near_strong").alias("any_strong"), F.count_distinct("near_role").alias("roles"), F.max(couple).alias("couple")
    )
    return beside.filter("any_strong OR roles = 2 OR couple").select("row", "kind", "start", "end")


def find_secrets(docs: DataFrame, reach: int = REACH) -> DataFrame:
    """``doc_id, text_key, spans`` for every row of ``docs``; spans are ``(start, kind, end)``, by start, then kind.

    ``start`` and ``end`` (exclusive) count code points of the whole text, ``kind`` numbers ``KINDS``. Base kinds are the leftmost
    matches of each pattern that do not overlap, without those that are too short. The weak kinds are in it only
    where other parts of a credential stand near: a base kind of another role, parts of both other roles, or an identifier and
    a secret without an endpoint. ``text_key`` is the text's md5. A null or empty text has no spans; rows
    repeated or without an id are rows of their own; other columns are ignored. Texts are read once and not shuffled.
    """
    rows = docs.select("doc_id", F.monotonically_increasing_id().alias("row"), whole("text").alias("text")).withColumn("low", F.lower("text"))
    nothing = F.lit(None).cast("struct<kind:int,nth:int,gap:int,size:int,ok:boolean>")
    # The null in front keeps a row for each text, so that no outer row is ever made: it is the outer form because Spark puts a filter
    # before the inner one, which would scan the texts twice. Written once, so that row numbers stay.
    every = F.concat(F.array(nothing), *[_occurrences(*k) for k in (*BASE, *WEAK)])
    matches = rows.select("doc_id", "row", F.md5("text").alias("text_key"), every.alias("matches"))
    matches = staged(matches.select("doc_id", "row", "text_key", F.explode_outer("matches").alias("match")), "secret-matches")
    parts = _parts(matches)
    spans = parts.filter("strong").select("row", "kind", "start", "end").union(_linked(parts, reach))
    span = F.struct("start", "kind", "end").alias("span")
    texts = matches.filter("match IS NULL").select("row", "doc_id", "text_key", F.lit(None).cast("struct<start:int,kind:int,end:int>").alias("span"))
    both = texts.union(spans.select("row", F.lit(None).alias("doc_id"), F.lit(None).alias("text_key"), span))
    ids = [F.first(c, ignorenulls=True).alias(c) for c in ("doc_id", "text_key")]
    # A null span is not collected; a text's own matches bound the list.
    return both.groupBy("row").agg(*ids, F.array_sort(F.collect_list("span")).alias("spans")).drop("row")


def listed(spans: Column) -> Column:
    """``kind:start:end`` of spans, comma-joined."""
    name = lambda s: F.element_at(F.array(*[F.lit(k) for k in KINDS]), s["kind"] + 1)
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", name(s), s["start"], s["end"])), ",")


def redact(docs: DataFrame, reach: int = REACH, mark: str = "[secret]") -> DataFrame:
    """``docs`` with every span of its texts replaced by ``mark``; overlapping spans are one.

    Texts without spans, null ones included, stay as they are, and so do all other columns, whatever their names; ``n_chars``, where there is such
    a column, follows the texts in which some pattern matches. Repeated rows and null ids are rows of their own; without rows there are none.
    Only the rows in which some pattern matches are written, with a number, and meet their spans by it; copies of a text do not meet in
    one task.
    """
    maybe = F.lit(False)
    for kind, pattern, *_ in (*BASE, *WEAK):
        maybe = maybe | (_hinted(kind, F.lower(whole("text"))) & whole("text").rlike(pattern))
    clean, held = docs.filter(~maybe), numbered(docs.filter(maybe), "secret-rows")
    spans = find_secrets(held.select(F.col("row").alias("doc_id"), "own.text"), reach).filter(F.size("spans") > 0)
    joined = held.join(spans.select(F.col("doc_id").alias("row"), "spans"), "row", "left")
    text = F.col("own.text")
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def step(acc: Column, span: Column) -> Column:
        before = F.substring(text, acc["at"] + 1, F.greatest(span["start"] - acc["at"], F.lit(0)))
        marked = F.concat(acc["out"], before, F.when(span["start"] < acc["at"], "").otherwise(mark))
        return F.struct(marked.alias("out"), F.greatest(acc["at"], span["end"]).alias("at"))

    def finish(acc: Column) -> Column:
        return F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text)))

    new = F.when(F.col("spans").isNull(), text).otherwise(F.aggregate("spans", start, step, finish))
    changed = joined.select("own", new.alias("new"))
    follows = {"text": F.col("new")}
    if "n_chars" in docs.columns:
        follows["n_chars"] = F.length("new").cast(docs.schema["n_chars"].dataType)
    return clean.union(changed.select(*[follows.get(c, F.col(f"own.`{c}`")).alias(c) for c in docs.columns]))
