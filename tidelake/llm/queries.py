"""The registered queries of this subpackage, each over whole tables, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

import corpus_pipeline
from tidelake.llm import decontaminate, editprint, lm, mixing, negatives, quality, secrets, simhash, token_files, token_index, tool_calls, toxicity, variants
from tidelake.llm.common import WORD, held_out
from tidelake.session import scratch_dir

#: The tokenizer's rank file, and an identifier that it leaves free.
RANKS, SEPARATOR = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken", 50256
#: The tokenizer of the token index, and the id that closes a document there.
TOKENIZER, END = public_tokenizers.path("byte_bpe_50k.json"), 2


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    mixed = mixing.mix(_documents(spark, sf_dir), mixing.quality_weights(labels))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


OP1_SQL = """
    WITH marks AS (SELECT doc_id, max(quality) AS mark FROM labels GROUP BY doc_id),
    sized AS (
        SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
            -ln((CAST(CAST('0x' || substr(md5('mix:' || doc_id), 1, 13) AS BIGINT) AS DOUBLE) + 0.5) / 4503599627370496.0)
                / CASE mark WHEN 1 THEN 2.0 WHEN 0 THEN 0.5 ELSE 1.0 END AS key
        FROM documents LEFT JOIN marks USING (doc_id)),
    sources AS (
        SELECT source, CAST(sum(size) AS BIGINT) AS source_size, 3 * sum(size) AS most,
            1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS share
        FROM sized GROUP BY source),
    -- Sources in the order in which a rising level reaches their bound; the level once those before are full.
    filled AS (
        SELECT *, (SELECT sum(source_size) FROM sources)
                - coalesce(sum(most) OVER (rising ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
            sum(share) OVER (rising ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights
        FROM sources WINDOW rising AS (ORDER BY most / share, source)),
    level AS (SELECT rest, weights FROM filled WHERE most * weights >= rest * share ORDER BY most / share, source LIMIT 1),
    targets AS (
        SELECT source, source_size, CASE WHEN most * weights < rest * share THEN CAST(most AS DOUBLE)
            ELSE CAST(rest AS DOUBLE) * share / CAST(weights AS DOUBLE) END AS target
        FROM sources, level),
    drawn AS (
        SELECT doc_id, size, source_size, target, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS epochs,
            sum(size) OVER (PARTITION BY sized.source ORDER BY key, doc_id, size ROWS UNBOUNDED PRECEDING) - size AS ahead
        FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source)
    SELECT doc_id, size, source_size, target, CAST(size * (epochs + CASE
            WHEN epochs < 3 AND target > epochs * source_size AND ahead + size / 2.0 <= target - epochs * source_size THEN 1
            ELSE 0 END) AS BIGINT) AS taken
    FROM drawn"""


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.score(docs, model).select(
        "doc_id", held_out("doc_id", 4).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted")
    )


def op3_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With ``bands_edited``: in how many bands of sampled places a text and its edited text meet as candidates."""
    found = editprint.fingerprints_with_next(_documents(spark, sf_dir))
    own, new = editprint.bands(F.col("fingerprint")), editprint.bands(F.col("edited_fingerprint"))
    return found.withColumn("bands_edited", F.size(F.array_intersect(own, new)))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document is written to flat token files, which are then scanned."""
    folder = scratch_dir(spark, "token-files")
    return token_files.document_token_counts(_documents(spark, sf_dir), folder, RANKS, SEPARATOR)


def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_documents(spark, sf_dir), shingle=3, max_bits=2)


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = decontaminate.find_hits(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), 13)
    return hits.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        decontaminate.contaminated(20).alias("contaminated"),
    )


def _prompt(longest: int) -> dict:
    prompt = {"type": "string", "minLength": 1, "maxLength": 400}
    words = {"type": "integer", "minimum": 1, "maximum": longest}
    return {"type": "object", "required": ["prompt", "words"], "additionalProperties": False, "properties": {"prompt": prompt, "words": words}}


#: Words of a call that says too little.
VAGUE = 20


def op6_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user's turn calls an assistant, with the text as argument; the assistant's turn is the result.

    A call needs the answer before. One of a few words says too little: it needs the answer of the next call instead, and that one
    not its own.
    """
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    is_call, is_result = F.col("role") == "user", F.col("role") == "assistant"
    words = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD))
    vague = is_call & (words < VAGUE)
    steps = turns.select(
        "conv_id",
        "turn",
        F.when(is_call, "call").when(is_result, "result").otherwise("message").alias("kind"),
        "role",
        F.col("text").alias("content"),
        F.when(is_call, F.concat_ws("-", "conv_id", "turn")).when(is_result, F.concat_ws("-", "conv_id", F.col("turn") - 1)).alias("call_id"),
        F.when(is_call, F.when(F.col("turn") < 2, "open").otherwise("follow")).alias("name"),
        F.when(is_call, F.to_json(F.struct(F.col("text").alias("prompt"), words.alias("words")))).alias("arguments"),
        F.when(is_call, F.array(F.concat_ws("-", "conv_id", F.col("turn") + F.when(vague, 2).otherwise(-2)))).alias("needs"),
        vague.alias("vague"),
    )
    before = steps.filter("vague").select(F.col("conv_id").alias("of_conv"), (F.col("turn") + 2).alias("of_turn")).distinct()
    steps = steps.join(before, (F.col("conv_id") == F.col("of_conv")) & (F.col("turn") == F.col("of_turn")), "left")
    steps = steps.withColumn("needs", F.when(F.col("vague") | F.col("of_conv").isNull(), F.col("needs")))
    found = tool_calls.format_chat(steps, {"open": _prompt(40), "follow": _prompt(20)})
    return found.withColumn("errors", F.array_join("errors", "; "))


OP6_SQL = """
    WITH RECURSIVE steps AS (
        SELECT *, CASE role WHEN 'user' THEN 'call' WHEN 'assistant' THEN 'result' ELSE 'message' END AS kind,
            len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS words
        FROM conversations),
    tools AS (SELECT conv_id, turn, conv_id || '-' || turn AS id, CASE WHEN turn < 2 THEN 'open' ELSE 'follow' END AS name
              FROM steps WHERE kind = 'call'),
    results AS (SELECT conv_id, turn - 1 AS call_turn FROM steps WHERE kind = 'result'),
    -- Each call that says too little waits for the next call, and where that one says too little for the one after it.
    waits AS (SELECT a.conv_id, a.turn FROM steps a JOIN tools b ON a.conv_id = b.conv_id AND b.turn = a.turn + 2
              WHERE a.kind = 'call' AND a.words < :vague),
    run AS (
        SELECT conv_id, turn, turn + 2 AS until, 1 AS far FROM waits
        UNION ALL SELECT run.conv_id, run.turn, until + 2, far + 1 FROM run JOIN waits w ON w.conv_id = run.conv_id AND w.turn = until),
    late AS (
        SELECT run.conv_id, run.turn, max(until + CASE WHEN r.conv_id IS NULL THEN 0 ELSE 1 END) AS major, max(far) AS minor
        FROM run LEFT JOIN results r ON r.conv_id = run.conv_id AND r.call_turn = until GROUP BY run.conv_id, run.turn)
    SELECT s.conv_id, s.turn, s.kind,
        CASE s.kind WHEN 'call' THEN c.id WHEN 'result' THEN s.conv_id || '-' || (s.turn - 1) END AS call_id,
        CASE WHEN s.kind = 'message' THEN 'message' WHEN c.id IS NULL THEN 'orphan'
            WHEN s.kind = 'call' AND r.conv_id IS NULL THEN 'unanswered' ELSE 'linked' END AS status,
        CASE WHEN l.major > s.turn THEN l.major ELSE s.turn END AS major,
        CAST(CASE WHEN l.major >= s.turn THEN l.minor ELSE 0 END AS BIGINT) AS minor,
        CASE WHEN s.kind <> 'call' THEN '' ELSE concat_ws('; ',
            CASE WHEN text IS NULL THEN '$.prompt: required' WHEN text = '' THEN '$.prompt: minLength'
                WHEN length(text) > 400 THEN '$.prompt: maxLength' END,
            CASE WHEN words < 1 THEN '$.words: minimum'
                WHEN words > CASE WHEN s.turn < 2 THEN 40 ELSE 20 END THEN '$.words: maximum' END) END AS errors,
        CASE s.kind
            WHEN 'message' THEN '{"content":' || coalesce(to_json(text), 'null') || ',"kind":"message","role":' || to_json(role) || '}'
            WHEN 'result' THEN '{"call_id":"' || s.conv_id || '-' || (s.turn - 1) || '","content":' || coalesce(to_json(text), 'null')
                || ',"kind":"result","name":' || coalesce(to_json(c.name), 'null') || '}'
            ELSE '{"arguments":{' || coalesce('"prompt":' || to_json(text) || ',', '') || '"words":' || words
                || '},"call_id":"' || c.id || '","kind":"call","name":"' || c.name || '"}' END AS json
    FROM steps s
    LEFT JOIN tools c ON c.conv_id = s.conv_id AND c.turn = CASE s.kind WHEN 'call' THEN s.turn WHEN 'result' THEN s.turn - 1 END
    LEFT JOIN results r ON r.conv_id = s.conv_id AND r.call_turn = s.turn
    LEFT JOIN late l ON l.conv_id = s.conv_id AND l.turn = CASE s.kind WHEN 'call' THEN s.turn WHEN 'result' THEN s.turn - 1 END""".replace(
    ":vague", str(VAGUE)
)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score(docs, model).select(
        "doc_id", held_out("doc_id", 4).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )


OP8_SQL = """
    WITH d AS (
        SELECT doc_id, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
        FROM documents),
    b AS (
        SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
        FROM benchmark),
    sized AS (SELECT item, w, least(len(w), 13) AS n FROM b WHERE len(w) > 0),
    windows AS (
        SELECT DISTINCT item, n, array_to_string(w[s : s + n - 1], ' ') AS run
        FROM (SELECT item, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM sized)),
    runs AS (
        SELECT doc_id, s, n, array_to_string(w[s : s + n - 1], ' ') AS run
        FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s
              FROM d, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n)),
    hits AS (SELECT doc_id, s, n, item FROM runs JOIN windows USING (n, run)),
    n_hits AS (
        SELECT doc_id, count(DISTINCT p) AS n_hit
        FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM hits) GROUP BY doc_id),
    n_items AS (
        SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
        FROM (SELECT DISTINCT doc_id, item FROM hits WHERE item IS NOT NULL) GROUP BY doc_id)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
        sha256(coalesce(items, '')) AS items_sha256,
        coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
    FROM d LEFT JOIN n_hits USING (doc_id) LEFT JOIN n_items USING (doc_id)"""


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(_documents(spark, sf_dir), modulus=7, remainder=2)


def op10_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(_documents(spark, sf_dir))
    base = F.filter("spans", lambda s: s["kind"] < len(secrets.BASE))

    def count(n: int) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == n)).cast("long")

    counts = [count(n).alias(f"n_{kind}") for n, (kind, *_) in enumerate(secrets.BASE)]
    return found.select(
        "doc_id", *counts, F.sha2(secrets.listed(base), 256).alias("base_sha256"), secrets.listed(F.col("spans")).alias("spans")
    )


def op10_sql() -> str:
    """Places by adding up what lies between matches; links by comparing all parts of a text."""

    def of(n: int, kind: str, pattern: str, group: int, least: int) -> str:
        text = pattern.replace("'", "''")
        mixed = " AND regexp_matches(m, '[A-Z]') AND regexp_matches(m, '[a-z]') AND regexp_matches(m, '[0-9]')"
        ok = f"length(regexp_extract(m, '{text}', {group})) >= {least}" + mixed * (kind == "secret_part")
        return f"""
            SELECT doc_id, {n} AS kind, '{secrets.ROLE[kind]}' AS role, {n < len(secrets.BASE)} AS strong, m, {ok} AS ok,
                sum(length(g) + length(m)) OVER (PARTITION BY doc_id ORDER BY i) AS stop
            FROM (SELECT doc_id, unnest(f) AS m, unnest(g[1 : len(f)]) AS g, unnest(range(len(f))) AS i
                  FROM (SELECT doc_id, regexp_extract_all(text, '{text}') AS f, string_split_regex(text, '{text}') AS g FROM d))"""

    matches = " UNION ALL ".join(of(n, *k) for n, k in enumerate((*secrets.BASE, *secrets.WEAK)))
    names = "[" + ", ".join(f"'{k}'" for k in secrets.KINDS) + "]"
    one = f"{names}[kind + 1] || ':' || start || ':' || stop"
    return f"""
        WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
        parts AS (SELECT doc_id, kind, role, strong, stop - length(m) AS start, stop FROM ({matches}) WHERE ok),
        linked AS (
            SELECT w.doc_id, w.kind, w.start, w.stop
            FROM parts w JOIN parts p ON w.doc_id = p.doc_id AND NOT w.strong AND w.role <> p.role
                AND p.start <= w.stop + {secrets.REACH} AND p.stop >= w.start - {secrets.REACH}
            GROUP BY w.doc_id, w.kind, w.start, w.stop
            HAVING bool_or(p.strong) OR count(DISTINCT p.role) = 2 OR bool_or(w.role <> 'endpoint' AND p.role <> 'endpoint')),
        spans AS (SELECT doc_id, kind, start, stop FROM parts WHERE strong UNION ALL SELECT * FROM linked),
        told AS (
            SELECT doc_id, count(*) FILTER (kind = 0) AS a, count(*) FILTER (kind = 1) AS b, count(*) FILTER (kind = 2) AS c,
                string_agg({one}, ',' ORDER BY start, kind, stop) FILTER (kind < {len(secrets.BASE)}) AS base,
                string_agg({one}, ',' ORDER BY start, kind, stop) AS every
            FROM spans GROUP BY doc_id)
        SELECT doc_id, coalesce(a, 0) AS n_assign, coalesce(b, 0) AS n_access, coalesce(c, 0) AS n_hex,
            sha256(coalesce(base, '')) AS base_sha256, coalesce(every, '') AS spans
        FROM d LEFT JOIN told USING (doc_id)"""


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = vectors.select("vec_id", label.alias("label"), negatives.quantised(F.col("embedding"), 256).alias("vector"))
    return negatives.mine(vectors, F.col("vec_id") % 50 == 0)


OP11_SQL = """
    WITH v AS (
        SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
            list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
        FROM embeddings
        WHERE vec_id IS NOT NULL AND label IS NOT NULL
            AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
    scores AS (
        SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
        FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id AND len(a.q) = len(b.q)),
    positives AS (
        SELECT *, CAST(row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS INTEGER) AS positive_rank
        FROM scores WHERE same QUALIFY positive_rank <= 5)
    SELECT anchor_id, p.vec_id AS positive_id, positive_rank,
        CAST(row_number() OVER (PARTITION BY anchor_id, positive_rank ORDER BY n.score DESC, n.vec_id) AS INTEGER) AS rank,
        n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
    FROM positives p JOIN scores n USING (anchor_id)
    WHERE NOT n.same AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
    QUALIFY rank <= 3"""


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = variants.word_counts(_documents(spark, sf_dir), least_chars=7, least_n=2, drop_every=31)
    return variants.group_variants(counts, ratio=10).select("word", "form", "root", "n", "n_near", "form_n")


def op13_token_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents to shards of ids; each one's place is asked of the key index, and its ids are read there."""
    folder = scratch_dir(spark, "token-index")
    keys = token_index.write(_documents(spark, sf_dir), folder, TOKENIZER, END)
    return token_index.checksums(spark, folder, keys).select("doc_id", "start", "n_tokens", "ids_crc32")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    operators = (
        op1_mixing,
        op2_quality_classifier,
        op3_document_fingerprints,
        op4_token_counts,
        op5_simhash_near_dedup,
        op6_tool_calls,
        op7_toxicity,
        op8_benchmark_decontamination,
        op9_lm_scoring,
        op10_secret_scans,
        op11_hard_negatives,
        op12_spelling_variants,
        op13_token_index,
    )
    return {f.__name__: f for f in operators} | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    return {"op1_mixing": OP1_SQL, "op6_tool_calls": OP6_SQL, "op8_benchmark_decontamination": OP8_SQL, "op10_secret_scans": op10_sql(), "op11_hard_negatives": OP11_SQL}
