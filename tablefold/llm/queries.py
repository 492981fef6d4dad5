"""The operators of this package on the test tables, and SQL with equal results where there is one."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablefold.llm import chat, decontaminate, divergence, idfiles, language, minhash, neighbours, packing, periodic, quality, secrets, suffixes, toxicity
from tablefold.llm.common import id_remainder, table
from tablefold.session import shared_folder


def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), threshold=0.85)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels")
    held_out = F.coalesce(id_remainder("doc_id", 5) == 0, F.lit(False))
    model = toxicity.learn(docs, labels.filter(~held_out))
    return toxicity.score(docs, model, ["doc_id", held_out.alias("held_out")]).withColumn("evidence", F.array_join("evidence", " "))


def op3_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffixes.remove_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])
    return out.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    longest = F.array_max(F.transform("tiles", lambda t: t["length"]))
    return found.select("doc_id", "item_id", "coverage", F.size("tiles").alias("n_tiles"), longest.alias("longest"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.token_pieces(table(spark, sf_dir, "documents"))
    digests = pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return packing.pack(digests)


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    trusted = table(spark, sf_dir, "labels").filter("quality = 1").select("doc_id")
    return quality.classify(table(spark, sf_dir, "documents"), trusted)


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = secrets.find(docs, secrets.learn(docs))

    def written(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"] != secrets.RANDOM)
    return found.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(written(base), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"))


def op8_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = neighbours.indexed(table(spark, sf_dir, "embeddings"))
    return neighbours.search(index, index.filter("vec_id % 20 = 0"))


#: Tools that the derived calls of ``op9_chat`` name, with the schemas of their arguments.
TOOLS = {
    "lookup": {
        "type": "object", "required": ["query"], "additionalProperties": False,
        "properties": {"query": {"type": "string", "minLength": 1}, "limit": {"type": "integer", "minimum": 1, "maximum": 20}},
    },
    "combine": {
        "type": "object", "required": ["parts", "query"],
        "properties": {"parts": {"type": "array", "items": {"type": "string"}}, "query": {"type": "string"}},
    },
}


def tool_messages(turns: DataFrame) -> DataFrame:
    """Messages with tool calls, derived from plain turns.

    An assistant's turn calls ``lookup`` with its first sentence and ``combine``,
    which needs the lookup; a user's turn is also the report of the lookup of the turn
    before it. Every word count divisible by 7 leaves the limit out of its range.
    """
    n_words = F.size(F.split("text", r"\s+"))
    call = F.concat_ws("-", "conv_id", "turn")
    looked = F.to_json(F.struct(F.when(n_words % 7 == 0, 0).otherwise(n_words % 20 + 1).alias("limit"), F.substring_index("text", ".", 1).alias("query")))
    combined = F.to_json(F.struct(F.array(F.concat(F.lit("a"), call)).alias("parts"), F.col("role").alias("query")))
    nothing = F.array().cast("array<string>")
    calls = F.array(
        F.struct(F.concat(F.lit("b"), call).alias("call_id"), F.lit("combine").alias("name"), combined.alias("arguments"), F.array(F.concat(F.lit("a"), call)).alias("needs")),
        F.struct(F.concat(F.lit("a"), call).alias("call_id"), F.lit("lookup").alias("name"), looked.alias("arguments"), nothing.alias("needs")),
    )
    said = turns.select("conv_id", "turn", "role", F.col("text").alias("content"), F.when(F.col("role") == "assistant", calls).alias("calls"), F.lit(None).cast("string").alias("call_id"))
    reported = turns.filter("role = 'user' and turn > 0").select(
        "conv_id", "turn", F.lit("tool").alias("role"), F.col("text").alias("content"), F.lit(None).cast(said.schema["calls"].dataType).alias("calls"),
        F.concat(F.lit("a"), F.concat_ws("-", F.col("conv_id"), F.col("turn") - 1)).alias("call_id"),
    )
    return said.unionByName(reported)


def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = chat.format_chats(tool_messages(table(spark, sf_dir, "conversations")), TOOLS)
    return out.withColumn("problems", F.array_join("problems", "; "))


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(id_remainder("doc_id", 4) == 2, F.lit(False))
    model = language.learn(docs.filter(~held_out))
    return language.identify(docs, model, ["doc_id", held_out.alias("held_out")])


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """Documents whose identifier's crc32 ends in 0 repeat a stretch of words from some place on; the others stay as they are."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    with_words = docs.select("doc_id", "text", h.alias("h"), g.alias("g"), F.when(h % 10 == 0, words).alias("words"))
    with_size = with_words.withColumn("n", F.size("words").cast("bigint"))
    placed = with_size.withColumn("a", F.when(F.col("n") > 0, F.pmod("g", "n")))
    placed = placed.withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)))
    tail = F.flatten(F.array_repeat(F.expr("slice(words, a + 1, p)"), F.ceil((F.col("n") - F.col("a")) / F.col("p")).cast("int")))
    repeated = F.concat(F.expr("slice(words, 1, a)"), F.slice(tail, F.lit(1), (F.col("n") - F.col("a")).cast("int")))
    return placed.select("doc_id", F.when(F.col("a").isNotNull(), F.array_join(repeated, " ")).otherwise(F.col("text")).alias("text"))


def op12_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.find_runs(with_planted_periods(table(spark, sf_dir, "documents")))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    best = F.col("strongest")
    return found.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), best["start"].alias("start"), best["length"].alias("length"), best["period"].alias("period"),
        F.expr("(1000 * strongest.length) div strongest.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_idfiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{shared_folder(spark)}/ids-{uuid.uuid4().hex}"
    idfiles.write_ids(idfiles.token_ids(table(spark, sf_dir, "documents")), folder, idfiles.id_width())
    return idfiles.read_ids(spark, folder).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


QUERIES = {
    "op1_minhash": op1_minhash,
    "op2_toxicity": op2_toxicity,
    "op3_suffixes": op3_suffixes,
    "op4_decontaminate": op4_decontaminate,
    "op5_packing": op5_packing,
    "op6_quality": op6_quality,
    "op7_secrets": op7_secrets,
    "op8_neighbours": op8_neighbours,
    "op9_chat": op9_chat,
    "op10_language": op10_language,
    "op11_divergence": op11_divergence,
    "op12_periodic": op12_periodic,
    "op13_idfiles": op13_idfiles,
}

ORACLE = {
    "op11_divergence": r"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
words AS (
  SELECT r, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM d),
kept AS (SELECT lang, term, count(*) AS lang_n FROM words GROUP BY lang, term HAVING count(DISTINCT r) >= 10),
langs AS (SELECT lang, count(*) AS v, sum(lang_n) AS lang_total FROM kept GROUP BY lang),
counts AS (SELECT lang, source, term, count(*) AS n FROM words SEMI JOIN kept USING (lang, term) GROUP BY ALL),
sums AS (SELECT lang, source, sum(n) AS total FROM counts GROUP BY ALL),
groups AS (
  SELECT lang, source, coalesce(v, 0) AS v, coalesce(total, 0) AS total, lang_total
  FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN langs USING (lang) LEFT JOIN sums USING (lang, source)),
prices AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, 1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 2)) // (g.total + 2 * g.v) AS p,
    1 + (1000000000::HUGEINT * (k.lang_n + 2)) // (g.lang_total + 2 * g.v) AS q
  FROM groups g JOIN kept k USING (lang) LEFT JOIN counts c USING (lang, source, term)),
summed AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
  FROM prices a JOIN prices b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0)::BIGINT AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN summed s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (((p - q) * (p - q)) // (p + q))::BIGINT FROM prices WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM found)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 10
""",
    "op8_neighbours": """
WITH sound AS (
  SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v) AS score
  FROM sound q JOIN sound c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
""",
    "op1_minhash": r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s
  FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION
  SELECT r.a, e.b FROM reached r JOIN edges e ON r.b = e.a)
SELECT d.doc_id, coalesce(z.n, 0)::BIGINT AS n_shingles, m.component_id, d.doc_id = m.component_id AS kept
FROM documents d LEFT JOIN sizes z USING (doc_id) JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reached GROUP BY a) m USING (doc_id)
""",
}
