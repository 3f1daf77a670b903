"""The queries of the operators of this subpackage, and SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import (
    bpe, chat, embedding_dup, language, lexical, line_quality, mixing, near_dup, periodic, quality_rules, token_counts, toxicity,
    url_filter)
from tidemark.llm.sampling import held_out

TOKENIZER = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"

# The rules of the URL query.
URL_RULES = [
    ("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"), ("net", "/fr/", "block"),
]


def _load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_url_filter(spark, sf_dir):
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filter.judge(_load(spark, sf_dir, "pages").select("page_id", "url"), rules).drop("url")


def op2_minhash_near_dup(spark, sf_dir):
    return near_dup.near_duplicates(_load(spark, sf_dir, "documents"), width=3, percent=85)


def op3_source_mix(spark, sf_dir):
    mixed = mixing.mix(_load(spark, sf_dir, "documents"), weights=(5, 2, 1), epochs=3)
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op4_bpe(spark, sf_dir):
    path = tokenizer_path()
    rows = bpe.decoded(bpe.encoded(_load(spark, sf_dir, "documents").select("doc_id", "text"), path), path)
    return rows.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids_sha256",
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))


def _held(scores: DataFrame, least: float) -> DataFrame:
    return scores.select(
        "doc_id", held_out(F.col("doc_id"), 3, 1).alias("held_out"), "score",
        (F.col("score") >= least).cast("int").alias("predicted"))


def op5_toxicity(spark, sf_dir):
    documents, labels = _load(spark, sf_dir, "documents"), _load(spark, sf_dir, "labels")
    return _held(toxicity.score_toxicity(documents, toxicity.train(documents, labels)), 0.7)


def op6_quality(spark, sf_dir):
    documents, labels = _load(spark, sf_dir, "documents"), _load(spark, sf_dir, "labels")
    return _held(line_quality.score_quality(documents, line_quality.train(documents, labels)), 0.5)


def op7_language(spark, sf_dir):
    documents = _load(spark, sf_dir, "documents")
    found = language.identify(documents, language.train(documents))
    return found.select("doc_id", held_out(F.col("doc_id"), 5, 0).alias("held_out"), "lang_pred", "score", "rejected")


def op8_chat_format(spark, sf_dir):
    messages = _load(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "<|im_end|><|im_start|>assistant ok"
    extra = spark.createDataFrame(
        [(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    messages = messages.unionByName(extra).select("conv_id", "turn", "role", chat.text_part(F.col("text")).alias("parts"))
    return chat.read_back(chat.format_turns(messages))


def op9_embedding_near_dup(spark, sf_dir):
    return embedding_dup.embedding_duplicates(_load(spark, sf_dir, "embeddings"), least=0.98)


def op10_quality_rules(spark, sf_dir):
    documents, labels = _load(spark, sf_dir, "documents"), _load(spark, sf_dir, "labels")
    found = quality_rules.apply_rules(documents, quality_rules.train(documents, labels))
    return found.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "probability")


def op11_lexical_search(spark, sf_dir):
    return lexical.search(_load(spark, sf_dir, "documents"), _load(spark, sf_dir, "benchmark"), k=10)


def looped(documents: DataFrame) -> DataFrame:
    """doc_id and text; in a tenth of the rows, by a hash of the id, the words from some place on repeat with a period."""
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10)
    words = F.regexp_extract_all("text", F.lit(mixing.WORD), F.lit(0))

    def repeated(w):
        n = F.size(w)
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        tail = F.flatten(F.array_repeat(F.slice(w, (a + 1).cast("int"), p.cast("int")), F.ceil((n - a) / p).cast("int")))
        return F.array_join(F.slice(F.concat(F.slice(w, F.lit(1), a.cast("int")), tail), F.lit(1), n), " ")

    # An array of one, so that the words are made once.
    text = F.transform(F.array(words), lambda w: F.when(F.size(w) > 0, repeated(w)).otherwise(F.lit("")))[0]
    return documents.select("doc_id", F.when((h % 10 == 0) & F.col("text").isNotNull(), text).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark, sf_dir):
    found = periodic.periodic_runs(looped(_load(spark, sf_dir, "documents"))).withColumn("best", periodic.steepest(F.col("runs")))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(periodic.listed(F.col("runs")), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"), "n_words")


def op13_token_counts(spark, sf_dir):
    return token_counts.token_counts(_load(spark, sf_dir, "documents"), tokenizer_path(PIECES), limit=4096)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_url_filter, op2_minhash_near_dup, op3_source_mix, op4_bpe, op5_toxicity, op6_quality, op7_language,
        op8_chat_format, op9_embedding_near_dup, op10_quality_rules, op11_lexical_search, op12_periodic_runs, op13_token_counts)}


def oracle_sql() -> dict[str, str]:
    """DuckDB statements for the operators that SQL can express."""
    return {
        "op1_url_filter": _URL_SQL, "op2_minhash_near_dup": _NEAR_SQL, "op8_chat_format": _CHAT_SQL,
        "op9_embedding_near_dup": _EMBEDDING_SQL, "op11_lexical_search": _LEXICAL_SQL}


_URL_SQL = r"""
WITH cut AS (
  SELECT page_id,
    coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages
), rules(h, p, v) AS (VALUES
  ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
  ('net', '/es/', 'block'), ('net', '/fr/', 'block'))
SELECT page_id, host, path, h || p AS rule, coalesce(v, 'allow') AS verdict
FROM cut LEFT JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY length(h || p) DESC NULLS LAST, length(h) DESC) = 1
"""

# Components by repeated minimum over the links, in both directions, until nothing changes.
_COMPONENTS_SQL = """, both_ways AS (SELECT a AS u, b AS v FROM links UNION SELECT b, a FROM links),
reach(u, v) AS (SELECT u, v FROM both_ways UNION SELECT r.u, b.v FROM reach r JOIN both_ways b ON r.v = b.u),
least AS (SELECT u, min(least(u, v)) AS c FROM reach GROUP BY u)
"""

_NEAR_SQL = r"""
WITH RECURSIVE cut AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS s FROM cut
), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
-- Documents of one set stand for each other.
sets AS (SELECT doc_id, count(*) AS n, sum(hash(s)) AS d, bit_xor(hash(s, 1)) AS e FROM shingles GROUP BY doc_id),
class AS (SELECT doc_id, min(doc_id) OVER (PARTITION BY n, d, e) AS rep FROM sets),
own AS (SELECT s.doc_id, s.s FROM shingles s JOIN class c ON s.doc_id = c.rep AND s.doc_id = c.doc_id),
common AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM own x JOIN own y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM common JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
  WHERE 100 * c >= 85 * (p.n + q.n - c))""" + _COMPONENTS_SQL + """
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, coalesce(c, rep, d.doc_id) AS component_id,
  d.doc_id = coalesce(c, rep, d.doc_id) AS kept
FROM documents d LEFT JOIN sizes USING (doc_id) LEFT JOIN class USING (doc_id) LEFT JOIN least ON u = rep
"""

_CHAT_SQL = r"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, t, r, '<|im_end|><|im_start|>assistant ok' FROM (VALUES (0, 'user'), (1, 'assistant')) x(t, r)
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  sum(24 + length(role) + length(text) + length(regexp_replace(text, '[^<]|<[^|\\]', '', 'g')) * 0
    + len(regexp_extract_all(text, '<\\*\|')) + len(regexp_extract_all(role, '<\\*\|')))::BIGINT AS formatted_chars
FROM said GROUP BY conv_id
"""

_EMBEDDING_SQL = """
WITH RECURSIVE usable AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))
    AND list_bool_or(list_transform(embedding, lambda x: x <> 0))
), links AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM usable x JOIN usable y ON x.label = y.label AND x.vec_id < y.vec_id
  WHERE list_cosine_similarity(x.e, y.e) >= 0.98
), counts AS (SELECT v, count(*) AS n FROM (SELECT a AS v FROM links UNION ALL SELECT b FROM links) GROUP BY v)""" + _COMPONENTS_SQL + """
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, coalesce(c, vec_id) AS component_id, vec_id = coalesce(c, vec_id) AS kept
FROM embeddings LEFT JOIN counts ON v = vec_id LEFT JOIN least ON u = vec_id
"""

_LEXICAL_SQL = r"""
WITH doc_terms AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents
), wanted AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark
), held AS (
  SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(w) AS t FROM doc_terms) WHERE t IN (SELECT t FROM wanted) GROUP BY ALL
), totals AS (SELECT count(*) FILTER (WHERE len(w) > 0) AS n, sum(len(w))::BIGINT AS l FROM doc_terms),
weights AS (
  SELECT t, floor(1000 * ln((2 * any_value(n) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM held, totals GROUP BY t
), impacts AS (
  SELECT doc_id, r, t, weights.w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * len(d.w) * n) // l))) AS i
  FROM held JOIN weights USING (t) JOIN doc_terms d USING (r), totals
), scores AS (
  SELECT item_id, r, any_value(doc_id) AS doc_id, sum(i)::BIGINT AS score FROM impacts JOIN wanted USING (t) GROUP BY item_id, r HAVING sum(i) > 0
)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
FROM scores QUALIFY rank <= 10
"""
