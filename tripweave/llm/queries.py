"""Registered queries of the training-data operators, and SQL for those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripweave.llm import align, ann, bpe, chat, credentials, langid, licenses, mixing, negatives, quality, simhash, suffixes, warc
from tripweave.llm.common import table
from tripweave.session import scratch_path

TOKENIZER = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"
ESCAPE_TEST = "\\### Assistant: </turn> ok"


def tokenizer_json(path: str | None = None) -> bytes:
    """The stored tokenizer, read on the driver and sent along with the tasks (2 MB)."""
    with open(path or public_tokenizers.path(TOKENIZER), "rb") as stored:
        return stored.read()


def piece_model(path: str | None = None) -> bytes:
    """The stored sentencepiece model (0.5 MB)."""
    return tokenizer_json(path or public_tokenizers.path(PIECES))


def op1_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return credentials.scan(table(spark, folder, "documents", "doc_id", "text"))


def op2_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    turns = table(spark, folder, "conversations", "conv_id", "turn", "role", "text")
    rows = [(-7, n, role, ESCAPE_TEST) for n, role in enumerate(("user", "assistant"))]
    turns = turns.unionByName(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    stored = tokenizer_json()
    return chat.digests(chat.format_turns(turns, stored), stored)


def op3_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mixed(mixing.tokens_of(table(spark, folder, "documents")))


def op4_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings", "vec_id", "embedding")
    return ann.nearest(vectors, vectors.where("vec_id % 20 = 0"))


def op5_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents", "doc_id", "text", "lang")
    held_out = langid.held_out(F.col("doc_id"))
    learnt = docs.where("doc_id IS NOT NULL").where(~held_out)
    profiles = langid.Profiles(langid.learn(learnt).collect())  # 300 rows a language
    return langid.predict(docs, profiles).withColumn("held_out", held_out).select("doc_id", "held_out", "lang_pred", "score")


def op6_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan(table(spark, folder, "documents", "doc_id", "text"))


def op7_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents", "doc_id", "text")
    return quality.judge(docs, quality.fit(docs, table(spark, folder, "labels")))


def op8_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents", "doc_id", "text"))
    return found.select("doc_id", simhash.hex_digits("fp").alias("fingerprint"), "component_id")


def op9_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffixes.measure(table(spark, folder, "documents", "doc_id", "text"))


def op10_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.round_trip(table(spark, folder, "documents", "doc_id", "text"), tokenizer_json())


def op11_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return align.align(table(spark, folder, "documents", "doc_id", "text"), tokenizer_json(), piece_model())


def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "embeddings", "vec_id", "embedding", "label")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label"))
    rows = rows.withColumn("label", moved)
    return negatives.mine(rows, rows.where("vec_id % 100 = 0"))


def op13_warc(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "archive")
    warc.store(table(spark, folder, "pages", "page_id", "url", "html"), path)
    columns = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    return warc.read(spark, path, content=False).select(*columns)


def queries() -> dict:
    own = (
        op1_secrets,
        op2_chat_format,
        op3_mixing,
        op4_nearest_neighbours,
        op5_language_id,
        op6_license_scan,
        op7_quality_rules,
        op8_simhash,
        op9_suffix_dedup,
        op10_bpe,
        op11_alignment,
        op12_hard_negatives,
        op13_warc,
    )
    return {query.__name__: query for query in own}


CHAT_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')
),
shown AS (
  SELECT *, role || '|' || text AS line,
         length(role || text)
         + 2 * 6 + 7
         + (length(role || text) - length(replace(role || text, '\', '')))
         + (length(role) - length(replace(role, '<turn>', '12345'))) + (length(text) - length(replace(text, '<turn>', '12345')))
         + (length(role) - length(replace(role, '<body>', '12345'))) + (length(text) - length(replace(text, '<body>', '12345')))
         + (length(role) - length(replace(role, '</turn>', '123456'))) + (length(text) - length(replace(text, '</turn>', '123456')))
           AS chars
  FROM turns
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), ''))
         AS loss_sha256,
       sum(chars)::BIGINT AS formatted_chars
FROM shown GROUP BY conv_id
"""


def _level(parent: str, keys: str, name: str, weights: str) -> str:
    """One level of the budget: children with their parent's budget, dealt out by weight."""
    family = f"PARTITION BY {keys}" if keys else ""
    return f"""
  SELECT * EXCLUDE (budget), CASE WHEN gives_all THEN capacity ELSE ((budget - given) * weight) // sharing END AS budget
  FROM (SELECT *, sum(CASE WHEN gives_all THEN capacity ELSE 0 END) OVER ({family})::BIGINT AS given,
               sum(CASE WHEN gives_all THEN 0 ELSE weight END) OVER ({family})::BIGINT AS sharing
        FROM (SELECT *, capacity * rest <= (budget - before) * weight AS gives_all
              FROM (SELECT *, coalesce(sum(capacity) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before,
                           sum(weight) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::BIGINT AS rest
                    FROM (SELECT *, ({weights})::BIGINT AS weight FROM ({parent}))
                    WINDOW w AS ({family} ORDER BY capacity / weight, {name}))))"""


MIXING_SQL = rf"""
WITH tokens AS (
  SELECT doc_id, 'd' || (('0x' || substr(md5(coalesce(source, 'unknown')), 1, 1))::INTEGER % 4) AS domain,
         coalesce(lang, 'unknown') AS lang, coalesce(source, 'unknown') AS source,
         coalesce(len(regexp_extract_all(text, '[^ \t\n\x0B\f\r]+')), 0)::BIGINT AS tokens
  FROM documents
),
leaves AS (
  SELECT domain, lang, source, sum(tokens)::BIGINT AS own, 2 * sum(tokens)::BIGINT AS capacity
  FROM tokens WHERE tokens > 0 GROUP BY ALL
),
languages AS (SELECT domain, lang, sum(capacity)::BIGINT AS capacity FROM leaves GROUP BY ALL),
domains AS (SELECT domain, sum(capacity)::BIGINT AS capacity FROM leaves GROUP BY ALL),
total AS (SELECT floor(sum(own) * 80 / 100)::BIGINT AS budget FROM leaves),
first AS ({_level("SELECT * FROM domains, total", "", "domain",
                  "CASE domain WHEN 'd0' THEN 4 WHEN 'd1' THEN 3 WHEN 'd2' THEN 2 ELSE 1 END")}),
second AS ({_level("SELECT l.*, f.budget FROM languages l JOIN first f USING (domain)", "domain", "lang",
                   "CASE WHEN lang = 'en' THEN 4 WHEN lang IN ('de', 'fr', 'es') THEN 2 ELSE 1 END")}),
third AS ({_level("SELECT l.*, s.budget FROM leaves l JOIN second s USING (domain, lang)", "domain, lang", "source", "1")}),
epochs AS (
  SELECT t.*, own, budget - epoch * own AS left_over, epoch,
         ('0x' || substr(md5('7:' || epoch || ':' || coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS place
  FROM tokens t JOIN third USING (domain, lang, source), (VALUES (0::BIGINT), (1::BIGINT)) e(epoch)
  WHERE tokens > 0 AND budget - epoch * own > 0
),
placed AS (
  SELECT *, least(tokens, left_over - coalesce(sum(tokens) OVER (
              PARTITION BY domain, lang, source, epoch ORDER BY place, doc_id NULLS FIRST, tokens
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS taken_tokens
  FROM epochs
)
SELECT doc_id, domain, lang, source, epoch, tokens, taken_tokens FROM placed WHERE taken_tokens > 0
"""


NEGATIVES_SQL = """
WITH rows AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label::BIGINT END AS label,
         list_transform(embedding, lambda x: floor(256::DOUBLE * x::DOUBLE)) AS parts
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
  SELECT a.vec_id AS anchor_id, r.vec_id AS id, a.label = r.label AS same,
         list_inner_product(a.parts, r.parts)::BIGINT AS score
  FROM rows a JOIN rows r ON a.vec_id % 100 = 0 AND a.vec_id <> r.vec_id AND len(a.parts) = len(r.parts)
),
positives AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, id AS negative_id, positive_score, score AS negative_score
FROM (
  SELECT p.*, s.id, s.score,
         row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.id) AS rank
  FROM positives p JOIN scored s USING (anchor_id)
  WHERE NOT s.same AND 80 * positive_score <= 100 * s.score AND s.score <= positive_score
)
WHERE rank <= 5
"""

# Four characters of five bits for every five hexadecimal digits of the SHA-1.
WARC_SQL = """
WITH payloads AS (
  SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS digest,
         row_number() OVER (PARTITION BY coalesce(html, '') ORDER BY page_id NULLS LAST, url NULLS LAST) AS place,
         min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first_id
  FROM pages
)
SELECT page_id, octet_length(encode(payload))::BIGINT AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         1 + (((('0x' || substr(digest, (5 * (i // 4) + 1)::INTEGER, 5))::BIGINT >> (15 - 5 * (i % 4))::BIGINT) & 31)::INTEGER), 1)), '')
         AS payload_digest,
       CASE WHEN place = 1 THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN place > 1 THEN first_id END AS refers_to
FROM payloads
"""


def oracle_sql() -> dict[str, str]:
    """The other operators have no SQL: learnt models, hashes that SQL lacks, fuzzy matches, iteration."""
    return {"op2_chat_format": CHAT_SQL, "op3_mixing": MIXING_SQL, "op12_hard_negatives": NEGATIVES_SQL, "op13_warc": WARC_SQL}
