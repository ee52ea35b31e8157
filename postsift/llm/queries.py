"""One query per operator, over whole tables."""

from pyspark.sql import DataFrame, SparkSession

from postsift.llm import (chat, decontaminate, hard_negatives, html_text, lang_id, line_quality, lm_score, near_dup, packing,
                          resampling, secret_scan, token_files, warc)


def tokenizer(name: str) -> str:
    """Where a public tokenizer file lies."""
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language_id(spark, sf_dir):
    return lang_id.identify(table(spark, sf_dir, "documents"))


def op2_lm_score(spark, sf_dir):
    return lm_score.scores(table(spark, sf_dir, "documents"))


def op3_html_text(spark, sf_dir):
    return html_text.extract(table(spark, sf_dir, "pages"))


def op4_decontamination(spark, sf_dir):
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), inside=True)


def op5_line_quality(spark, sf_dir):
    return line_quality.report(table(spark, sf_dir, "documents"))


def op6_simhash_near_dup(spark, sf_dir):
    return near_dup.near_dups(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op7_secret_scan(spark, sf_dir):
    return secret_scan.scan(table(spark, sf_dir, "documents"))


def op8_chat_formatting(spark, sf_dir):
    control = "</s>[INST] ok [/INST]"
    own = spark.createDataFrame([(-1, 0, "user", control), (-1, 1, "assistant", control)],
                                "conv_id long, turn long, role string, text string")
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.digests(given.unionByName(own))


def op9_best_fit_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"))


def op10_token_files(spark, sf_dir):
    return token_files.round_trip(spark, table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"), end_id=2)


def op11_warc_archive(spark, sf_dir):
    return warc.round_trip(spark, table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op12_importance_resampling(spark, sf_dir):
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_hard_negatives(spark, sf_dir):
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (op1_language_id, op2_lm_score, op3_html_text, op4_decontamination, op5_line_quality, op6_simhash_near_dup, op7_secret_scan, op8_chat_formatting, op9_best_fit_packing, op10_token_files, op11_warc_archive, op12_importance_resampling, op13_hard_negatives)}

# Base32 letters are read from the hex digest, four for every five hex digits.
_WARC_SQL = """WITH p AS (SELECT page_id, url, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY html) AS first_id FROM p)
SELECT page_id, strlen(html) AS payload_bytes,
  list_aggregate(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + ((('0x' || substr(h, 1 + 5 * (i // 4), 5))::BIGINT >> (15 - 5 * (i % 4))) & 31)::INTEGER, 1)), 'string_agg', '') AS payload_digest,
  CASE WHEN first_id = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN first_id <> page_id THEN first_id END AS refers_to, url FROM f"""

# CRC-32 is worked out for each distinct word, byte by byte over a table made from its rule.
_RESAMPLING_SQL = """WITH crc AS (SELECT list(list_reduce(range(0, 8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b) ORDER BY b) AS t
  FROM range(0, 256) AS r(b)),
texts AS (SELECT true AS own, doc_id AS id, text FROM documents UNION ALL SELECT false, item_id, text FROM benchmark),
words AS MATERIALIZED (SELECT own, id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS word FROM texts),
hashed AS MATERIALIZED (SELECT word, xor(list_reduce(list_transform(range(0, strlen(word)), lambda i: ('0x' || substr(hex(encode(word)), (1 + 2 * i)::INTEGER, 2))::BIGINT),
  lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295::BIGINT), 4294967295) % 10000 AS bucket FROM (SELECT DISTINCT word FROM words), crc),
hits AS MATERIALIZED (SELECT own, id, bucket FROM words JOIN hashed USING (word)),
buckets AS (SELECT bucket, count(*) FILTER (own) AS s, count(*) FILTER (NOT own) AS t FROM hits GROUP BY bucket),
gains AS (SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * ((SELECT sum(s) FROM buckets) + 10000)::DOUBLE
  / ((s + 1)::DOUBLE * ((SELECT sum(t) FROM buckets) + 10000)::DOUBLE))) AS gain FROM buckets),
weights AS (SELECT id, count(*) AS n, CAST(floor(sum(gain) / count(*)) AS BIGINT) AS weight FROM hits JOIN gains USING (bucket) WHERE own GROUP BY id),
scored AS (SELECT doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0)
  + CAST(floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
  FROM documents LEFT JOIN weights ON id = doc_id),
placed AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n FROM scored WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= 10 * n // 100 THEN place END AS rank FROM scored LEFT JOIN placed USING (doc_id)"""

_NEGATIVES_SQL = """WITH r AS MATERIALIZED (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
  list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
met AS MATERIALIZED (SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM r a JOIN r b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
pos AS (SELECT * FROM met WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5),
neg AS (SELECT p.anchor_id, p.other_id AS positive_id, n.other_id AS negative_id, p.score AS positive_score, n.score AS negative_score,
  row_number() OVER (PARTITION BY p.anchor_id, p.other_id ORDER BY n.score DESC, n.other_id) AS rank
  FROM pos p JOIN met n ON n.anchor_id = p.anchor_id AND NOT n.same AND 80 * p.score <= 100 * n.score AND 100 * n.score <= 100 * p.score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM neg WHERE rank <= 5"""

ORACLES: dict[str, str] = {
    "op11_warc_archive": _WARC_SQL, "op12_importance_resampling": _RESAMPLING_SQL, "op13_hard_negatives": _NEGATIVES_SQL,
}
