"""Registered queries of this subpackage, and the SQL they must agree with where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.llm import (
    archives,
    bpe,
    contamination,
    divergence,
    lexical,
    licenses,
    mixing,
    ngram_join,
    paragraphs,
    quality,
    surrogates,
    token_counts,
    topk,
)

# Tokens of a document beyond which it is marked.
TOKEN_LIMIT = 1024

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op2_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    return ngram_join.similar_documents(_table(spark, folder, "documents"))


QUERIES["op2_ngram_jaccard_join"] = op2_ngram_jaccard_join
SQL["op2_ngram_jaccard_join"] = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w
  FROM documents),
grams AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) < 5 THEN list_aggregate(w, 'string_agg', ' ')
    ELSE list_aggregate(w[i:i + 4], 'string_agg', ' ') END AS g
  FROM words, unnest(range(1, greatest(len(w) - 3, 2))) AS r(i)
  WHERE len(w) > 0),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
  FROM grams x JOIN grams y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM common JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
  WHERE 100 * c >= 75 * (p.n + q.n - c)),
reach AS (
  SELECT doc_id, doc_id AS root FROM documents
  UNION SELECT l.b, r.root FROM reach r JOIN links l ON l.a = r.doc_id)
SELECT d.doc_id, coalesce(s.n, 0)::BIGINT AS n_shingles, r.component_id
FROM documents d LEFT JOIN sizes s USING (doc_id)
JOIN (SELECT doc_id, min(root) AS component_id FROM reach GROUP BY doc_id) r USING (doc_id)
"""


def op1_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of every document."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    counted = token_counts.count_tokens(_table(spark, folder, "documents"), path)
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


QUERIES["op1_token_counts"] = op1_token_counts


def op3_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    """What a mix of all documents takes of each, sources weighing 3, 1, 2 in turn."""
    mixture = mixing.mix(_table(spark, folder, "documents"))
    return mixture.select("doc_id", "size", "source_size", "target", "taken")


QUERIES["op3_mix_sources"] = op3_mix_sources
SQL["op3_mix_sources"] = r"""
WITH RECURSIVE sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size, text,
    md5('mix:' || coalesce(doc_id::VARCHAR, 'null')) AS place FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    [3.0, 1.0, 2.0][((row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1)::INT]::DOUBLE AS weight
  FROM sized GROUP BY source),
rounds AS (
  SELECT 0 AS round, 1.5::DOUBLE * sum(source_size)::DOUBLE / sum(weight) AS level FROM sources
  UNION ALL
  SELECT round + 1, (SELECT (1.5::DOUBLE * sum(source_size)::DOUBLE
      - coalesce(sum(2 * source_size) FILTER (2 * source_size < level * weight), 0)::DOUBLE)
      / sum(weight) FILTER (NOT 2 * source_size < level * weight) FROM sources)
  FROM rounds WHERE round < (SELECT count(*) FROM sources)),
final AS (SELECT arg_max(level, round) AS level FROM rounds),
targets AS (
  SELECT source, source_size, least(2.0::DOUBLE * source_size, level * weight) AS target FROM sources, final),
parts AS (
  SELECT *, floor(target + 0.5)::BIGINT AS words,
    CASE WHEN source_size > 0 THEN floor(target + 0.5)::BIGINT // source_size ELSE 0 END AS whole FROM targets),
placed AS (
  SELECT doc_id, size, source_size, target, whole, words - whole * source_size AS part,
    coalesce(sum(size) OVER (PARTITION BY s.source ORDER BY place, doc_id, size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
  FROM sized s JOIN parts p ON s.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size::BIGINT AS size, source_size, target,
  (whole * size + greatest(least(part - before, size), 0))::BIGINT AS taken FROM placed
"""


def op7_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Line and document rules on all documents."""
    rated = quality.rate(_table(spark, folder, "documents"))
    return rated.select("doc_id", *quality.ADDED, "base_failed", "kept")


QUERIES["op7_quality_rules"] = op7_quality_rules
SQL["op7_quality_rules"] = r"""
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    regexp_extract_all(coalesce(text, ''), '[#*$%&|<>]') AS symbols
  FROM documents),
triples AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i], w[i + 1], w[i + 2]) AS n
  FROM texts, unnest(range(1, greatest(len(w) - 1, 1))) AS r(i)),
covered AS (
  SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words
  FROM triples, unnest([0, 1, 2]) AS o(k) WHERE n > 1 GROUP BY doc_id),
lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS k
  FROM texts),
parsed AS (
  SELECT doc_id, k, line, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS w,
    row_number() OVER (PARTITION BY doc_id, line ORDER BY k) > 1 AS again
  FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
judged AS (
  SELECT doc_id, again, len(list_aggregate(w, 'string_agg', '')) AS chars,
    again OR NOT regexp_matches(w[-1], '[.!?:;"''…。！？；：｡।॥؟۔؛։።᙮\p{Pe}\p{Pf}\p{Pi}]$')
      OR len([x for x in w if x IN ('|', '>', '»', '·', '•', '/', '::', '<', '›')]) > 0.2 * len(w)
      OR len(regexp_extract_all(line, '[#*$%&|<>]')) > 0.3 * len(w)
      OR len([p for p in [
        'lorem ipsum', 'enable javascript', 'javascript is disabled', 'cookie policy', 'privacy policy', 'terms of use',
        'terms of service', 'all rights reserved', 'sign in to', 'log in to', 'subscribe to our newsletter',
        'skip to content', 'alle rechte vorbehalten', 'datenschutzerklärung', 'nutzungsbedingungen',
        'cookies akzeptieren', 'zum inhalt springen', 'tous droits réservés', 'mentions légales',
        'politique de confidentialité', 'accepter les cookies', 'aller au contenu', 'todos los derechos reservados',
        'aviso legal', 'política de privacidad', 'aceptar cookies', 'saltar al contenido']
        IF contains(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), p)
          AND len(string_split(p, ' ')) >= 0.25 * len(w)]) > 0 AS fails
  FROM parsed),
by_doc AS (
  SELECT doc_id, count(*) FILTER (again) AS n_dup_lines, coalesce(sum(chars) FILTER (fails), 0) AS lost_chars
  FROM judged GROUP BY doc_id),
base AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(len(list_aggregate(w, 'string_agg', '')), 0)::BIGINT AS word_chars,
    len(symbols)::BIGINT AS n_symbols, coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
    coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, coalesce(lost_chars, 0)::BIGINT AS lost_chars
  FROM texts LEFT JOIN by_doc USING (doc_id) LEFT JOIN covered USING (doc_id)),
failed AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM base)
SELECT *, NOT base_failed AND lost_chars <= 0.5 * word_chars AS kept FROM failed
"""


def op8_exact_top_k(spark: SparkSession, folder: str) -> DataFrame:
    """The ten highest inner products of every hundredth vector."""
    return topk.top_k(_table(spark, folder, "embeddings"))


QUERIES["op8_exact_top_k"] = op8_exact_top_k
SQL["op8_exact_top_k"] = """
WITH whole AS (
  SELECT vec_id, [floor(1024 * x::DOUBLE) for x in embedding] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM whole q JOIN whole c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0),
ranked AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score
  FROM scored)
SELECT * FROM ranked WHERE rank <= 10
"""


def op9_byte_level_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Token ids of every document and the bytes they decode to, as digests."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.round_trip(_table(spark, folder, "documents"), path, public_tokenizers.PATTERN)


QUERIES["op9_byte_level_bpe"] = op9_byte_level_bpe


def op5_legacy_archives(spark: SparkSession, folder: str) -> DataFrame:
    """Every page written to an ARC archive, converted to WARC and read back."""
    return archives.archive_pages(_table(spark, folder, "pages"))


QUERIES["op5_legacy_archives"] = op5_legacy_archives
SQL["op5_legacy_archives"] = """
WITH payloads AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha256(coalesce(html, '')) AS digest FROM pages),
firsts AS (
  SELECT *, CASE WHEN n >= 100 THEN min(page_id) OVER (PARTITION BY digest, n >= 100) ELSE page_id END AS first_id
  FROM payloads)
SELECT page_id, n::BIGINT AS payload_bytes, digest AS payload_digest,
  CASE WHEN first_id = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN first_id <> page_id THEN first_id END AS refers_to
FROM firsts
"""


def op6_license_scans(spark: SparkSession, folder: str) -> DataFrame:
    """Licences of all documents, by notices, whole texts and parts of texts."""
    return licenses.resolve(_table(spark, folder, "documents"), licenses.all_templates(spark))


QUERIES["op6_license_scans"] = op6_license_scans


def op10_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Paragraphs and passages that several documents hold."""
    return paragraphs.repeated_paragraphs(_table(spark, folder, "documents"))


QUERIES["op10_substring_dedup"] = op10_substring_dedup


def op4_pii_surrogates(spark: SparkSession, folder: str) -> DataFrame:
    """All documents with personal data replaced."""
    return surrogates.pseudonymise(_table(spark, folder, "documents")).select("doc_id", "text", "n_entities")


QUERIES["op4_pii_surrogates"] = op4_pii_surrogates


def op11_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    """The fifty best documents of every benchmark item."""
    return lexical.search(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


QUERIES["op11_lexical_search"] = op11_lexical_search
SQL["op11_lexical_search"] = r"""
WITH words AS (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
filled AS (SELECT row, doc_id, w, len(w)::BIGINT AS n FROM words WHERE len(w) > 0),
totals AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS length FROM filled),
asked AS (
  SELECT row_number() OVER () AS item, item_id, unnest(list_distinct(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))) AS term FROM benchmark),
occurring AS (
  SELECT row, term, count(*)::BIGINT AS tf FROM (SELECT row, unnest(w) AS term FROM filled)
  WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
weights AS (
  SELECT term, floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS weight
  FROM occurring, totals GROUP BY term),
scored AS (
  SELECT item, any_value(item_id) AS item_id, f.row, any_value(f.doc_id) AS doc_id,
    sum(weight * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * docs) // length))))::BIGINT AS score
  FROM asked JOIN weights USING (term) JOIN occurring o USING (term) JOIN filled f ON f.row = o.row, totals
  GROUP BY item, f.row),
ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score
  FROM scored WHERE score > 0)
SELECT * FROM ranked WHERE rank <= 50
"""


def op12_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with the words that benchmark items hold as well."""
    found = contamination.scan(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


QUERIES["op12_decontamination"] = op12_decontamination
SQL["op12_decontamination"] = r"""
WITH docs AS (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
asked AS (
  SELECT item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, list_aggregate(w[i:i + 9], 'string_agg', ' ') AS g
  FROM asked, unnest(range(1, greatest(len(w) - 8, 2))) AS r(i) WHERE len(w) > 0),
placed AS (
  SELECT row, n, i, list_aggregate(w[i:i + n - 1], 'string_agg', ' ') AS g
  FROM docs, (SELECT DISTINCT n FROM windows), unnest(range(1, len(w) - n + 2)) AS r(i)),
found AS (SELECT row, p.n, i, item_id FROM placed p JOIN windows v ON p.g = v.g AND p.n = v.n),
hit AS (SELECT row, count(DISTINCT k) AS n_hit FROM (SELECT row, unnest(range(i, i + n)) AS k FROM found) GROUP BY row),
named AS (
  SELECT row, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
  FROM (SELECT DISTINCT row, item_id FROM found) GROUP BY row)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit USING (row) LEFT JOIN named USING (row)
"""


def op13_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    """How the sources of each language differ from one another and from the language."""
    return divergence.audit(_table(spark, folder, "documents"))


QUERIES["op13_source_divergence"] = op13_source_divergence
SQL["op13_source_divergence"] = r"""
WITH docs AS (
  SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
words AS (SELECT row, lang, source, unnest(w) AS term FROM docs),
kept AS (
  SELECT lang, term, count(*)::HUGEINT AS in_lang FROM words GROUP BY ALL HAVING count(DISTINCT row) >= 30),
sizes AS (SELECT lang, count(*)::HUGEINT AS v, sum(in_lang)::HUGEINT AS all_lang FROM kept GROUP BY lang),
used AS (
  SELECT w.lang, source, w.term, count(*)::HUGEINT AS n FROM words w JOIN kept USING (lang, term) GROUP BY ALL),
groups AS (SELECT DISTINCT lang, source FROM docs),
totals AS (SELECT lang, source, sum(n)::HUGEINT AS all_group FROM used GROUP BY ALL),
filled AS (
  SELECT g.lang, g.source, k.term, coalesce(n, 0) AS n,
    (1 + (1000000000::HUGEINT * (coalesce(n, 0) + 5)) // (coalesce(all_group, 0) + 5 * v))::BIGINT AS p,
    (1 + (1000000000::HUGEINT * (in_lang + 5)) // (all_lang + 5 * v))::BIGINT AS q
  FROM groups g JOIN kept k USING (lang) JOIN sizes USING (lang) LEFT JOIN totals t USING (lang, source)
  LEFT JOIN used u ON u.lang = g.lang AND u.source = g.source AND u.term = k.term),
sums AS (
  SELECT x.lang, x.source, y.source AS item, sum(abs(x.p - y.p))::BIGINT AS value
  FROM filled x JOIN filled y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL),
every AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, p - q FROM filled WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank FROM every)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 50
"""


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    """All stages of the corpus pipeline."""
    return corpus_pipeline.run(spark, folder)


QUERIES["pipeline"] = pipeline
if corpus_pipeline.ORACLE_SQL:
    SQL["pipeline"] = corpus_pipeline.ORACLE_SQL
