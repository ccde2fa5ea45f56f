"""Registered queries of the pipeline operators: (spark, sf_dir) -> DataFrame, with DuckDB SQL where it can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from screensift.llm import conversations, cws, decontam, langid, license_scan, line_dedup, merkle, mixing, ngram_join, secret_scan, simhash, toxicity, warc
from screensift.llm.sql import merkle_sql, repair_sql
from screensift.sources.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _register(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn
    return add


@_register("op1_license_scan")
def op1_license_scan(spark, sf_dir):
    """Documents as files of a tree: source / language / hundred of ids; every third id one or two levels up."""
    level = F.pmod(F.coalesce("doc_id", F.lit(0)), F.lit(3))
    path = F.concat_ws("/", "source", F.when(level > 0, F.col("lang")), F.when(level > 1, F.expr("CAST(doc_id div 100 AS STRING)")),
                       F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))
    return license_scan.scan_licenses(table(spark, sf_dir, "documents").select("doc_id", path.alias("path"), "text"))


@_register("op2_secret_scan")
def op2_secret_scan(spark, sf_dir):
    """Owner: the source; repository: the source's documents of one language."""
    docs = table(spark, sf_dir, "documents")
    secrets = F.col("secrets")
    base = F.filter(secrets, lambda s: s["kind"] < 3)
    found = secret_scan.scan_secrets(docs, repository=F.concat_ws("/", "source", "lang"))
    return found.select(
        "doc_id", *[secret_scan.count_kind(secrets, k).alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.sha2(secret_scan.spans_text(base), 256).alias("base_sha256"), secret_scan.spans_text(secrets).alias("spans"),
        *[secret_scan.count_verdict(secrets, v).alias(f"n_{v}") for v in ("live", "shared", "example")])


@_register("op3_line_dedup", f"""
WITH lines AS (
  SELECT doc_id, source, pos, line, trim(regexp_replace(lower(line), '[ \\t\\x0B\\f\\r]+', ' ', 'g')) AS norm
  FROM (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line,
               unnest(range(len(string_split(text, chr(10))))) AS pos FROM documents)),
totals AS (SELECT source, count(*) AS host_pages FROM documents GROUP BY source),
drops AS (
  SELECT l.source, norm FROM lines l JOIN totals t ON l.source IS NOT DISTINCT FROM t.source
  WHERE norm <> '' GROUP BY l.source, norm, host_pages
  HAVING count(DISTINCT doc_id) >= {line_dedup.MIN_PAGES}
     AND count(DISTINCT doc_id)::DOUBLE / host_pages > {line_dedup.MAX_RATIO}),
marked AS (
  SELECT l.*, d.norm IS NOT NULL AS dropped
  FROM lines l LEFT JOIN drops d ON l.source IS NOT DISTINCT FROM d.source AND l.norm = d.norm)
SELECT d.doc_id, count(m.pos) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
       CASE WHEN count(m.pos) > 0 THEN coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '') END AS text
FROM documents d LEFT JOIN marked m USING (doc_id) GROUP BY d.doc_id
""")
def op3_line_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return line_dedup.drop_boilerplate(docs, counts=True).select(
        "doc_id", "n_lines", "n_dropped", "text")


@_register("op4_toxicity")
def op4_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity.toxicity(docs, table(spark, sf_dir, "labels")).drop("text").withColumnRenamed("rejected", "toxic")


@_register("op5_language_id")
def op5_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 0
    model = langid.train(docs.where(~held_out), key=F.col("doc_id"))
    return langid.predict(docs.select("doc_id", held_out.alias("held_out"), "text"), model)


@_register("op6_warc", f"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest
  FROM pages),
m AS (SELECT *, max(page_id) OVER (PARTITION BY html) AS response FROM p)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= {warc.MIN_DEDUP_BYTES} AND page_id <> response THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= {warc.MIN_DEDUP_BYTES} AND page_id <> response THEN response END AS refers_to
FROM m
""")
def op6_warc(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    archive = warc.archive_pages(spark, pages)
    wanted = pages.select(warc.url_key_column(F.col("url")).alias("url_key"))
    records = warc.read_records(archive.folder, warc.lookup(archive, wanted))
    return records.select(F.expr("try_cast(id AS bigint)").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                          F.col("refers_to").cast("bigint").alias("refers_to"))


@_register("op7_simhash")
def op7_simhash(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@_register("op8_decontamination", f"""
WITH lowered AS (
  SELECT 'd' AS kind, doc_id AS id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
  UNION ALL
  SELECT 'b', item_id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') FROM benchmark),
worded AS (SELECT kind, id, regexp_extract_all(coalesce(t, ''), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM lowered),
sizes AS (SELECT DISTINCT least(len(w), {decontam.WINDOW}) AS n FROM worded WHERE kind = 'b' AND len(w) > 0),
windows AS (
  SELECT DISTINCT id AS item_id, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS gram
  FROM (SELECT id, w, least(len(w), {decontam.WINDOW}) AS n, unnest(range(1, len(w) - least(len(w), {decontam.WINDOW}) + 2)) AS i
        FROM worded WHERE kind = 'b' AND len(w) > 0)),
grams AS (
  SELECT id AS doc_id, n, i, array_to_string(list_slice(w, i, i + n - 1), ' ') AS gram
  FROM (SELECT id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM worded, sizes WHERE kind = 'd' AND len(w) >= n)),
hits AS (SELECT doc_id, g.n, i, item_id FROM grams g JOIN windows x ON g.n = x.n AND g.gram = x.gram),
hit_words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
hit_items AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids
              FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM hits) GROUP BY doc_id)
SELECT d.id AS doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND {decontam.COVERAGE} * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM worded d LEFT JOIN hit_words h ON d.id = h.doc_id LEFT JOIN hit_items i ON d.id = i.doc_id WHERE kind = 'd'
""")
def op8_decontamination(spark, sf_dir):
    seen = decontam.contamination(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return seen.select("doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
                       F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


@_register("op9_mixing", f"""
WITH sizes AS (
  SELECT doc_id, coalesce('0' || source, '1') AS source_key, md5('{mixing.SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS key,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size FROM documents),
per AS (SELECT source_key, CAST(sum(size) AS BIGINT) AS source_size FROM sizes GROUP BY source_key),
weighed AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source_key) - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS weight,
         {mixing.MOST} * source_size AS cap FROM per),
levels AS (
  SELECT *, CAST(cap AS DOUBLE) / weight AS ratio,
         ({mixing.SHARE} * sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY CAST(cap AS DOUBLE) / weight, source_key
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(weight) OVER (ORDER BY CAST(cap AS DOUBLE) / weight, source_key ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighed),
targets AS (
  SELECT source_key, source_size, CASE WHEN ratio > level
           THEN max(CASE WHEN ratio > level THEN level END) OVER () * weight ELSE CAST(cap AS DOUBLE) END AS target FROM levels),
timed AS (
  SELECT s.*, source_size, target, sum(size) OVER (PARTITION BY s.source_key ORDER BY key, size) AS upto
  FROM sizes s JOIN targets USING (source_key)),
copies AS (
  SELECT doc_id, size, key, epoch, (epoch * source_size + upto)::DOUBLE / target AS finish
  FROM timed, (SELECT unnest(range({mixing.MOST})) AS epoch) WHERE size > 0 AND target > 0),
totals AS (SELECT *, sum(size) OVER (ORDER BY finish, key, epoch) AS total FROM copies),
kept AS (SELECT doc_id, CAST(sum(size) AS BIGINT) AS taken FROM totals
         WHERE total <= (SELECT {mixing.SHARE} * sum(source_size) FROM targets) GROUP BY doc_id)
SELECT doc_id, size, source_size, target, coalesce(taken, 0) AS taken FROM timed LEFT JOIN kept USING (doc_id)
""")
def op9_mixing(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents"))


@_register("op10_fingerprints")
def op10_fingerprints(spark, sf_dir):
    return cws.fingerprints(table(spark, sf_dir, "documents"))


@_register("op11_merkle", merkle_sql(merkle.FANOUT))
def op11_merkle(spark, sf_dir):
    """Tampering: the text's A-Z in lower case where 5 divides the CRC-32 of the id."""
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return merkle.manifest(table(spark, sf_dir, "documents"), presented={"text": F.when(tampered, lower).otherwise(F.col("text"))})


@_register("op12_conversations", repair_sql())
def op12_conversations(spark, sf_dir):
    return conversations.repair(table(spark, sf_dir, "conversations"), edits=conversations.damage())


@_register("op13_ngram_join")
def op13_ngram_join(spark, sf_dir):
    return ngram_join.jaccard_components(table(spark, sf_dir, "documents"))


@_register("pipeline", corpus_pipeline.ORACLE_SQL)
def pipeline(spark, sf_dir):
    return corpus_pipeline.run(spark, sf_dir)
