"""The registered queries of this subpackage: each operator over its whole table, and SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliospark.llm import decontaminate, divergence, fingerprint, language_id, license_scan, line_dedup, nearest, packing, periodic, sharding, simhash, token_grammar, warc
from foliospark.llm.common import ready
from foliospark.session import work_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ready(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op2_line_dedup", f"""
WITH lines AS (
  SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS place
  FROM documents WHERE text IS NOT NULL),
bare AS (SELECT *, trim(line, ' ' || chr(9) || chr(13)) AS b FROM lines),
totals AS (SELECT source, count(*) AS pages FROM documents GROUP BY source),
common AS (
  SELECT b.source, b.b FROM bare b JOIN totals t ON b.source IS NOT DISTINCT FROM t.source
  WHERE b.b <> '' GROUP BY b.source, b.b, t.pages
  HAVING count(DISTINCT b.doc_id) >= {line_dedup.MIN_PAGES} AND count(DISTINCT b.doc_id) > {line_dedup.MAX_RATIO} * t.pages),
marked AS (
  SELECT l.*, c.b IS NOT NULL AS gone FROM bare l LEFT JOIN common c ON l.source IS NOT DISTINCT FROM c.source AND l.b = c.b),
pages AS (
  SELECT doc_id, string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT gone) AS text, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped
  FROM marked GROUP BY doc_id)
SELECT d.doc_id, d.source, CASE WHEN d.text IS NOT NULL THEN coalesce(p.text, '') END AS text,
  coalesce(p.n_lines, 0)::BIGINT AS n_lines, coalesce(p.n_dropped, 0)::BIGINT AS n_dropped
FROM documents d LEFT JOIN pages p USING (doc_id)
""")
def op2_line_dedup(spark, sf_dir):
    out = line_dedup.drop_boilerplate(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "source", "text", F.col("n_lines").cast("bigint"), F.col("n_dropped").cast("bigint"))


@query("op3_sharding", f"""
WITH hashed AS (
  SELECT doc_id, octet_length(encode(coalesce(text, '')))::BIGINT AS bytes,
    ('0x' || substr(md5(concat_ws(chr(1), coalesce(doc_id::VARCHAR, chr(2)), coalesce(text, chr(2)), coalesce(lang, chr(2)), coalesce(source, chr(2)),
      coalesce(n_chars::VARCHAR, chr(2)))), 1, 15))::BIGINT AS hash
  FROM documents),
sums AS (
  SELECT doc_id, bytes, hash, d, sum(bytes) OVER (PARTITION BY d, hash >> (60 - d)) AS shard_bytes
  FROM hashed, range(0, 31) AS depths(d)),
first_fit AS (
  SELECT * FROM sums WHERE shard_bytes <= {sharding.LIMIT_BYTES} QUALIFY d = min(d) OVER (PARTITION BY doc_id))
SELECT doc_id, bytes, hash, CASE WHEN d = 0 THEN '' ELSE right(format('{{:060b}}', hash), 60)[1:d] END AS shard, d::BIGINT AS depth, shard_bytes::BIGINT AS shard_bytes
FROM first_fit
""")
def op3_sharding(spark, sf_dir):
    out = sharding.shard(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "bytes", "hash", "shard", F.col("depth").cast("bigint"), "shard_bytes")


_CANONICAL = """
lower_host || CASE WHEN path = '' THEN '/' ELSE path END || CASE WHEN q <> '' THEN '?' || q ELSE '' END"""


@query("op7_warc_revisits", rf"""
WITH visits AS (
  SELECT page_id, n, CASE WHEN n = 1 THEN CASE WHEN url LIKE 'https:%' THEN 'http:' || url[7:] ELSE regexp_replace(url, '^http:', 'https:') END || '#again' ELSE url END AS url,
    page_id * 10 + CASE n WHEN 0 THEN 0 WHEN 1 THEN 3600 ELSE -1 END AS ts, sha256(coalesce(html, '')) AS digest, octet_length(encode(coalesce(html, '')))::BIGINT AS size
  FROM pages, range(0, 3) AS v(n) WHERE n < 2 OR page_id % 4 = 0),
parts AS (
  SELECT *, regexp_replace(regexp_replace(regexp_replace(lower(regexp_extract(trim(url), '^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?', 2)), '^.*@', ''), ':(80|443)$', ''), '^www[0-9]*\.', '') AS lower_host,
    regexp_replace(regexp_extract(trim(url), '^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?', 3), '/+$', '') AS path,
    array_to_string(list_sort(list_filter(string_split(regexp_extract(trim(url), '^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?', 4), '&'),
      lambda p: p <> '' AND NOT regexp_matches(p, '^(utm_[^=]*|ref|fbclid|gclid|sessionid)(=.*)?$'))), '&') AS q
  FROM visits),
named AS (SELECT *, page_id * 3 + n AS record_id, {_CANONICAL} AS canonical_url FROM parts),
best AS (
  SELECT r.record_id, r.canonical_url, r.n, r.page_id, f.record_id AS refers_to, f.page_id AS of_page, f.digest, f.size, r.digest AS own
  FROM named r LEFT JOIN named f ON f.n = 0 AND f.canonical_url = r.canonical_url AND f.ts < r.ts WHERE r.n > 0
  QUALIFY row_number() OVER (PARTITION BY r.record_id ORDER BY f.ts DESC NULLS LAST, f.record_id DESC) = 1),
judged AS (
  SELECT *, CASE WHEN refers_to IS NULL THEN 'no_response'
    WHEN n = 1 AND page_id % 7 = 0 THEN 'unverified'
    WHEN n = 1 THEN CASE WHEN page_id % 5 <> 0 AND digest[1:16] = own[1:16] THEN 'etag' ELSE 'changed' END
    WHEN of_page % 50 = page_id % 50 THEN 'last_modified' ELSE 'changed' END AS outcome
  FROM best)
SELECT record_id, canonical_url, outcome, coalesce(refers_to, -1)::BIGINT AS refers_to, CASE WHEN outcome IN ('etag', 'last_modified') THEN digest END AS payload_sha256,
  CASE WHEN outcome IN ('etag', 'last_modified') THEN size ELSE -1 END AS payload_bytes,
  CASE outcome
    WHEN 'etag' THEN concat('cache-control: max-age=600', chr(10), 'content-length: ', size, chr(10), 'content-type: text/html', chr(10), 'etag: W/"', digest[1:16], '"', chr(10), 'last-modified: day ', of_page % 50)
    WHEN 'last_modified' THEN concat('cache-control: max-age=60', chr(10), 'content-length: ', size, chr(10), 'content-type: text/html', chr(10), 'etag: "', digest[1:16], '"', chr(10), 'expires: 0', chr(10), 'last-modified: day ', page_id % 50)
  END AS headers
FROM judged
""")
def op7_warc_revisits(spark, sf_dir):
    out = warc.resolve_revisits(warc.crawl_records(table(spark, sf_dir, "pages")))
    lines = F.transform("headers", lambda h: F.concat(h["name"], F.lit(": "), h["value"]))
    none = F.lit(-1).cast("bigint")  # no response or payload
    return out.select("record_id", "canonical_url", "outcome", F.coalesce("refers_to", none).alias("refers_to"), "payload_sha256", F.coalesce("payload_bytes", none).alias("payload_bytes"),
                      F.when(F.col("headers").isNotNull(), F.array_join(lines, "\n")).alias("headers"))


@query("op4_packing")
def op4_packing(spark, sf_dir):
    out = packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return out.select("doc_id", "piece", "start", F.col("length").cast("bigint"), "ids_crc32", "sequence_id", "offset")


@query("op10_token_grammar")
def op10_token_grammar(spark, sf_dir):
    path = f"{work_folder(spark)}/tokens"
    token_grammar.write_tokens(table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"))
    return token_grammar.document_digests(spark, path)


@query("op6_language_id")
def op6_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    out = language_id.identify(docs, language_id.fit(docs))
    return out.select("doc_id", language_id.held_out().alias("held_out"), "lang_pred", "score")


@query("op8_simhash")
def op8_simhash(spark, sf_dir):
    out = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", simhash.hexadecimal(F.col("fp")).alias("fingerprint"), "component_id")


@query("op9_fingerprints")
def op9_fingerprints(spark, sf_dir):
    out = fingerprint.fingerprints(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")


@query("op1_license_scan")
def op1_license_scan(spark, sf_dir):
    out = license_scan.scan(table(spark, sf_dir, "documents"))
    base = F.array_sort(F.array_distinct(F.transform("places", lambda p: p["label"])))
    every = F.array_sort(F.array_union(base, F.transform("notices", lambda m: m["label"])))
    at = F.transform("places", lambda p: p["at"])
    score = F.greatest(F.coalesce(F.array_max(F.transform("notices", lambda m: m["containment"])), F.lit(0.0)), F.when(F.size("places") > 0, 1.0).otherwise(0.0))
    return out.select("doc_id", "n_words", F.size("places").cast("bigint").alias("n_base"), F.array_min(at).alias("first_word"), F.array_max(at).alias("last_word"),
                      F.array_join(base, ",").alias("base_labels"), F.array_join(every, ",").alias("labels"), score.alias("score"))


@query("op5_decontamination")
def op5_decontamination(spark, sf_dir):
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op12_periodic_runs")
def op12_periodic_runs(spark, sf_dir):
    out = periodic.find(table(spark, sf_dir, "documents"), edit=periodic.planted).withColumn("best", periodic.strongest(F.col("runs")))
    lines = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n")))
    return out.select("doc_id", F.size("runs").cast("bigint").alias("n_runs"), "best.start", "best.length", "best.period",
                      F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
                      F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


_SHARE = "1 + (1000000000::HUGEINT * ({} + 2)) // ({} + 2 * v.terms)"


@query("op11_source_divergence", rf"""
WITH docs AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS found
  FROM documents),
words AS (SELECT r, lang, source, unnest(found) AS term FROM docs),
kept AS (SELECT lang, term, count(*) AS total FROM words GROUP BY lang, term HAVING count(DISTINCT r) >= {divergence.MIN_DOCS}),
counts AS (SELECT w.lang, w.source, w.term, count(*) AS n FROM words w JOIN kept k USING (lang, term) GROUP BY ALL),
sizes AS (SELECT lang, source, sum(n) AS n FROM counts GROUP BY ALL),
v AS (SELECT lang, count(*) AS terms, sum(total) AS n FROM kept GROUP BY lang),
sources AS (SELECT g.lang, g.source, coalesce(s.n, 0) AS n FROM (SELECT DISTINCT lang, source FROM docs) g LEFT JOIN sizes s USING (lang, source)),
cells AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, {_SHARE.format("coalesce(c.n, 0)", "g.n")} AS p, {_SHARE.format("k.total", "v.n")} AS q
  FROM sources g JOIN kept k USING (lang) JOIN v USING (lang) LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
sums AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM cells a JOIN cells b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(s.value, 0) AS value
  FROM sources a JOIN sources b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
over AS (SELECT lang, source, term AS item, (p - q) * (p - q) // (p + q) AS value FROM cells WHERE n > 0 AND p > q),
ranked AS (
  SELECT lang, source, 'pair' AS part, item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM pairs
  UNION ALL SELECT lang, source, 'term', item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) FROM over
  QUALIFY row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) <= {divergence.TOP_TERMS})
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM ranked
""")
def op11_source_divergence(spark, sf_dir):
    return divergence.audit(table(spark, sf_dir, "documents"))


@query("op13_nearest_vectors")
def op13_nearest_vectors(spark, sf_dir):
    return nearest.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)
