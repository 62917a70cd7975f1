"""The registered queries of this folder and their check SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (decontaminate, exact_dedup, html_text, language_id, licenses, line_dedup, mixing, negatives, ngram_join,
               phrases, quality, repeats, url_rules)

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _fold(n: int):
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % n


def op1_language_id(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents")
    held_out = F.coalesce(_fold(3) == 1, F.lit(False))
    model = language_id.train(docs.where(~held_out))
    return language_id.predict(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op2_suffix_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return repeats.repeated_passages(_table(spark, sf, "documents"))


def op3_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return line_dedup.without_boilerplate(_table(spark, sf, "documents"), min_sites=10)


OP3_SQL = r"""
WITH docs AS (SELECT *, row_number() OVER () AS row FROM documents),
lines AS (
  SELECT row, source, generate_subscripts(string_split(text, chr(10)), 1) AS place,
         unnest(string_split(text, chr(10))) AS line
  FROM docs WHERE text IS NOT NULL),
trimmed AS (SELECT *, trim(line, ' ' || chr(9) || chr(13) || chr(11) || chr(12)) AS bare FROM lines),
boilerplate AS (
  SELECT bare FROM trimmed WHERE bare != '' GROUP BY bare HAVING count(DISTINCT source) >= 10),
marked AS (SELECT t.*, b.bare IS NOT NULL AS gone FROM trimmed t LEFT JOIN boilerplate b USING (bare)),
texts AS (
  SELECT row, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed,
         coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '') AS text
  FROM marked GROUP BY row)
SELECT d.doc_id, coalesce(t.n_lines, 0) AS n_lines, coalesce(t.n_removed, 0) AS n_removed, t.text
FROM docs d LEFT JOIN texts t USING (row)
"""


def op4_quality(spark: SparkSession, sf: str) -> DataFrame:
    docs, labels = _table(spark, sf, "documents"), _table(spark, sf, "labels")
    held_out = F.coalesce(_fold(5) == 0, F.lit(False))
    weights = quality.train(docs, labels.where(~held_out))
    return quality.score(docs, weights).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op5_license_scan(spark: SparkSession, sf: str) -> DataFrame:
    return licenses.scan(_table(spark, sf, "documents"))


def op6_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return exact_dedup.exact_groups(_table(spark, sf, "documents"), keep="largest").drop("row")


OP6_SQL = f"""
WITH t AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), '{UPPER}', '{LOWER}')) AS text_sha256
  FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, text_sha256
FROM t WINDOW g AS (PARTITION BY text_sha256)
"""


def op7_ngram_join(spark: SparkSession, sf: str) -> DataFrame:
    return ngram_join.near_groups(_table(spark, sf, "documents")).select(
        "doc_id", "n_shingles", "component_id")


def op8_mixing(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.mix(_table(spark, sf, "documents"))[1].select(
        "doc_id", "size", "source_size", "target", "taken")


OP8_SQL = r"""
WITH d AS (
  SELECT doc_id, source, md5(coalesce(doc_id::VARCHAR, '')) AS h,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         row_number() OVER (ORDER BY source IS NULL, source) - 1 AS sid
  FROM d GROUP BY source),
w AS (SELECT *, [3, 1, 2][sid % 3 + 1] AS weight FROM s),
c AS (
  SELECT *, sum(weight) OVER () AS all_weight, 1.5 * sum(source_size) OVER () AS total,
         coalesce(sum(2 * source_size) OVER b, 0) AS held, coalesce(sum(weight) OVER b, 0) AS gone
  FROM w WINDOW b AS (ORDER BY source_size / weight, sid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT *, (total - held)::DOUBLE / (all_weight - gone) AS level FROM c),
f AS (SELECT arg_min(level, source_size / weight) AS level FROM l WHERE 2 * source_size > level * weight),
q AS (
  SELECT source, source_size,
         round(least((2 * source_size)::DOUBLE, coalesce(f.level, 1e300) * weight), 6) AS target
  FROM w, f),
p AS (
  SELECT d.*, q.source_size, q.target, floor(q.target + 0.5)::BIGINT AS quota,
         coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY h, size, doc_id
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS first
  FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source)
SELECT doc_id, size, source_size, target,
       CASE WHEN size = 0 THEN 0 ELSE
         (quota // source_size) * size
         + greatest(0, least(size, quota % source_size - first)) END::BIGINT AS taken
FROM p
"""

def op9_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    return decontaminate.report(decontaminate.contamination(
        _table(spark, sf, "documents"), _table(spark, sf, "benchmark")))


OP9_SQL = fr"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
items AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n, w[k : k + least(10, len(w)) - 1] AS win
  FROM items, unnest(generate_series(1, len(w) - least(10, len(w)) + 1)) AS u(k) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM windows),
places AS (
  SELECT doc_id, n, k, w[k : k + n - 1] AS win
  FROM words, sizes, unnest(generate_series(1, len(w) - n + 1)) AS u(k)),
hits AS (SELECT p.doc_id, p.k, p.n, i.item_id FROM places p JOIN windows i ON p.n = i.n AND p.win = i.win),
n_hit AS (
  SELECT doc_id, count(DISTINCT x) AS n_hit
  FROM (SELECT DISTINCT doc_id, k, n FROM hits), unnest(generate_series(k, k + n - 1)) AS u(x) GROUP BY doc_id),
found AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items,
         string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
  FROM hits GROUP BY doc_id)
SELECT w.doc_id, len(w.w) AS n_words, coalesce(h.n_hit, 0) AS n_hit, coalesce(f.n_items, 0) AS n_items,
       sha256(coalesce(f.ids, '')) AS items_sha256, coalesce(h.n_hit, 0) > 0 AS contaminated
FROM words w LEFT JOIN n_hit h USING (doc_id) LEFT JOIN found f USING (doc_id)
"""

def op10_html_extraction(spark: SparkSession, sf: str) -> DataFrame:
    return html_text.main_text(_table(spark, sf, "pages")).withColumn(
        "n_chars", F.length("text").cast("long"))


def op11_hard_negatives(spark: SparkSession, sf: str) -> DataFrame:
    vectors = _table(spark, sf, "embeddings").withColumn("label", F.when(
        F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label")))
    return negatives.mine(vectors, F.col("vec_id") % 100 == 0)


OP11_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS c
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same,
         list_inner_product(a.c, b.c)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id != b.vec_id),
p AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5),
n AS (
  SELECT p.*, other AS negative_id, score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other) AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same
   AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5
"""


def op12_phrases(spark: SparkSession, sf: str) -> DataFrame:
    return phrases.collocations(_table(spark, sf, "documents"))


OP12_SQL = fr"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
grams AS (
  SELECT lang, k, unnest(list_transform(generate_series(1, len(w) - k + 1),
         lambda i: array_to_string(w[i : i + k - 1], ' '))) AS phrase
  FROM words, (VALUES (1), (2), (3)) AS s(k) WHERE len(w) >= k),
f AS (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k AS len, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k >= 2 AND f >= 10),
cuts AS (
  SELECT c.*, u.j, l.f AS l, r.f AS r, (1000000 * a::HUGEINT * a // (l.f::HUGEINT * r.f))::BIGINT AS score
  FROM c, unnest(generate_series(1, 2)) AS u(j)
  JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(w[1 : j], ' ')
  JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(w[j + 1 :], ' ')
  WHERE j < len),
best AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
inner_ AS (
  SELECT lang, a, unnest([array_to_string(w[1 : 2], ' '), array_to_string(w[2 : 3], ' ')]) AS phrase
  FROM c WHERE len = 3),
most AS (SELECT lang, phrase, max(a) AS most FROM inner_ GROUP BY ALL),
kept AS (
  SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, encode(b.phrase)) AS rank
  FROM best b LEFT JOIN most m ON m.lang = b.lang AND m.phrase = b.phrase
  WHERE m.most IS NULL OR 100 * m.most < 50 * a)
SELECT lang, rank, phrase, a, l, r, n, score FROM kept JOIN totals USING (lang) WHERE rank <= 2000
"""


#: (host, path, verdict)
URL_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
             ("com", "/fr/", "allow"), ("com", "/de/", "block")]
_RULES_SQL = "SELECT * FROM (VALUES " + ", ".join(map(str, URL_RULES)) + ") AS r(host, path, verdict)"


def op13_url_filter(spark: SparkSession, sf: str) -> DataFrame:
    return url_rules.judge(_table(spark, sf, "pages"), spark.sql(_RULES_SQL)).select(
        "page_id", "host", "path", "rule", "verdict")


OP13_SQL = fr"""
WITH rules AS ({_RULES_SQL}),
pages_ AS (
  SELECT row_number() OVER () AS row, page_id,
         translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), '{UPPER}', '{LOWER}') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM pages),
fits AS (
  SELECT p.row, r.host || r.path AS rule, r.verdict
  FROM pages_ p JOIN rules r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
  QUALIFY row_number() OVER (PARTITION BY p.row ORDER BY length(r.host || r.path) DESC, length(r.host) DESC,
                             r.verdict DESC) = 1)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM pages_ LEFT JOIN fits USING (row)
"""


QUERIES = {"op1_language_id": op1_language_id, "op2_suffix_dedup": op2_suffix_dedup,
           "op3_line_dedup": op3_line_dedup, "op4_quality": op4_quality,
           "op5_license_scan": op5_license_scan, "op6_exact_dedup": op6_exact_dedup, "op7_ngram_join": op7_ngram_join, "op8_mixing": op8_mixing,
           "op9_decontamination": op9_decontamination,
           "op10_html_extraction": op10_html_extraction, "op11_hard_negatives": op11_hard_negatives,
           "op12_phrases": op12_phrases,
           "op13_url_filter": op13_url_filter}
SQL = {"op11_hard_negatives": OP11_SQL, "op12_phrases": OP12_SQL, "op13_url_filter": OP13_SQL, "op3_line_dedup": OP3_SQL, "op6_exact_dedup": OP6_SQL, "op8_mixing": OP8_SQL, "op9_decontamination": OP9_SQL}
