"""The registered queries of this subpackage and the SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage, work_path
from . import (
    decontamination,
    html_text,
    jaccard_join,
    language,
    neighbours,
    packing,
    periodic,
    quality,
    spelling,
    token_files,
    toxicity,
    url_filter,
    warc,
)
from .base import table
from .encoding import public_tokenizer
from .sampling import fold, outside_fold

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizer("byte_bpe_50k.json"), capacity=2048, end_id=0, release=True)


def _held_out(rows: DataFrame, folds: int, held: int) -> DataFrame:
    out = F.coalesce(fold(F.col("doc_id"), folds) == held, F.lit(False))
    return rows.select("doc_id", out.alias("held_out"), *[c for c in rows.columns if c != "doc_id"])


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = quality.fit(documents, outside_fold(table(spark, sf_dir, "labels"), 3, 1))
    return _held_out(quality.score(documents, model), 3, 1)


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join(table(spark, sf_dir, "documents"))


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = work_path(spark, "token-ids")
    documents = table(spark, sf_dir, "documents")
    shards = cut_lineage(token_files.write(documents, folder, public_tokenizer("word_bpe_49k.json"), end_id=1))
    return token_files.digest(token_files.read(spark, shards), token_files.starts(shards))


URL_RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), size=10)
    return found.drop("mark")


OP8_SQL = f"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+') AS w
  FROM documents),
iw AS (
  SELECT item_id, regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+') AS w
  FROM benchmark WHERE text IS NOT NULL AND item_id IS NOT NULL),
windows AS (
  SELECT DISTINCT item_id, array_to_string(w[i : i + 9], ' ') AS g, 10 AS n FROM iw, unnest(range(1, len(w) - 8)) AS t(i) WHERE len(w) >= 10
  UNION SELECT item_id, array_to_string(w, ' '), len(w) FROM iw WHERE len(w) BETWEEN 1 AND 9),
sizes AS (SELECT DISTINCT n FROM windows),
places AS (
  SELECT doc_id, i, n, array_to_string(w[i : i + n - 1], ' ') AS g FROM dw, sizes, unnest(range(1, len(w) - n + 2)) AS t(i)),
hits AS (SELECT p.doc_id, p.i, p.n, x.item_id FROM places p JOIN windows x ON p.g = x.g AND p.n = x.n),
hit_words AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
hit_items AS (
  SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  coalesce(items, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw d LEFT JOIN hit_words h ON d.doc_id = h.doc_id LEFT JOIN hit_items t ON d.doc_id = t.doc_id
"""


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    lexicon = toxicity.fit(documents, outside_fold(table(spark, sf_dir, "labels"), 5, 0))
    return _held_out(toxicity.score(documents, lexicon), 5, 0)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = language.fit(outside_fold(documents, 5, 0))
    return _held_out(language.identify(documents, model), 5, 0)


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "action string, host string, path string")
    return url_filter.judge(table(spark, sf_dir, "pages"), rules)


OP6_SQL = f"""
WITH split AS (
  SELECT page_id, CASE WHEN strpos(coalesce(url, ''), '://') > 0
    THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM split),
ruled AS (
  SELECT *, CASE
    WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule FROM parts)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict FROM ruled
"""


def op7_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return neighbours.nearest(vectors.filter("vec_id % 20 = 0"), vectors, k=20)


OP7_SQL = """
WITH v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 20 = 0),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.collapse(periodic.planted(table(spark, sf_dir, "documents")))
    line = lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n"))
    best = found.withColumn("_best", periodic.strongest(F.col("runs")))
    part = lambda name: F.col(f"_best.{name}").alias(name)
    return best.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        part("start"),
        part("length"),
        part("period"),
        F.expr("1000 * _best.length div _best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    captured = warc.capture(table(spark, sf_dir, "pages"), work_path(spark, "warc-captured"))
    records = warc.resolve(warc.deduplicate(captured, work_path(spark, "warc"), least=100))
    return records.select(
        F.col("key").cast("long").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to_key").cast("long").alias("refers_to"),
    )


OP12_SQL = """
WITH p AS (
  SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
r AS (
  SELECT *, row_number() OVER (PARTITION BY payload_digest ORDER BY page_id) AS place,
    first_value(page_id) OVER (PARTITION BY payload_digest ORDER BY page_id) AS original FROM p)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND place > 1 THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND place > 1 THEN original END AS refers_to FROM r
"""


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spelling.damaged(spelling.letter_runs(table(spark, sf_dir, "documents")))
    return spelling.group(spelling.vocabulary(words))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_best_fit_packing": op1_best_fit_packing,
        "op2_quality_classifier": op2_quality_classifier,
        "op3_jaccard_join": op3_jaccard_join,
        "op4_html_text": op4_html_text,
        "op5_token_files": op5_token_files,
        "op6_url_filter": op6_url_filter,
        "op7_nearest_neighbours": op7_nearest_neighbours,
        "op8_decontamination": op8_decontamination,
        "op9_toxicity": op9_toxicity,
        "op10_language_id": op10_language_id,
        "op11_periodic_runs": op11_periodic_runs,
        "op12_warc": op12_warc,
        "op13_spelling_variants": op13_spelling_variants,
        "pipeline": pipeline,
    }


def oracle_sql() -> dict[str, str]:
    return {"op6_url_filter": OP6_SQL, "op7_nearest_neighbours": OP7_SQL, "op8_decontamination": OP8_SQL, "op12_warc": OP12_SQL}
