"""Bibliographic inputs derived from the generic test tables.

The test tables hold invented prose and a star schema. These views spell their
rows as records, library lists, judgements and landed API answers, so that the
operators run over all rows and whole texts. ``*_SQL`` are the same views in
the SQL of the checking engine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


# Phrases mixed into titles so that every rule meets cases that fire.
LEADS = (
    "", "", "", "", "Recent ", "Review of ", "4-", "Correction: ", "", "Conference ",
    "An overview of ", "", "",
)
PHRASES = (
    "",
    "",
    "",
    "",
    "",
    "unnatural amino acid norvaline",
    "non-natural amino acid by transaminase",
    "noncanonical amino acid fed-batch fermentation amino acid",
    "ncAA by asymmetric synthesis",
    "non-proteinogenic amino acid precursor supply",
    "D-ornithine and Norvaline",
    "4-fluorophenylalanine (para-fluorophenylalanine)",
    "soil software for patient cohort",
    "enzymatic catalysis",
    "L-ornithine, citrulline; 3-fluorotyrosine",
    "(Cover Feature 12/2024)",
    "amber suppression with pyrrolysyl-tRNA",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(values, index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def _case(key: Column, *arms) -> Column:
    out = F.lit(arms[-1]) if isinstance(arms[-1], str) else arms[-1]
    for position, arm in reversed(list(enumerate(arms[:-1]))):
        out = F.when(key == position, F.lit(arm) if isinstance(arm, str) else arm).otherwise(out)
    return out


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records_of(table(spark, sf_dir, "documents"))


def records_of(documents: DataFrame) -> DataFrame:
    """One record per document: repeated DOIs, repeated titles, dates of many forms."""
    doc = F.col("doc_id")
    lead = F.substring_index(F.substring_index("text", "\n", 1), ".", 1)
    size = F.length(lead)
    number = F.when(doc % 10 == 3, doc - 1).when(doc % 100 == 57, F.lit(7)).otherwise(doc)
    doi = (
        F.when(doc % 37 == 0, F.lit(""))
        .when(doc % 41 == 0, F.lit("bad-doi"))
        .otherwise(
            F.concat(
                _case(doc % 4, "https://doi.org/", "DOI:", ""),
                F.lit("10.5555/"),
                F.when(doc % 2 == 0, F.lit("DOC.")).otherwise(F.lit("doc.")),
                number.cast("string"),
                F.when(doc % 29 == 0, F.lit("/review")).otherwise(F.lit("")),
            )
        )
    )
    year = (2015 + doc % 10).cast("string")
    month = (1 + doc % 12).cast("string")
    pub_date = _case(
        doc % 8,
        F.concat(year, F.lit("-"), month),
        F.concat(year, F.lit("-Mar-05")),
        year,
        "In Press",
        "",
        F.concat(F.lit("Winter "), year, F.lit("/"), month),
        F.concat(year, F.lit("."), month, F.lit(".7")),
        F.concat(month, F.lit(" Sep "), year),
    )
    return documents.select(
        doc.alias("ingest_seq"),
        F.when(doc % 2 == 0, F.lit("pubmed")).otherwise(F.lit("crossref")).alias("source"),
        F.when(doc % 2 == 0, (doc - doc % 6).cast("string")).otherwise(F.lit("")).alias("pmid"),
        doi.alias("doi"),
        F.concat(
            _pick(LEADS, F.floor(size / 7) % len(LEADS)), lead, F.lit(" "), _pick(PHRASES, size % len(PHRASES))
        ).alias("title"),
        F.col("source").alias("journal"),
        pub_date.alias("pub_date"),
        F.col("text").alias("abstract"),
        _case(
            doc % 6,
            "Journal Article",
            "journal article",
            "Journal-Article; Comment",
            "Editorial",
            "",
            "Journal Article; Meta-Analysis",
        ).alias("publication_types"),
        _case(
            doc % 7, "pathway", "enzymatic", "fermentation", "chemical", "hybrid", "GCE ", ""
        ).alias("track"),
    )


def _sql_list(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


RECORDS_SQL = f"""
SELECT doc_id AS ingest_seq,
  CASE WHEN doc_id % 2 = 0 THEN 'pubmed' ELSE 'crossref' END AS source,
  CASE WHEN doc_id % 2 = 0 THEN CAST(doc_id - doc_id % 6 AS VARCHAR) ELSE '' END AS pmid,
  CASE WHEN doc_id % 37 = 0 THEN '' WHEN doc_id % 41 = 0 THEN 'bad-doi'
    ELSE concat(CASE doc_id % 4 WHEN 0 THEN 'https://doi.org/' WHEN 1 THEN 'DOI:' ELSE '' END,
      '10.5555/', CASE WHEN doc_id % 2 = 0 THEN 'DOC.' ELSE 'doc.' END,
      CAST(CASE WHEN doc_id % 10 = 3 THEN doc_id - 1 WHEN doc_id % 100 = 57 THEN 7 ELSE doc_id END AS VARCHAR),
      CASE WHEN doc_id % 29 = 0 THEN '/review' ELSE '' END) END AS doi,
  concat({_sql_list(LEADS)}[1 + (length(lead) // 7) % {len(LEADS)}], lead, ' ',
    {_sql_list(PHRASES)}[1 + length(lead) % {len(PHRASES)}]) AS title,
  source AS journal,
  CASE doc_id % 8
    WHEN 0 THEN concat(y, '-', m) WHEN 1 THEN concat(y, '-Mar-05') WHEN 2 THEN y WHEN 3 THEN 'In Press'
    WHEN 4 THEN '' WHEN 5 THEN concat('Winter ', y, '/', m) WHEN 6 THEN concat(y, '.', m, '.7')
    ELSE concat(m, ' Sep ', y) END AS pub_date,
  text AS abstract,
  CASE doc_id % 6 WHEN 0 THEN 'Journal Article' WHEN 1 THEN 'journal article'
    WHEN 2 THEN 'Journal-Article; Comment' WHEN 3 THEN 'Editorial' WHEN 4 THEN ''
    ELSE 'Journal Article; Meta-Analysis' END AS publication_types,
  CASE doc_id % 7 WHEN 0 THEN 'pathway' WHEN 1 THEN 'enzymatic' WHEN 2 THEN 'fermentation'
    WHEN 3 THEN 'chemical' WHEN 4 THEN 'hybrid' WHEN 5 THEN 'GCE ' ELSE '' END AS track
FROM (SELECT *, split_part(split_part(text, chr(10), 1), '.', 1) AS lead,
  CAST(2015 + doc_id % 10 AS VARCHAR) AS y, CAST(1 + doc_id % 12 AS VARCHAR) AS m FROM documents)
"""


def known_lists(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """DOI lists of the library, of an extra source and of earlier outputs."""
    item, label, conv = F.col("item_id"), F.col("doc_id"), F.col("conv_id")
    return {
        "master": table(spark, sf_dir, "benchmark").select(
            F.concat(F.lit("https://dx.doi.org/10.5555/DOC."), (item * 7).cast("string")).alias("DOI")
        ),
        "extra": table(spark, sf_dir, "labels").select(
            F.when(label % 5 == 0, F.concat(F.lit(" doi:10.5555/lab."), label.cast("string")))
            .otherwise(F.lit(""))
            .alias("DOI")
        ),
        "outputs": table(spark, sf_dir, "conversations").select(
            F.concat(F.lit("10.5555/doc."), (conv * 11).cast("string")).alias("DOI")
        ),
    }


KNOWN_SQL = {
    "master": "SELECT concat('https://dx.doi.org/10.5555/DOC.', item_id * 7) AS doi FROM benchmark",
    "extra": "SELECT CASE WHEN doc_id % 5 = 0 THEN concat(' doi:10.5555/lab.', doc_id) ELSE '' END AS doi FROM labels",
    "outputs": "SELECT concat('10.5555/doc.', conv_id * 11) AS doi FROM conversations",
}


def library_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The library's DOI list: customers' numbers, once per order, as documents spell them."""
    number = F.col("o_custkey") * 2
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("https://doi.org/10.5555/LIB."), number.cast("string")).alias("DOI")
    )


LIBRARY_SQL = "SELECT concat('https://doi.org/10.5555/LIB.', o_custkey * 2) AS doi FROM orders"


def library_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles, journals and years of the library's DOIs."""
    return records(spark, sf_dir).select(
        "ingest_seq",
        F.concat(F.lit("https://doi.org/10.5555/LIB."), F.col("ingest_seq").cast("string")).alias("DOI"),
        "title",
        "journal",
        F.col("pub_date").alias("year"),
    )


def judgements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Screening judgements of the labelled documents, two per document in turn."""
    doc, quality, toxic = F.col("doc_id"), F.col("quality"), F.col("toxic")
    first = table(spark, sf_dir, "labels").select(
        (doc * 2).alias("ingest_seq"),
        F.concat(F.lit("10.5555/doc."), doc.cast("string")).alias("doi"),
        _case(doc % 5, "review", "Research_Article", "editorial_comment_letter", "other", "odd").alias(
            "article_type"
        ),
        F.when(toxic == 1, F.lit("False")).otherwise(F.lit("True")).alias("domain_relevant"),
        _case(doc % 3, "yes", "no", "unclear").alias("has_experiment"),
        _case(doc % 3, " Yes", "no", "maybe").alias("has_pathway_or_synthesis"),
        F.when(quality == 1, F.lit("true")).otherwise(F.lit("false")).alias("pass_filter"),
        F.concat(F.lit(" line\nof "), doc.cast("string"), F.lit(" ")).alias("rationale_zh"),
        _case(doc % 4, "GCE", "both", "hybrid ", "nothing").alias("category"),
        _case(doc % 4, "Enzymatic", "none", "none of these", "").alias("synthesis_method"),
        F.when(doc % 2 == 0, F.lit("nan")).otherwise(F.lit("norvaline\r\nNva")).alias("compound_name"),
    )
    again = first.filter(F.col("pass_filter") == "true").select(
        *[
            (F.col("ingest_seq") + 1).alias("ingest_seq")
            if c == "ingest_seq"
            else F.lit("second look").alias(c)
            if c == "rationale_zh"
            else F.col(c)
            for c in first.columns
        ]
    )
    return first.unionByName(again)


JUDGEMENTS_SQL = """
WITH one AS (SELECT doc_id * 2 AS ingest_seq, concat('10.5555/doc.', doc_id) AS doi,
  CASE doc_id % 5 WHEN 0 THEN 'review' WHEN 1 THEN 'Research_Article' WHEN 2 THEN 'editorial_comment_letter'
    WHEN 3 THEN 'other' ELSE 'odd' END AS article_type,
  CASE WHEN toxic = 1 THEN 'False' ELSE 'True' END AS domain_relevant,
  CASE doc_id % 3 WHEN 0 THEN 'yes' WHEN 1 THEN 'no' ELSE 'unclear' END AS has_experiment,
  CASE doc_id % 3 WHEN 0 THEN ' Yes' WHEN 1 THEN 'no' ELSE 'maybe' END AS has_pathway_or_synthesis,
  CASE WHEN quality = 1 THEN 'true' ELSE 'false' END AS pass_filter,
  concat(' line', chr(10), 'of ', doc_id, ' ') AS rationale_zh,
  CASE doc_id % 4 WHEN 0 THEN 'GCE' WHEN 1 THEN 'both' WHEN 2 THEN 'hybrid ' ELSE 'nothing' END AS category,
  CASE doc_id % 4 WHEN 0 THEN 'Enzymatic' WHEN 1 THEN 'none' WHEN 2 THEN 'none of these' ELSE '' END AS synthesis_method,
  CASE WHEN doc_id % 2 = 0 THEN 'nan' ELSE concat('norvaline', chr(13), chr(10), 'Nva') END AS compound_name
FROM labels)
SELECT * FROM one
UNION ALL SELECT ingest_seq + 1, doi, article_type, domain_relevant, has_experiment, has_pathway_or_synthesis,
  pass_filter, 'second look', category, synthesis_method, compound_name FROM one WHERE pass_filter = 'true'
"""
