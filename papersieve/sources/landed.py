"""Landed API answers: article XML and search-result JSON, one record per row."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..arrow import slices, tidy
from ..functions.dates import join_date_parts
from ..functions.text import html_unescape, strip
from ..schema import BASE_COLUMNS

ARTICLE_END = "</PubmedArticle>"

# The parts of a search-result item that become a record.
ITEM_SCHEMA = T.StructType(
    [
        T.StructField("DOI", T.StringType()),
        T.StructField("title", T.ArrayType(T.StringType())),
        T.StructField("container-title", T.ArrayType(T.StringType())),
        *[
            T.StructField(
                name,
                T.StructType([T.StructField("date-parts", T.ArrayType(T.ArrayType(T.IntegerType())))]),
            )
            for name in ("published", "published-print", "published-online")
        ],
        T.StructField("type", T.StringType()),
    ]
)
ANSWER_SCHEMA = T.StructType(
    [
        T.StructField(
            "message",
            T.StructType(
                [
                    T.StructField("total-results", T.LongType()),
                    T.StructField("next-cursor", T.StringType()),
                    T.StructField("items", T.ArrayType(ITEM_SCHEMA)),
                ]
            ),
        )
    ]
)
ARTICLE_SCHEMA = "pmid string, doi string, title string, journal string, pub_date string, abstract string, publication_types string"


# --- JSON ------------------------------------------------------------------------


def _first(values: Column) -> Column:
    return F.coalesce(F.get(values, 0), F.lit(""))


def item_record(item: Column) -> list[Column]:
    """Record columns of a parsed item struct."""
    dated = F.coalesce(item["published"], item["published-print"], item["published-online"])
    parts = F.get(dated["date-parts"], 0)
    kind = F.replace(F.coalesce(item["type"], F.lit("")), F.lit("-"), F.lit(" "))
    values = {
        "source": F.lit("crossref"),
        "pmid": F.lit(""),
        "doi": strip(F.coalesce(item["DOI"], F.lit(""))),
        "title": html_unescape(_first(item["title"])),
        "journal": html_unescape(_first(item["container-title"])),
        "pub_date": join_date_parts(parts),
        "abstract": F.lit(""),
        "publication_types": kind,
    }
    return [values[c].alias(c) for c in BASE_COLUMNS]


def parse_items(table: DataFrame, raw: str = "raw", keep: tuple[str, ...] = ()) -> DataFrame:
    """Records of a table with one item (JSON text) per row; items without a DOI are dropped."""
    parsed = table.withColumn("_item", F.from_json(raw, ITEM_SCHEMA))
    return parsed.select(*keep, *item_record(F.col("_item"))).filter(F.col("doi") != "")


def read_answers(spark: SparkSession, path: str) -> DataFrame:
    """Records of landed answer pages (one JSON document per line)."""
    pages = spark.read.schema(ANSWER_SCHEMA).json(path)
    items = pages.select(F.explode("message.items").alias("_item"))
    return items.select(*item_record(F.col("_item"))).filter(F.col("doi") != "")


# --- XML -------------------------------------------------------------------------


def parse_articles(table: DataFrame, raw: str = "raw", keep: tuple[str, ...] = ()) -> DataFrame:
    """Records of a table with one article element (XML text) per row.

    Mixed content and labelled abstract sections need a tree, which no built-in
    keeps whole, so batches of articles are parsed in Python. The DOI is
    taken from the article's own id list, never from its references. Articles
    that are not well-formed are dropped; ``malformed`` counts them.
    """
    import xml.etree.ElementTree as ET

    def inner(node) -> str:
        return "".join(node.itertext()).strip() if node is not None else ""

    def date_of(article) -> str:
        for path in (".//PubDate", ".//ArticleDate"):
            node = article.find(path)
            if node is None:
                continue
            parts = [(node.findtext(p) or "").strip() for p in ("Year", "Month", "Day")]
            if parts[0]:
                return "-".join(p for p in parts if p)
        return ""

    def doi_of(article) -> str:
        cited = {e for refs in article.iter("ReferenceList") for e in refs.iter("ArticleId")}
        own = (e for e in article.iter("ArticleId") if e not in cited)
        return next(((e.text or "").strip() for e in own if e.get("IdType") == "doi"), "")

    def sections(article) -> str:
        texts = [(e.get("Label") or "", inner(e)) for e in article.findall(".//Abstract/AbstractText")]
        return "\n".join(f"{label}: {body}" if label else body for label, body in texts if body)

    def fields(raw_xml):
        try:
            article = ET.fromstring(raw_xml)
        except (ET.ParseError, TypeError):
            return (None,) * 7
        types = article.findall(".//PublicationTypeList/PublicationType")
        return (
            article.findtext(".//PMID") or "",
            doi_of(article),
            inner(article.find(".//ArticleTitle")),
            article.findtext(".//Journal/Title") or "",
            date_of(article),
            sections(article),
            "; ".join(inner(t) for t in types),
        )

    names = ["pmid", "doi", "title", "journal", "pub_date", "abstract", "publication_types"]

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_raw"):
            found = list(zip(*(fields(v.as_py()) for v in batch["_raw"])))
            out = pa.RecordBatch.from_arrays(
                [*(batch[c] for c in keep), *(pa.array(values, pa.string()) for values in found)], [*keep, *names]
            )
            yield out.filter(out["pmid"].is_valid())

    # A map over batches runs once per row; a UDF in a projection could be
    # evaluated again for every filter on its result. Slices bound what a task holds by bytes, whatever the rows of a batch.
    source = table.select(*keep, F.col(raw).alias("_raw"))
    kept = [f"{f.name} {f.dataType.simpleString()}" for f in source.schema.fields[:-1]]
    parsed = source.mapInArrow(tidy(parse), ", ".join([*kept, ARTICLE_SCHEMA]))
    return parsed.withColumn("source", F.lit("pubmed")).select(*keep, *BASE_COLUMNS)


def malformed(table: DataFrame, raw: str = "raw") -> DataFrame:
    """One row: articles of a table, and how many of them are not well-formed."""
    import xml.etree.ElementTree as ET

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "raw"):
            broken = 0
            for value in batch["raw"]:
                try:
                    ET.fromstring(value.as_py())
                except (ET.ParseError, TypeError):
                    broken += 1
            yield pa.RecordBatch.from_pydict({"articles": [batch.num_rows], "malformed": [broken]})

    counted = table.select(F.col(raw).alias("raw")).mapInArrow(tidy(count), "articles long, malformed long")
    zero = F.lit(0).cast("long")
    return counted.agg(F.coalesce(F.sum("articles"), zero).alias("articles"), F.coalesce(F.sum("malformed"), zero).alias("malformed"))


def article_texts(spark: SparkSession, path: str) -> DataFrame:
    """The article elements (XML text, ``raw``) of landed files of any size."""
    rows = spark.read.option("lineSep", ARTICLE_END).text(path)
    body = F.regexp_extract("value", r"(?s)(<PubmedArticle[ >].*)$", 1)
    return rows.select(F.concat(body, F.lit(ARTICLE_END)).alias("raw"), body.alias("_body")).filter(F.col("_body") != "").select("raw")


def read_articles(spark: SparkSession, path: str) -> DataFrame:
    """Records of landed XML files of any size.

    The end tag serves as the line separator, so Spark splits large files and no
    task holds more than one article at a time.
    """
    return parse_articles(article_texts(spark, path))
