"""Term tables: search names by group, and tag aliases with their canonical name.

Both are parameters of any size: ``search_term_table`` and ``alias_table`` read a user's tables
(paths ``search_term_table`` and ``alias_table`` of a configuration). Without a path a short starter list stands in.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Compound, canonical name, search group.
STARTER = (
    ("ornithine", "Orn", "lysine"),
    ("dimethyllysine", "Lys(Me2)", "lysine"),
    ("diaminopropionic acid", "Dap", "lysine"),
    ("diaminobutyric acid", "Dab", "lysine"),
    ("homoarginine", "hArg", "arginine"),
    ("citrulline", "Cit", "arginine"),
    ("homocitrulline", "h-Cit", "arginine"),
    ("asymmetric dimethylarginine", "ADMA", "arginine"),
    ("symmetric dimethylarginine", "SDMA", "arginine"),
    ("norvaline", "Nva", "aliphatic"),
    ("norleucine", "Nle", "aliphatic"),
    ("tert-leucine", "Tle", "aliphatic"),
    ("homoleucine", "hLeu", "aliphatic"),
    ("homoserine", "hSer", "aliphatic"),
    ("alpha-aminoisobutyric acid", "Aib", "aliphatic"),
    ("allylglycine", "Algly", "aliphatic"),
    ("propargylglycine", "Pra", "aliphatic"),
    ("methionine sulfone", "Met(O2)", "aliphatic"),
    ("phenylglycine", "Phg", "cyclic"),
    ("indanylglycine", "Igl", "cyclic"),
    ("biphenylalanine", "Bip", "aromatic"),
    ("homophenylalanine", "h-Phe", "aromatic"),
    ("benzothienylalanine", "Bta", "aromatic"),
    ("thienylalanine", "3-Thi", "aromatic"),
    ("3-fluorotyrosine", "3-F-Tyr", "aromatic"),
    ("hydroxyproline", "Hyp", "proline"),
    ("homoproline", "hPro", "proline"),
    ("pipecolic acid", "Pip", "proline"),
    ("azetidine-2-carboxylic acid", "Aze", "proline"),
    ("thiazolidine-4-carboxylic acid", "Thz", "proline"),
    ("methyltryptophan", "Me-Trp", "tryptophan"),
    ("boronoalanine", "Ala(B(OH)2)", "serine"),
    ("sarcosine", "Sar", "peptoid"),
    ("asparagine piperidine amide", "Asn(pip)", "amide"),
    ("beta-alanine", "bAla", "beta"),
    ("beta-aminobutyric acid", "3-Abu", "beta"),
    ("pyrrolysine", "Pyl", "gce"),
    ("phosphoserine", "Sep", "gce"),
    ("azidonorleucine", "ANL", "gce"),
    ("propargyllysine", "PrK", "gce"),
    ("3-nitrotyrosine", "3-NO2-Tyr", "gce"),
)
GROUPS = (
    "lysine", "arginine", "aliphatic", "cyclic", "aromatic", "proline", "tryptophan", "serine",
    "peptoid", "amide", "beta", "gce",
)

# A dictionary up to this size may be shipped as a literal with the plan.
LITERAL_ALIASES = 5_000


def starter_terms() -> dict[str, list[str]]:
    return {group: [name for name, _, own in STARTER if own == group] for group in GROUPS}


def starter_aliases() -> dict[str, str]:
    return {name.lower(): canonical for name, canonical, _ in STARTER}


def load_search_terms(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """Search names ``(grp, ord, term)`` from a user's table."""
    reader = spark.read.option("header", True).option("escape", '"')
    table = reader.format(fmt).load(path)
    return table.select("grp", F.col("ord").cast("int").alias("ord"), "term")


def load_aliases(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """Aliases ``(alias, canonical)`` from a user's table."""
    table = spark.read.option("header", True).option("escape", '"').format(fmt).load(path)
    return table.select(F.lower("alias").alias("alias"), "canonical")


def search_terms_frame(spark: SparkSession, terms: dict[str, Iterable[str]] | None = None) -> DataFrame:
    """Search names as a table ``(grp, grp_ord, ord, term)``."""
    terms = terms or starter_terms()
    rows = [
        (group, group_order, order, term)
        for group_order, (group, names) in enumerate(terms.items())
        for order, term in enumerate(names)
    ]
    return spark.createDataFrame(rows, "grp string, grp_ord int, ord int, term string")


def search_term_table(spark: SparkSession, path: str | None) -> dict[str, list[str]]:
    """Search names by group, in order (a configuration's size), from a user's table or the starter list."""
    if not path:
        return starter_terms()
    out: dict[str, list[str]] = {}
    for row in load_search_terms(spark, path).orderBy("ord").collect():
        out.setdefault(row["grp"], []).append(row["term"])
    return out


def alias_table(spark: SparkSession, path: str | None) -> DataFrame | dict[str, str]:
    """Aliases of a user's table, or the starter list."""
    return load_aliases(spark, path) if path else starter_aliases()
