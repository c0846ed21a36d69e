"""Dictionary tagging: which known terms occur in a text as whole terms."""

from __future__ import annotations

import json
import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import escape_java, let
from ..lexicon import LITERAL_ALIASES
from ..schema import SEQ, text

# Characters that must not touch a term on either side.
GLUE = "a-zA-Z0-9-"
_RUN = re.compile(r"[a-z0-9-]+")


def anchor_of(alias: str) -> str:
    """The longest run of glue characters in an alias.

    A hit has no glue character on either side, so every run of the alias is a
    complete run of the text. One hash lookup per run of the text therefore
    finds every alias that can occur at all.
    """
    runs = _RUN.findall(alias.lower())
    return max(runs, key=len) if runs else ""


def alias_pattern(alias: str) -> str:
    return f"(?iu)(?<![{GLUE}]){escape_java(alias)}(?![{GLUE}])"


def ranked_aliases(aliases: Mapping[str, str]) -> list[tuple[str, str]]:
    """Longest alias first; equal lengths keep the order of the dictionary."""
    return sorted(aliases.items(), key=lambda item: -len(item[0]))


def record_text() -> Column:
    """Title and abstract as one text, empty parts left out."""
    part = lambda name: F.nullif(text(name), F.lit(""))
    return F.concat_ws(" ", part("title"), part("abstract"))


def _folded(subject: Column) -> Column:
    """Lower case, with the one letter outside ASCII that folds to an ASCII letter."""
    return F.replace(F.lower(subject), F.lit("ſ"), F.lit("s"))


def _runs(folded: Column) -> Column:
    return F.regexp_extract_all(folded, F.lit("([a-z0-9-]+)"), F.lit(1))


def tags(subject: Column, aliases: Mapping[str, str]) -> Column:
    """Canonical names found in ``subject`` as an array, in alias rank order.

    The dictionary travels as one literal index from anchors to their aliases. A text is split once and its
    runs are tested against a hash set of anchors; only the aliases of anchors that occur are looked at, so the cost per text hardly
    depends on the number of aliases. An alias that is a single run is then
    certain; any other is confirmed as a substring and by its pattern.
    """
    if len(aliases) > LITERAL_ALIASES:
        raise ValueError(
            f"{len(aliases)} aliases are too many for a literal; use tag"
        )
    index: dict[str, list[dict]] = {}
    for rank, (alias, canonical) in enumerate(ranked_aliases(aliases)):
        anchor = anchor_of(alias)
        if anchor:
            pattern = None if anchor == alias.lower() else alias_pattern(alias)
            index.setdefault(anchor, []).append({"rank": rank, "alias": alias.lower(), "pattern": pattern, "canonical": canonical})
    anchors = sorted(index)
    # One JSON literal, which the optimizer folds into a constant map.
    dictionary = F.from_json(
        F.lit(json.dumps(index)),
        "map<string,array<struct<rank:int,alias:string,pattern:string,canonical:string>>>",
    )
    none = F.array().cast("array<string>")

    def confirm(subject: Column, folded: Column, found: Column) -> Column:
        entries = F.flatten(F.transform(found, lambda run: F.element_at(dictionary, run)))
        confirmed = F.filter(
            entries,
            lambda entry: entry["pattern"].isNull()
            | (F.contains(folded, entry["alias"]) & F.rlike(subject, entry["pattern"])),
        )
        return F.array_distinct(F.transform(F.array_sort(confirmed), lambda entry: entry["canonical"]))

    return let(
        subject,
        lambda whole: let(
            _folded(whole),
            lambda folded: let(
                F.array_distinct(F.filter(_runs(folded), lambda run: run.isin(anchors))),
                lambda found: F.when(F.size(found) == 0, none).otherwise(confirm(whole, folded, found)),
            ),
        ),
    )


def tag_records(records: DataFrame, aliases: Mapping[str, str], column: str = "compounds") -> DataFrame:
    """Add the tags as a comma-separated column."""
    return records.withColumn(column, F.array_join(tags(record_text(), aliases), ", "))


def tag(records: DataFrame, aliases: Mapping[str, str] | DataFrame, column: str = "compounds") -> DataFrame:
    """Add the tags of a dictionary of any size: a mapping, or a table ``(alias, canonical)``.

    A mapping that is too big for a literal goes the way of a table, with the same tags.
    """
    if isinstance(aliases, DataFrame):
        rank = F.struct((-F.length("alias")).alias("size"), F.lower("alias").alias("name"))
        return tag_with_table(records, aliases.select("alias", "canonical", rank.alias("rank")), column)
    if len(aliases) <= LITERAL_ALIASES:
        return tag_records(records, aliases, column)
    rows = [(alias, canonical, rank) for rank, (alias, canonical) in enumerate(ranked_aliases(aliases))]
    table = records.sparkSession.createDataFrame(rows, "alias string, canonical string, rank int")
    return tag_with_table(records, table, column)


def tag_with_table(records: DataFrame, aliases: DataFrame, column: str = "compounds") -> DataFrame:
    """The same tags for a dictionary of any size, given as ``(alias, canonical, rank)``.

    Runs of the texts meet the anchors in an equi join, which Spark broadcasts
    only if the dictionary's size allows it. Aliases of a single run are certain
    then; the candidates of longer ones go back to the texts for confirmation.
    ``rank`` is the position of the alias, longest first.
    """
    words = F.regexp_extract_all(F.lower("alias"), F.lit("([a-z0-9-]+)"), F.lit(1))
    longest = F.reduce(
        words, F.lit(""), lambda best, w: F.when(F.length(w) > F.length(best), w).otherwise(best)
    )
    quoted = F.regexp_replace("alias", r"([^0-9A-Za-z\x{80}-\x{10ffff}])", r"\\$1")
    pattern = F.concat(F.lit(f"(?iu)(?<![{GLUE}])"), quoted, F.lit(f"(?![{GLUE}])"))
    table = (
        aliases.select(F.lower("alias").alias("alias"), "canonical", "rank", longest.alias("anchor"), pattern.alias("pattern"))
        .filter(F.col("anchor") != "")
        .withColumn("single", F.col("anchor") == F.col("alias"))
    )
    subject = records.select(SEQ, record_text().alias("_text"))
    runs = subject.select(
        SEQ, F.explode(F.array_distinct(_runs(_folded(F.col("_text"))))).alias("anchor")
    )
    certain = runs.join(table.filter("single"), "anchor").select(SEQ, "canonical", "rank")
    open_ones = runs.join(table.filter("not single"), "anchor").select(
        SEQ, "alias", "pattern", "canonical", "rank"
    )
    confirmed = (
        open_ones.join(subject, SEQ)
        .filter(
            F.contains(_folded(F.col("_text")), F.col("alias")) & F.rlike("_text", F.col("pattern"))
        )
        .select(SEQ, "canonical", "rank")
    )
    hits = (
        certain.unionByName(confirmed)
        .groupBy(SEQ, "canonical")
        .agg(F.min("rank").alias("rank"))
        .groupBy(SEQ)
        .agg(F.sort_array(F.collect_list(F.struct("rank", "canonical"))).alias("_hits"))
        .select(SEQ, F.array_join(F.transform("_hits", lambda h: h["canonical"]), ", ").alias(column))
    )
    return records.join(hits, SEQ, "left").withColumn(column, F.coalesce(column, F.lit("")))


def tag_frequency(records: DataFrame, aliases: Mapping[str, str]) -> DataFrame:
    """Number of records per tag; counts combine before the shuffle."""
    found = records.select(F.explode(tags(record_text(), aliases)).alias("tag"))
    return found.groupBy("tag").agg(F.count("*").alias("n"))
