"""Order-dependent deduplication as rounds of a parallel greedy matching.

Every candidate record connects one DOI with one title. Read in ingest order, a
record is accepted unless an earlier accepted record already took its DOI or its
title; rejected records take nothing. That is the greedy maximal matching of a
bipartite graph, which Blelloch, Fineman and Shun (2012) compute in parallel: in
each round accept every record that is the first one left at both its ends,
then drop all records that touch an accepted one. For inputs without an
adversarial order the number of rounds grows with the logarithm of the input. A chain in
which each record depends on the one before would take a round for two of its records: what is left
after ``ROUNDS`` rounds is therefore cut into its connected components. Components of at most ``IN_ORDER`` records are
finished in order, each in one task that keeps the keys taken, spread over all tasks; larger ones go on in rounds.
Every round ends in a stored table.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import normalize_pub_date
from ..functions.identifiers import is_valid_doi, normalize_doi
from ..functions.text import normalize_title
from ..schema import SEQ, text
from ..session import cut_lineage
from . import joins
from .components import components

# Rounds before what is left is cut into components, and records of a component that one task finishes.
ROUNDS = 8
IN_ORDER = 1_000_000

KEPT = "kept"
NO_DOI = "skipped_no_doi"
INVALID_DOI = "skipped_invalid_doi"
IN_BATCH = "skipped_duplicate_in_batch"
IN_MASTER = "skipped_duplicate_in_master"
TITLE_DATE = "skipped_duplicate_title_date"
TITLE = "skipped_duplicate_title"
REASONS = (NO_DOI, INVALID_DOI, IN_BATCH, IN_MASTER, TITLE, TITLE_DATE)


@dataclass(frozen=True)
class DedupConfig:
    normalize_doi: bool = True
    strip_doi_prefix: bool = True
    skip_invalid_doi: bool = True
    by_title: bool = False
    by_title_and_pub_date: bool = False

    @classmethod
    def from_dict(cls, cfg: dict | None) -> "DedupConfig":
        cfg = cfg or {}
        return cls(
            normalize_doi=cfg.get("normalize_doi", True),
            strip_doi_prefix=cfg.get("strip_doi_prefix", True),
            skip_invalid_doi=cfg.get("skip_invalid_doi", True),
            by_title=cfg.get("dedupe_by_title", False),
            by_title_and_pub_date=cfg.get("dedupe_by_title_and_pub_date", False),
        )


@dataclass
class Deduplicated:
    """Outcome per record: ``ingest_seq, doi, reason`` (reason is 'kept' if accepted)."""

    labels: DataFrame
    accepted: DataFrame
    rounds: int = field(default=0)

    def kept(self, records: DataFrame) -> DataFrame:
        """Accepted records with the normalised DOI; one shuffle on the unique sequence."""
        chosen = self.accepted.select(SEQ, F.col("doi").alias("_doi"))
        return records.join(chosen, SEQ).withColumn("doi", F.col("_doi")).drop("_doi")

    def reason_counts(self) -> DataFrame:
        return self.labels.groupBy("reason").agg(F.count("*").alias("n"))

    def stats(self) -> dict[str, int]:
        """Counters of the run; a handful of rows, one per reason."""
        counts = {r["reason"]: r["n"] for r in self.reason_counts().collect()}
        out = {"total_raw": sum(counts.values())}
        out.update({reason: counts.get(reason, 0) for reason in REASONS})
        out["new_count"] = counts.get(KEPT, 0)
        return out


def _digest(value: Column) -> Column:
    """Titles travel as their digest; a blank title stays blank."""
    return F.when(value == "", F.lit("")).otherwise(F.sha2(value, 256))


def key_table(records: DataFrame, cfg: DedupConfig, more: Sequence[str] = ()) -> DataFrame:
    """The narrow columns the decision needs: sequence, DOI, second key, date, early reason; and ``more`` columns."""
    raw = text("doi")
    doi = normalize_doi(raw) if cfg.normalize_doi or cfg.strip_doi_prefix else raw
    title = _digest(normalize_title(text("title")))
    date = normalize_pub_date(text("pub_date"))
    own = F.concat(F.lit("#seq:"), F.col(SEQ).cast("string"))
    if cfg.by_title:
        second = F.when(F.col("_title") == "", own).otherwise(F.col("_title"))
    elif cfg.by_title_and_pub_date:
        second = F.when((F.col("_title") == "") | (F.col("pub") == ""), own).otherwise(
            F.concat_ws("\u0001", "_title", "pub")
        )
    else:
        second = own
    early = F.when(F.col("_raw") == "", F.lit(NO_DOI))
    if cfg.skip_invalid_doi:
        early = early.when(~is_valid_doi(F.col("doi")), F.lit(INVALID_DOI))
    return (
        records.select(SEQ, raw.alias("_raw"), doi.alias("doi"), title.alias("_title"), date.alias("pub"), *more)
        .withColumns({"second": second, "early": early})
        .select(SEQ, "doi", "second", "pub", "early", *more)
    )


def first_at_both_ends(edges: DataFrame) -> DataFrame:
    """Records that come first at their DOI and at their second key.

    Both sides are minima that combine map-side, and they meet on the unique
    sequence number, so a hot key never gathers in one task.
    """
    by_doi = edges.groupBy("doi").agg(F.min(SEQ).alias(SEQ))
    by_second = edges.groupBy("second").agg(F.min(SEQ).alias(SEQ))
    return by_doi.join(by_second, SEQ).select(SEQ, "doi", "second")


def finish_in_order(edges: DataFrame) -> DataFrame:
    """Accepted records of components (``component`` column), each read in order by one task."""
    schema = edges.select(SEQ, "doi", "second").schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        component, dois, seconds = None, set(), set()
        for batch in batches:
            taken = []
            for own, doi, second in zip(*(batch[c].to_pylist() for c in ("component", "doi", "second"))):
                if own != component:
                    component, dois, seconds = own, set(), set()
                taken.append(doi not in dois and second not in seconds)
                if taken[-1]:
                    dois.add(doi)
                    seconds.add(second)
            yield batch.select(schema.names).filter(pa.array(taken, pa.bool_()))

    return edges.repartition("component").sortWithinPartitions("component", SEQ).mapInArrow(run, schema)


def by_component(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Records that are left, with their component: those of components that a task can finish, and the others."""
    arcs = []
    for key in ("doi", "second"):
        first = edges.groupBy(key).agg(F.min(SEQ).alias("b"))
        arcs.append(joins.lookup(edges, first, key).select(F.col(SEQ).alias("a"), "b"))
    found = components(arcs[0].union(arcs[1])).withColumnRenamed("node", SEQ)
    placed = cut_lineage(edges.join(found, SEQ, "left").withColumn("component", F.coalesce("component", SEQ)))
    large = placed.groupBy("component").count().filter(F.col("count") > IN_ORDER).select("component")
    return joins.exclude(placed, large, "component"), placed.join(large, "component", "left_semi")


def match(edges: DataFrame) -> tuple[DataFrame, int]:
    """Accepted ``(ingest_seq, doi, second)`` of a candidate table, and rounds used.

    Every round settles at least the first record left, so the loop ends; there is no cap on rounds.
    """
    parts: list[DataFrame] = []
    rounds = 0
    while edges.head(1):
        rounds += 1
        if rounds % (ROUNDS + 1) == 0:
            small, large = by_component(edges)
            parts.append(cut_lineage(finish_in_order(small)))
            edges = cut_lineage(large.select(SEQ, "doi", "second"))
            continue
        accepted = cut_lineage(first_at_both_ends(edges))
        parts.append(accepted)
        for key in ("doi", "second"):
            edges = joins.exclude(edges, accepted, key)
        edges = cut_lineage(edges.select(SEQ, "doi", "second"))
        if len(parts) >= 16:
            parts = [cut_lineage(reduce(DataFrame.unionByName, parts))]
    if not parts:
        return edges, rounds
    return reduce(DataFrame.unionByName, parts), rounds


def deduplicate(
    records: DataFrame, known: DataFrame | None = None, cfg: DedupConfig | None = None
) -> Deduplicated:
    """Label every record as kept or with the first reason that rejects it.

    ``records`` needs a unique ``ingest_seq``; ``known`` is a one-column table
    ``doi`` of normalised DOIs seen before. Records with a known DOI never take
    a key, so they leave before the matching starts.
    """
    cfg = cfg or DedupConfig()
    return deduplicate_keys(cut_lineage(key_table(records, cfg)), known, cfg)


def deduplicate_keys(keys: DataFrame, known: DataFrame | None, cfg: DedupConfig) -> Deduplicated:
    """The same for the key table of the records (see ``key_table``), which is read several times and should be stored."""
    candidates = keys.filter(F.col("early").isNull())
    edges = candidates.groupBy("doi", "second").agg(F.min(SEQ).alias(SEQ)).select(SEQ, "doi", "second")
    if known is not None:
        known = known.select("doi").distinct()
        edges = joins.exclude(edges, known, "doi")

    two_keys = cfg.by_title or cfg.by_title_and_pub_date
    if two_keys:
        accepted, rounds = match(cut_lineage(edges))
    else:
        firsts = edges.groupBy("doi").agg(F.min(SEQ).alias(SEQ))
        accepted = firsts.withColumn("second", F.concat(F.lit("#seq:"), F.col(SEQ).cast("string")))
        rounds = 1
    accepted = cut_lineage(accepted.select(SEQ, "doi", "second"))

    owners = accepted.select("doi", F.col(SEQ).alias("_doi_owner"))
    labelled = joins.lookup(keys, owners, "doi")
    if known is not None:
        labelled = joins.mark(labelled, known, "doi", "_known")
    else:
        labelled = labelled.withColumn("_known", F.lit(False))
    reason = (
        F.when(F.col("early").isNotNull(), F.col("early"))
        .when(F.col("_doi_owner") == F.col(SEQ), F.lit(KEPT))
        .when(F.col("_doi_owner") < F.col(SEQ), F.lit(IN_BATCH))
        .when(F.col("_known"), F.lit(IN_MASTER))
    )
    if cfg.by_title and cfg.by_title_and_pub_date:
        dated = accepted.join(keys.select(SEQ, F.col("pub").alias("_owner_pub")), SEQ).select(
            "second", "_owner_pub"
        )
        labelled = joins.lookup(labelled, dated, "second")
        reason = reason.when(
            (F.col("pub") != "") & (F.col("pub") == F.col("_owner_pub")), F.lit(TITLE_DATE)
        ).otherwise(F.lit(TITLE))
    else:
        reason = reason.otherwise(F.lit(TITLE if cfg.by_title else TITLE_DATE))
    labels = labelled.select(SEQ, "doi", reason.alias("reason"))
    return Deduplicated(labels=labels, accepted=accepted.select(SEQ, "doi"), rounds=rounds)


def keep_first(records: DataFrame, key: Column, order: str = SEQ) -> DataFrame:
    """First record per key: a minimum per key, then a semi join on the unique order."""
    firsts = records.groupBy(key.alias("_key")).agg(F.min(order).alias(order)).select(order)
    return records.join(firsts, order, "left_semi")


def keep_last(records: DataFrame, key: Column, order: str = SEQ) -> DataFrame:
    """Last record per key, for tables where a later line replaces an earlier one."""
    lasts = records.groupBy(key.alias("_key")).agg(F.max(order).alias(order)).select(order)
    return records.join(lasts, order, "left_semi")
