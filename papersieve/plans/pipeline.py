"""The curation pipeline as one plan, and the runs built on it."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .. import vocabulary as V
from ..operators import counters, dedup, filters, history, tagging
from ..schema import SEQ, with_columns_default
from ..session import cut_lineage


# The verdict of a record that the type filter drops; the cleaner's drop reasons are the others.
TYPE_DROPPED = "article_type"


@dataclass
class Curated:
    """Curated records, and what the counters are taken from."""

    records: DataFrame
    outcome: dedup.Deduplicated
    titles: DataFrame
    passing: Observation
    cleaner: filters.CleanerConfig
    title_cfg: filters.TitleFilterConfig

    def stats(self) -> dict[str, int]:
        """Counters of all stages. Those of the two filters were taken while the verdicts were stored."""
        out = dict(self.outcome.stats())
        seen = self.passing.get
        types = seen[TYPE_DROPPED]
        out.update(article_type_input=seen["input"], article_type_dropped=types, article_type_kept=seen["input"] - types)
        reasons = {r: seen[r] for r in sorted(filters.DROP_REASONS) if seen[r]}
        dropped = sum(reasons.values())
        out["literature_cleaner_input"] = out["article_type_kept"]
        out["literature_cleaner_dropped"] = dropped
        out["literature_cleaner_kept"] = out["article_type_kept"] - dropped
        out.update({f"literature_cleaner_drop_{r}": n for r, n in reasons.items()})
        out.update({f"title_filter_{k}": v for k, v in self.title_stats().items()})
        return out

    def title_stats(self) -> dict[str, int]:
        return counters.title_counts(self.titles, self.title_cfg.only_keep_passed).first().asDict()


def curate(
    records: DataFrame,
    *,
    known: DataFrame | None = None,
    local: DataFrame | None = None,
    type_patterns=None,
    filter_types: bool = True,
    cleaner: filters.CleanerConfig | None = None,
    dedup_cfg: dedup.DedupConfig | None = None,
    title_cfg: filters.TitleFilterConfig | None = None,
    aliases: Mapping[str, str] | DataFrame | None = None,
) -> Curated:
    """Types, cleaner, deduplication, title keywords, local flag, tags, in this order.

    The two filters in front of the deduplication must stay there: dropping a
    record changes which of its copies survives. All patterns run once, while keys and verdicts of the records are stored;
    the records themselves are read once more, for those that stay.
    """
    cleaner = cleaner or filters.CleanerConfig(enabled=False)
    title_cfg, dedup_cfg = title_cfg or filters.TitleFilterConfig(), dedup_cfg or dedup.DedupConfig()
    verdict = filters.drop_reason(cleaner) if cleaner.enabled else F.lit(None).cast("string")
    if filter_types:
        dropped = filters.type_excluded(type_patterns or V.TYPE_EXCLUDE_PATTERNS)
        verdict = F.when(dropped, F.lit(TYPE_DROPPED)).otherwise(verdict)
    marks = ("verdict", "title_filter_hits", "title_filter_pass")
    judged = filters.tag_title_keywords(records, title_cfg).withColumn("verdict", verdict)
    counted = {reason: F.col("verdict") == reason for reason in (TYPE_DROPPED, *filters.DROP_REASONS)}
    keys, passing = counters.observed(dedup.key_table(judged, dedup_cfg, marks), "curation", **counted)
    keys = cut_lineage(keys)
    outcome = dedup.deduplicate_keys(keys.filter("verdict is null"), known, dedup_cfg)
    titles = cut_lineage(outcome.accepted.join(keys.select(SEQ, *marks[1:]), SEQ).withColumnRenamed("doi", "_doi"))
    chosen = titles.filter("title_filter_pass = 'true'") if title_cfg.active and title_cfg.only_keep_passed else titles
    base = records.drop(*marks).join(chosen, SEQ)
    titled = base.withColumn("doi", F.col("_doi")).drop("_doi")
    if local is not None:
        flagged = history.flag_local(titled, local)
    else:
        flagged = with_columns_default(titled, ["local_has_pdf"])
    tagged = tagging.tag(flagged, aliases) if aliases is not None else flagged.withColumn("compounds", F.lit(""))
    return Curated(tagged, outcome, titles, passing, cleaner, title_cfg)
