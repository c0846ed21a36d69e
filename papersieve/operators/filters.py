"""Rule filters. Each one labels rows; callers keep, drop or count by the label."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import vocabulary as V
from ..functions import text as X
from ..functions.dates import leading_year
from ..schema import DEFAULT_TRACK, text

# --- publication types ---------------------------------------------------------


def type_excluded(patterns: Sequence[str] = V.TYPE_EXCLUDE_PATTERNS) -> Column:
    """True if any pattern is found in the publication types; blank types never match."""
    types = X.strip(text("publication_types"))
    return (types != "") & X.search_any(types, patterns)


def filter_types(
    records: DataFrame, patterns: Sequence[str] | None = None, enabled: bool = True
) -> DataFrame:
    return records.filter(~type_excluded(patterns or V.TYPE_EXCLUDE_PATTERNS)) if enabled else records


# --- record cleaner ------------------------------------------------------------


# The cleaner's drop reasons in the order of its rules.
DROP_REASONS = (
    "non_journal_article", "title_prefix", "title_regex", "nanozyme_in_title", "conference_keyword", "doi_pattern",
    "numeric_title_start", "short_title", "cover_suffix", "pub_year_before_min",
)


@dataclass(frozen=True)
class CleanerRules:
    """Rules of the record cleaner; an empty list falls back to the default list."""

    require_journal_article: bool = True
    title_prefixes: tuple[str, ...] = V.CLEANER_TITLE_PREFIXES
    title_patterns: tuple[str, ...] = V.CLEANER_TITLE_PATTERNS
    exclude_nanozyme_in_title: bool = False
    conference_words: tuple[str, ...] = V.CLEANER_CONFERENCE_WORDS
    doi_patterns: tuple[str, ...] = V.CLEANER_DOI_PATTERNS
    drop_numeric_title_start: bool = True
    min_title_words: int = V.CLEANER_MIN_TITLE_WORDS
    cover_pattern: str = V.CLEANER_COVER_PATTERN
    min_pub_year: int | None = None

    # Configuration keys and the fields they set.
    _KEYS = {
        "require_journal_article": "require_journal_article",
        "title_prefixes": "title_prefixes",
        "title_regex_patterns": "title_patterns",
        "exclude_nanozyme_in_title": "exclude_nanozyme_in_title",
        "conference_keywords": "conference_words",
        "doi_patterns": "doi_patterns",
        "drop_numeric_title_start": "drop_numeric_title_start",
        "min_title_words": "min_title_words",
        "cover_suffix_pattern": "cover_pattern",
        "min_pub_year": "min_pub_year",
    }

    def override(self, cfg: Mapping | None) -> "CleanerRules":
        """Shallow merge; lists and patterns that are empty keep the default."""
        defaults = CleanerRules()
        changes = {}
        for key, name in self._KEYS.items():
            if key not in (cfg or {}):
                continue
            value = cfg[key]
            if isinstance(getattr(defaults, name), (tuple, str)):
                value = value or getattr(defaults, name)
                value = tuple(value) if not isinstance(value, str) else value
            changes[name] = value
        return replace(self, **changes)

    def reason(self) -> Column:
        """First matching rule as the drop reason, null if the record stays."""
        title = text("title")
        low_title = F.lower(title)
        low_doi = F.lower(text("doi"))
        types = F.replace(F.lower(text("publication_types")), F.lit("-"), F.lit(" "))
        conference = [w.lower() for w in self.conference_words if w]
        rules: list[tuple[str, Column | None]] = [
            (
                "non_journal_article",
                (types != "") & ~F.contains(types, F.lit("journal article"))
                if self.require_journal_article
                else None,
            ),
            ("title_prefix", X.starts_with_any(low_title, [p.lower() for p in self.title_prefixes])),
            ("title_regex", X.search_any(low_title, self.title_patterns)),
            (
                "nanozyme_in_title",
                F.contains(low_title, F.lit("nanozyme")) if self.exclude_nanozyme_in_title else None,
            ),
            (
                "conference_keyword",
                X.contains_any(low_title, conference) | X.contains_any(low_doi, conference)
                if conference
                else None,
            ),
            ("doi_pattern", X.search_any(low_doi, self.doi_patterns)),
            (
                "numeric_title_start",
                title.rlike(r"^\p{Nd}") if self.drop_numeric_title_start else None,
            ),
            (
                "short_title",
                X.word_count(title) < self.min_title_words if self.min_title_words > 0 else None,
            ),
            ("cover_suffix", X.search(low_title, self.cover_pattern) if self.cover_pattern else None),
            (
                "pub_year_before_min",
                leading_year(text("pub_date")) < int(self.min_pub_year)
                if self.min_pub_year is not None
                else None,
            ),
        ]
        active = [(name, cond) for name, cond in rules if cond is not None]
        (name, cond), *rest = active
        out = F.when(cond, F.lit(name))
        for name, cond in rest:
            out = out.when(cond, F.lit(name))
        return out


@dataclass(frozen=True)
class CleanerConfig:
    enabled: bool = True
    rules: CleanerRules = field(default_factory=CleanerRules)
    track_rules: Mapping[str, CleanerRules] = field(default_factory=dict)

    @classmethod
    def from_dict(cls, cfg: Mapping | None) -> "CleanerConfig":
        cfg = cfg or {}
        base = CleanerRules().override({k: v for k, v in cfg.items() if k != "track_overrides"})
        tracks = {
            track: base.override(changes or {})
            for track, changes in (cfg.get("track_overrides") or {}).items()
        }
        return cls(enabled=bool(cfg.get("enabled", False)), rules=base, track_rules=tracks)


def cleaner_track() -> Column:
    """Track whose rules apply to the record."""
    track = F.col("track").cast("string")
    named = F.when(F.coalesce(track, F.lit("")) == "", F.lit(DEFAULT_TRACK)).otherwise(track)
    return F.lower(X.strip(named))


def drop_reason(cfg: CleanerConfig) -> Column:
    """Drop reason under the rules of the record's track.

    Tracks with overrides get their own branch, so only the rules of one track
    are evaluated per record.
    """
    out = cfg.rules.reason()
    for track, rules in cfg.track_rules.items():
        out = F.when(cleaner_track() == track, rules.reason()).otherwise(out)
    return out


def clean(records: DataFrame, cfg: CleanerConfig) -> DataFrame:
    return records.filter(drop_reason(cfg).isNull()) if cfg.enabled else records


# --- title keywords ------------------------------------------------------------


@dataclass(frozen=True)
class TitleFilterConfig:
    enabled: bool = False
    match_field: str = "title"
    negative: tuple[str, ...] = V.TITLE_NEGATIVE_WORDS
    positive: tuple[str, ...] = V.TITLE_POSITIVE_WORDS
    require_positive: bool = False
    only_keep_passed: bool = True

    @classmethod
    def from_dict(cls, cfg: Mapping | None) -> "TitleFilterConfig":
        cfg = cfg or {}
        return cls(
            enabled=bool(cfg.get("enabled", False)),
            match_field=cfg.get("match_field") or "title",
            negative=tuple(cfg.get("keywords") or V.TITLE_NEGATIVE_WORDS),
            positive=tuple(cfg.get("positive_keywords") or V.TITLE_POSITIVE_WORDS),
            require_positive=bool(cfg.get("require_positive_keywords", False)),
            only_keep_passed=bool(cfg.get("only_keep_passed", True)),
        )

    @property
    def active(self) -> bool:
        return self.enabled or self.require_positive


def tag_title_keywords(records: DataFrame, cfg: TitleFilterConfig) -> DataFrame:
    """Add ``title_filter_hits`` and ``title_filter_pass`` ('true'/'false')."""
    if not cfg.active:
        return records.withColumns(
            {"title_filter_hits": F.lit(""), "title_filter_pass": F.lit("true")}
        )
    subject = text(cfg.match_field)
    none = F.array().cast("array<string>")
    tagged = records.withColumns(
        {
            "_neg": X.keyword_hits(subject, cfg.negative) if cfg.enabled else none,
            "_pos": X.keyword_hits(subject, cfg.positive) if cfg.require_positive else none,
        }
    )
    negative = F.when(F.size("_neg") > 0, F.concat(F.lit("neg:"), F.array_join("_neg", ", ")))
    if cfg.require_positive:
        positive = F.when(F.size("_pos") == 0, F.lit("pos:missing")).otherwise(
            F.concat(F.lit("pos:"), F.array_join("_pos", ", "))
        )
        passed = (F.size("_neg") == 0) & (F.size("_pos") > 0)
    else:
        positive = F.lit(None).cast("string")
        passed = F.size("_neg") == 0
    return tagged.withColumns(
        {
            "title_filter_hits": F.concat_ws("; ", negative, positive),
            "title_filter_pass": F.when(passed, F.lit("true")).otherwise(F.lit("false")),
        }
    ).drop("_neg", "_pos")


def filter_titles(records: DataFrame, cfg: TitleFilterConfig) -> DataFrame:
    tagged = tag_title_keywords(records, cfg)
    if cfg.active and cfg.only_keep_passed:
        return tagged.filter(F.col("title_filter_pass") == "true")
    return tagged


# --- usable results ------------------------------------------------------------


def is_usable() -> Column:
    """Passed the screening, and not merely because a batch failed."""
    passed = F.lower(X.strip(text("ai_pass"))) == "true"
    return passed & (X.strip(text("ai_rationale_zh")) != V.RATIONALE_FAILED)
