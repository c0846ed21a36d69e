"""Complete runs: search, screen, import a library, export; state between them."""

from __future__ import annotations

import json
import time
from collections.abc import Mapping
from dataclasses import replace
from datetime import date, datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import run_window, window_mode
from ..functions.identifiers import query_signature, table_signature
from ..functions.text import sanitize
from ..lexicon import alias_table, search_term_table
from ..operators import dedup, filters, history, library, ordering, overlay, screening, search
from ..schema import (
    AI_COLUMNS, BASE_COLUMNS, OUTPUT_COLUMNS, RECORD_SCHEMA, SEQ, TRACKS, adopt_columns, text,
    with_columns_default,
)
from ..session import work_path
from ..sinks import csv_output as sink
from ..sinks import units
from ..sources import api, landed
from ..sources.csv_files import RUN_FILE_NAMES, latest_run_file, read_csv
from .pipeline import Curated, curate

STATE_FILE = "last_run.json"
PENDING = "pending"
PENDING_META = "pending.json"


class RunState:
    """Last-run dates and the pending records of one state folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def load(self) -> dict:
        try:
            return json.loads(sink.read_text(self.spark, f"{self.folder}/{STATE_FILE}") or "{}")
        except ValueError:
            return {}

    def save(self, state: Mapping) -> None:
        sink.write_text(self.spark, f"{self.folder}/{STATE_FILE}", json.dumps(state, indent=2))

    def reset(self) -> None:
        self.save({})

    def save_pending(self, records: DataFrame, meta: Mapping) -> dict:
        """Store sanitised records; the signature is that of what was stored."""
        cells = [
            F.col(c) if c == SEQ else sanitize(F.col(c)).alias(c) for c in records.columns
        ]
        now = datetime.now()
        path = f"{self.folder}/{PENDING}/{now.strftime('%Y%m%dT%H%M%S%f')}"
        records.select(*cells).write.parquet(path)
        stored = self.spark.read.parquet(path)
        found = table_signature(stored, text("doi")).first()
        info = {
            "path": path,
            "signature": found["signature"],
            "record_count": stored.count(),
            "created_at": now.isoformat(timespec="seconds"),
            "meta": dict(meta),
        }
        # The pointer is replaced last, so a reader sees the old or the new list.
        sink.write_text(self.spark, f"{self.folder}/{PENDING_META}", json.dumps(info, ensure_ascii=False))
        return info

    def load_pending(self, allow_empty: bool = False) -> tuple[DataFrame, dict]:
        raw = sink.read_text(self.spark, f"{self.folder}/{PENDING_META}")
        if not raw:
            raise FileNotFoundError(f"no pending records below {self.folder}")
        info = json.loads(raw)
        records = self.spark.read.parquet(info["path"])
        if not allow_empty and records.isEmpty():
            raise ValueError("the pending list is empty")
        info["signature"] = table_signature(records, text("doi")).first()["signature"]
        return records, info


def validate(cfg: Mapping, exists) -> list[tuple[str, str]]:
    """Configuration issues as (level, message); missing paths are fatal."""
    issues = []
    paths = cfg.get("paths") or {}
    wanted = [paths.get("master_csv")] + [(e or {}).get("path") for e in paths.get("extra_doi_csvs") or []]
    issues += [("fatal", f"missing file: {p}") for p in wanted if p and str(p).strip() and not exists(p)]
    for section, key in (("pubmed", "email"), ("crossref", "mailto")):
        settings = cfg.get(section) or {}
        value = (settings.get(key) or "").strip()
        if settings.get("enabled", True) and (not value or "example.com" in value.lower()):
            issues.append(("warning", f"{section}.{key} is not set"))
    ai = screening.ScreeningConfig.from_dict(cfg.get("ai_screening"))
    if ai.enabled and ai.fail_if_missing_key and not ai.key():
        issues.append(("warning", f"screening is on but {ai.api_key_env} is not set"))
    return issues


# --- search ------------------------------------------------------------------------


def _options(settings: Mapping) -> dict[str, str]:
    plain = {k: v for k, v in settings.items() if isinstance(v, (str, int, float)) and not isinstance(v, bool)}
    out = {k: str(v) for k, v in plain.items() if str(v) != ""}
    if settings.get("filter_types"):
        out["filter_types"] = json.dumps(list(settings["filter_types"]))
    if settings.get("request_interval_sec") is not None:
        out["interval"] = str(settings["request_interval_sec"])
    return out


# Rows of the landed segments of each source.
LANDED = {"article_search": "query_ord int, position long, pmid string", "work_search": "query_ord int, position long, raw string"}
PLAN = "plan.json"


def land(spark, source: str, queries, window, options: Mapping, folder: str, resume: bool) -> DataFrame:
    """Answers of all searches as a stored table, landed segment by segment.

    The folder carries the signature of the searches and their window, and the limit of a search if one is set. A run plans once
    and stores the plan; each segment of it is read by its own task and is landed once all of its results have come, whatever becomes of
    the others; the run raises when all others are done. A resumed run takes up the last plan and asks only for the segments that are not there; another run begins anew.
    """
    start, end = str(window[0]), str(window[1])
    limit = options.get("limit_per_query") or "all"
    base = f"{folder}/{source}/{query_signature(queries, start, end)}-{limit}"
    attempts = units.folders(spark, base)
    if resume and attempts:
        attempt = max(attempts)
        plan = json.loads(sink.read_text(spark, f"{base}/{attempt}/{PLAN}"))
    else:
        attempt = f"attempt-{time.time_ns()}"
        reader = api.READERS[source]({**options, "queries": json.dumps(queries, ensure_ascii=False), "date_from": start, "date_to": end})
        plan = [segment.to_dict() for segment in reader.plan()]
        sink.write_text(spark, f"{base}/{attempt}/{PLAN}", json.dumps(plan, ensure_ascii=False))
    segments = f"{base}/{attempt}/segments"
    there = units.landed(spark, segments)
    missing = [s for s in plan if api.SearchPartition.from_dict(s).unit not in there]
    if missing:
        at_once = min(len(missing), int(options.get("concurrency") or spark.sparkContext.defaultParallelism))
        asked = {**options, "segments": json.dumps(missing, ensure_ascii=False), "concurrency": str(at_once), "keep_going": "true"}
        answers = spark.read.format(source).options(**asked).load()
        units.land(answers.select("unit", "unit_rows", "error", *units.names(LANDED[source])), segments)
    return units.read(spark, segments, LANDED[source])


def pubmed_records(spark, queries, window, settings: Mapping, folder: str, resume: bool) -> DataFrame:
    """Articles of all searches; an id found twice is fetched once, at its first place.

    Ids that could not be fetched raise; with ``allow_gaps`` they are stored in the folder
    ``article_gaps`` of the landing, and the run goes on.
    """
    found = land(spark, "article_search", queries, window, _options(settings), folder, resume)
    places = found.groupBy("pmid").agg(F.min(F.struct("query_ord", "position")).alias("place"))
    numbered = ordering.number_rows(places, [F.col("place"), F.col("pmid")])
    cap = int(settings.get("max_pmids") or 0)
    if cap > 0:
        numbered = numbered.filter(F.col("row_index") < cap)
    raw = api.fetch_articles(numbered.select("row_index", "pmid"), settings, int(settings.get("workers") or 0) or None)
    path = work_path(spark, "article-xml")
    raw.write.parquet(path)
    stored = spark.read.parquet(path)
    gaps = stored.filter(F.col("gap").isNotNull()).select("row_index", "gap")
    lost = gaps.count()
    if lost and not settings.get("allow_gaps"):
        some = ", ".join(r["gap"] for r in gaps.orderBy("row_index").limit(20).collect())
        raise api.Incomplete(f"{lost} articles could not be fetched: {some}; pubmed.allow_gaps goes on without them")
    if lost:
        gaps.write.mode("overwrite").parquet(f"{folder}/article_gaps/{query_signature(queries, str(window[0]), str(window[1]))}")
    return landed.parse_articles(stored.filter(F.col("raw").isNotNull()).drop("gap"), keep=("row_index",))


def crossref_records(spark, queries, window, settings: Mapping, folder: str, resume: bool) -> DataFrame:
    """Works of all searches, the first per DOI."""
    found = land(spark, "work_search", queries, window, _options(settings), folder, resume)
    order = (F.col("query_ord").cast("long") * F.lit(1 << 40) + F.col("position")).alias("row_index")
    parsed = landed.parse_items(found.select(order, "raw"), keep=("row_index",))
    return dedup.keep_first(parsed, F.lower("doi"), "row_index")


def fetch_records(
    spark: SparkSession, cfg: Mapping, tracks, source: str, window_of, resume: bool = False
) -> DataFrame:
    """Records of all tracks and sources, numbered in (track, source, place) order.

    The records are stored before anything else happens: a request is made once.
    """
    api.register(spark)
    landing = ((cfg.get("paths") or {}).get("state_dir") or "state").rstrip("/") + "/landing"
    terms = search_term_table(spark, (cfg.get("paths") or {}).get("search_term_table"))
    parts = []
    for rank, track in enumerate(tracks):
        plan = []
        pubmed = search.searches(cfg, "pubmed", track, terms)
        if pubmed and source in ("all", "pubmed") and (cfg.get("pubmed") or {}).get("enabled", True):
            plan.append((0, pubmed_records, pubmed, "pubmed", cfg.get("pubmed") or {}))
        works = search.searches(cfg, "crossref", track, terms)
        if works and source in ("all", "crossref") and (cfg.get("crossref") or {}).get("enabled", True):
            plan.append((1, crossref_records, works, "crossref", search.track_settings(cfg, "crossref", track)))
        for source_rank, reader, queries, name, settings in plan:
            path = work_path(spark, f"{track}-{name}")
            rows = reader(spark, queries, window_of(name), settings, landing, resume)
            rows.select(
                F.lit(rank).alias("_track"), F.lit(source_rank).alias("_source"), "row_index",
                *BASE_COLUMNS, F.lit(track).alias("track"),
            ).write.parquet(path)
            parts.append(spark.read.parquet(path))
    if not parts:
        return spark.createDataFrame([], RECORD_SCHEMA)
    together = reduce(DataFrame.unionByName, parts)
    order = [F.col("_track"), F.col("_source"), F.col("row_index")]
    return ordering.number_rows(together, order, SEQ).select(SEQ, *BASE_COLUMNS, "track")


def curate_from_config(spark: SparkSession, records: DataFrame, cfg: Mapping, aliases=None) -> Curated:
    paths, dedup_cfg = cfg.get("paths") or {}, cfg.get("deduplication") or {}
    types = cfg.get("article_type_filter") or {}
    local = None
    if paths.get("master_csv") and (cfg.get("local_pdf") or {}).get("enabled", True):
        local = history.dois_of_csv(spark, paths["master_csv"], paths.get("master_doi_column", "DOI"))
    return curate(
        records,
        known=history.known_from_config(spark, paths, dedup_cfg, (cfg.get("output") or {}).get("track_filenames")),
        local=local,
        type_patterns=types.get("exclude_publication_type_patterns"),
        filter_types=bool(types.get("enabled", False)),
        cleaner=filters.CleanerConfig.from_dict(cfg.get("literature_cleaner")),
        dedup_cfg=dedup.DedupConfig.from_dict(dedup_cfg),
        title_cfg=filters.TitleFilterConfig.from_dict(cfg.get("title_filter")),
        aliases=aliases if aliases is not None else alias_table(records.sparkSession, paths.get("alias_table")),
    )


def output_columns(cfg: Mapping) -> list[str]:
    configured = list((cfg.get("output") or {}).get("columns") or OUTPUT_COLUMNS)
    needed = ["doi", "title", "source", "track", *BASE_COLUMNS, "compounds", "fetched_at"]
    if (cfg.get("ai_screening") or {}).get("enabled", False):
        needed += AI_COLUMNS
    if (cfg.get("title_filter") or {}).get("enabled", False):
        needed += ["title_filter_hits", "title_filter_pass"]
    if (cfg.get("local_pdf") or {}).get("enabled", True):
        needed.append("local_has_pdf")
    return list(dict.fromkeys([*configured, *needed]))


def search_run(
    spark: SparkSession,
    cfg: Mapping,
    *,
    track: str = "all",
    source: str = "all",
    date_from: date | None = None,
    date_to: date | None = None,
    period: str | None = None,
    aliases=None,
    records: DataFrame | None = None,
    resume: bool = False,
) -> dict:
    """Fetch (or take ``records``), curate, store as pending and write the run's files."""
    paths, search_cfg = cfg.get("paths") or {}, cfg.get("search") or {}
    keeper = RunState(spark, paths.get("state_dir") or "state")
    state = keeper.load()
    tracks = search.resolve_tracks(track)

    def window_of(name: str) -> tuple[date, date]:
        lookback = int((cfg.get(name) or {}).get("initial_lookback_days", 30))
        return run_window(
            spark, search_cfg, last_run=state.get(f"{name}_last_run"), date_from=date_from, date_to=date_to,
            period=period, lookback_days=lookback,
        )

    fetched = records if records is not None else fetch_records(spark, cfg, tracks, source, window_of, resume)
    done = curate_from_config(spark, fetched, cfg, aliases)
    stats = done.stats()
    # Only an incremental run moves the last-run date forward.
    if window_mode(search_cfg, period) == "incremental":
        for name in ("pubmed", "crossref"):
            if source in ("all", name) and (cfg.get(name) or {}).get("enabled", True):
                state[f"{name}_last_run"] = (window_of(name)[1] + timedelta(days=1)).isoformat()
    info = keeper.save_pending(done.records, {"stats": stats, "tracks": tracks, "state": state})
    stored = with_columns_default(spark.read.parquet(info["path"]), AI_COLUMNS)
    folder = sink.write_run(
        stored, paths.get("output_dir") or "output", {**(cfg.get("output") or {}), "columns": output_columns(cfg)}
    )
    keeper.save(state)
    return {"stats": stats, "output": folder, "pending": info}


def trial_run(spark: SparkSession, cfg: Mapping, rows: int, scorer=None) -> list[dict]:
    """Screen the first ``rows`` pending records, and store and write nothing: their DOI, title and judgement."""
    keeper = RunState(spark, (cfg.get("paths") or {}).get("state_dir") or "state")
    records, _ = keeper.load_pending()
    some = ordering.head(records, [F.col(SEQ)], rows)
    ai = replace(screening.ScreeningConfig.from_dict(cfg.get("ai_screening")), only_keep_passed=False)
    screened = screening.screen(some, ai, scorer).orderBy(SEQ)
    return [r.asDict() for r in screened.select("doi", "title", *AI_COLUMNS).collect()]


def screen_run(
    spark: SparkSession, cfg: Mapping, scorer=None, *, resume: bool = False
) -> dict:
    """Screen the pending records and write the run's files."""
    paths = cfg.get("paths") or {}
    keeper = RunState(spark, paths.get("state_dir") or "state")
    records, info = keeper.load_pending(allow_empty=True)
    if records.isEmpty():
        # A run without new records has nothing to screen and writes no files.
        return {"signature": info["signature"], "output": None}
    ai = screening.ScreeningConfig.from_dict(cfg.get("ai_screening"))
    store = screening.JudgementStore(spark, f"{keeper.folder}/screening")
    screened = screening.screen(records, ai, scorer, store=store, resume=resume)
    folder = sink.write_run(
        screened, paths.get("output_dir") or "output", {**(cfg.get("output") or {}), "columns": output_columns(cfg)}
    )
    return {"signature": info["signature"], "output": folder}


def import_library_run(
    spark: SparkSession,
    cfg: Mapping,
    scorer=None,
    *,
    all_years: bool = False,
    date_from: str | None = None,
    date_to: str | None = None,
    skip_ai: bool = False,
) -> dict:
    """Import library records that no output has yet, and append them to the latest output."""
    paths, search_cfg = cfg.get("paths") or {}, cfg.get("search") or {}
    output_dir = paths.get("output_dir") or "output"
    on = paths.get("master_doi_column") or "DOI"
    master, metadata = read_csv(spark, paths["master_csv"]), read_csv(spark, paths["master_metadata_csv"])
    if on not in metadata.columns and "DOI" in metadata.columns:
        metadata = metadata.withColumnRenamed("DOI", on)
    if "title" not in metadata.columns:
        raise KeyError("the library metadata has no title column")
    names = {c: F.coalesce(F.col(c), F.lit("")) for c in metadata.columns if c != on}
    numbered = ordering.number_rows(metadata.withColumns(names), [F.col(c) for c in metadata.columns], SEQ)
    found = library.scan_library(
        master, numbered, on=on, unique=SEQ, all_years=all_years,
        date_from=date_from or search_cfg.get("date_from"), date_to=date_to or search_cfg.get("date_to"),
    )
    pattern = (cfg.get("output") or {}).get("filename_pattern", "new_dois_%Y-%m_%H%M%S.csv")
    flat = pattern.split("%")[0] + "*.csv"
    named = {*RUN_FILE_NAMES, *((cfg.get("output") or {}).get("track_filenames") or {}).values()}
    fresh = history.not_known(found, history.dois_of_runs(spark, output_dir, flat, names=named))
    candidates, new = found.count(), fresh.count()
    stats = {"candidates": candidates, "already_in_output": candidates - new, "imported": new, "output_csv": ""}
    if not new:
        return stats
    ai = screening.ScreeningConfig.from_dict(cfg.get("ai_screening"))
    if ai.enabled and not skip_ai:
        fresh = screening.screen(fresh, ai, scorer)
    fresh = with_columns_default(fresh, AI_COLUMNS)
    now = datetime.now()
    stamp = F.lit(now.strftime(sink.TIME_FORMAT))
    columns = list(dict.fromkeys([*((cfg.get("output") or {}).get("columns") or OUTPUT_COLUMNS),
                                  "doi", "title", "source", "track", "local_has_pdf", "fetched_at"]))
    rows = sink.output_table(fresh, [c for c in columns if c != "fetched_at"], None)
    base_path = latest_run_file(spark, output_dir, flat)
    if base_path:
        base = adopt_columns(read_csv(spark, base_path), cfg.get("column_names"))
        merged = overlay.append_rows(base, rows, stamp)
    else:
        merged = rows.withColumn("fetched_at", stamp)
    target = f"{output_dir.rstrip('/')}/{now.strftime(pattern)}"
    sink.write_csv(merged, target)
    stats["output_csv"] = target
    return stats


def export_run(spark: SparkSession, cfg: Mapping, source: str | None = None, label: str | None = None) -> dict:
    """Export the usable records of an output (the latest by default)."""
    paths = cfg.get("paths") or {}
    output_dir = paths.get("output_dir") or "output"
    pattern = (cfg.get("output") or {}).get("filename_pattern", "new_dois_%Y-%m_%H%M%S.csv")
    path = source or latest_run_file(spark, output_dir, pattern.split("%")[0] + "*.csv")
    if not path:
        raise FileNotFoundError(f"no output below {output_dir}")
    table = adopt_columns(read_csv(spark, path).fillna(""), cfg.get("column_names"))
    return sink.export_key_results(with_columns_default(table, ("track", "ai_category", "ai_pass", "ai_rationale_zh")), output_dir, label, path)


def repair_run(spark: SparkSession, csv_path: str, pending: DataFrame, target: str) -> int:
    """Rewrite an output: pending rows as the base, screened columns laid over them."""
    table = read_csv(spark, csv_path)
    # Rows count in the order of the part files and of the lines in them; a file is read by one task.
    place = F.struct(F.col("_metadata.file_name").alias("file"), F.monotonically_increasing_id().alias("line"))
    numbered = table.select("*", place.alias(SEQ)).fillna("")
    fixed = overlay.repair(pending, numbered)
    sink.write_csv(sink.output_table(fixed, table.columns, None), target)
    return fixed.count()


def preview(cfg: Mapping, tracks, window: tuple[date, date], terms: Mapping | None = None) -> list[str]:
    """What a run would search, without a request."""
    interval = float((cfg.get("crossref") or {}).get("request_interval_sec") or 1.0)
    lines = [f"window {window[0]} .. {window[1]}"]
    for track in tracks:
        pubmed, works = (search.searches(cfg, service, track, terms) for service in ("pubmed", "crossref"))
        lines.append(f"[{track}] pubmed {len(pubmed)} searches")
        lines.append(f"[{track}] crossref {len(works)} searches, about {len(works) * interval / 60:.1f} min")
        lines += [f"    {q}" for q in works[:3]]
    return lines


__all__ = [
    "RunState", "validate", "search_run", "screen_run", "import_library_run", "export_run",
    "repair_run", "trial_run", "preview", "fetch_records", "curate_from_config", "output_columns", "TRACKS",
]
