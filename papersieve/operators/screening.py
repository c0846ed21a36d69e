"""Batched screening: payloads out, replies in, judgements merged back."""

from __future__ import annotations

import json
import os
import time
import urllib.request
from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import vocabulary as V
from ..functions import text as X
from ..functions.identifiers import list_signature, normalize_doi, table_signature
from ..schema import AI_COLUMNS, SEQ, TRACKS, text, track_rank, with_columns_default
from ..session import cut_lineage, is_missing, work_path
from ..sinks import units
from . import joins
from .classify import valid_track
from .dedup import keep_last
from .ordering import batches

# A scorer turns (system prompt, payload) into the reply text of one batch.
Scorer = Callable[[str, str], str]

# Fields of a request item with the setting that may limit their length,
# fields of a reply item, schema of the stored judgements.
REQUEST_FIELDS = (
    ("doi", None),
    ("title", "title_limit"),
    ("journal", None),
    ("pub_date", None),
    ("source", None),
    ("track", None),
    ("pmid", None),
    ("publication_types", "types_limit"),
    ("abstract", "abstract_limit"),
)
REPLY_FIELDS = (
    "doi",
    "article_type",
    "domain_relevant",
    "has_experiment",
    "has_pathway_or_synthesis",
    "pass_filter",
    "rationale_zh",
    "category",
    "synthesis_method",
    "compound_name",
)
REPLY_SCHEMA = "struct<" + ",".join(f"{name}:string" for name in REPLY_FIELDS) + ">"
COMPOUND_LENGTH = 200
RATIONALE_LENGTH = 500

BASE_PROMPT = (
    "You screen publications on non-natural amino acids. The input is a JSON array with one "
    "object per publication. Answer with a JSON array in the same order; every object repeats "
    "the doi and has the fields article_type (review, research_article, editorial_comment_letter "
    "or other), domain_relevant (boolean), has_experiment (yes, no or unclear), "
    "has_pathway_or_synthesis (yes, no or unclear), pass_filter (boolean), rationale_zh (one "
    "short sentence in Chinese), category, synthesis_method and compound_name. Set pass_filter "
    "only if the core of the work is making such an amino acid."
)
TRACK_PROMPTS = {
    "pathway": "Focus: metabolic and biosynthetic pathways.",
    "enzymatic": "Focus: synthesis with isolated enzymes.",
    "fermentation": "Focus: production by living cells.",
    "chemical": "Focus: chemical synthesis.",
    "hybrid": "Focus: routes that combine enzymes and chemistry.",
    "gce": "Focus: incorporation into proteins by genetic code expansion.",
}
DEFAULT_PROMPT = "Focus: any pathway or synthesis route."


@dataclass(frozen=True)
class ScreeningConfig:
    enabled: bool = True
    batch_size: int = 6
    only_keep_passed: bool = True
    keep_on_batch_error: bool = True
    # Tasks that ask at once (0: all that can run), and seconds between any two requests of them all.
    max_workers: int = 0
    request_interval_sec: float = 0.4
    # Batches whose replies are landed together.
    batches_per_group: int = 10
    # Characters of a field that are sent (0: the whole field).
    title_limit: int = 0
    types_limit: int = 0
    abstract_limit: int = 0
    model: str = "gpt-4o-mini"
    api_base: str = "https://api.openai.com/v1"
    api_key: str = ""
    api_key_env: str = "SCREENING_API_KEY"
    fail_if_missing_key: bool = False
    prompts: Mapping[str, str] = field(default_factory=dict)

    @classmethod
    def from_dict(cls, cfg: Mapping | None) -> "ScreeningConfig":
        cfg = cfg or {}
        names = [
            "enabled", "batch_size", "only_keep_passed", "keep_on_batch_error", "max_workers",
            "request_interval_sec", "model", "api_base", "api_key", "api_key_env", "fail_if_missing_key", "batches_per_group",
            "title_limit", "types_limit", "abstract_limit",
        ]
        values = {n: cfg[n] for n in names if cfg.get(n) is not None}
        values["enabled"] = bool(cfg.get("enabled", False))
        values["batch_size"] = max(1, int(values.get("batch_size", 6)))
        values["max_workers"] = max(0, int(values.get("max_workers", 0)))
        values["batches_per_group"] = max(1, int(values.get("batches_per_group", 10)))
        values["prompts"] = {
            k: v for k, v in cfg.items() if k.startswith(("system_prompt", "extra_instructions"))
        }
        return cls(**values)

    def key(self) -> str:
        return os.environ.get(self.api_key_env, "").strip() or (self.api_key or "").strip()


def system_prompt(track: str, prompts: Mapping[str, str] | None = None) -> str:
    """Prompt of a batch; a configured prompt replaces ours, extra text is appended."""
    prompts = prompts or {}
    name = (track or "").strip().lower()
    known = name in TRACKS
    custom = (prompts.get(f"system_prompt_{name}") or "").strip() if known else ""
    base = custom or f"{BASE_PROMPT}\n{TRACK_PROMPTS.get(name, DEFAULT_PROMPT)}"
    own = prompts.get(f"extra_instructions_{name}") if known else ""
    extra = (own or prompts.get("extra_instructions") or "").strip()
    return f"{base}\n\n{extra}" if extra else base


# --- batches and payloads ------------------------------------------------------


def screening_order() -> list[Column]:
    return [track_rank(valid_track()), normalize_doi(text("doi")), F.col(SEQ)]


def batch_index(records: DataFrame, size: int) -> DataFrame:
    """``ingest_seq, row_index, batch_id`` in (track, DOI) order.

    Only the sort keys are ordered and stored, not the texts.
    """
    rank, doi, seq = screening_order()
    keys = records.select(SEQ, rank.alias("_rank"), doi.alias("_doi"))
    return batches(keys, [F.col("_rank"), F.col("_doi"), seq], size).select(SEQ, "row_index", "batch_id")


def screening_batches(records: DataFrame, size: int) -> DataFrame:
    """Records with their ``row_index`` and ``batch_id``."""
    return records.join(batch_index(records, size), SEQ)


def request_item(cfg: ScreeningConfig) -> Column:
    def cell(name: str, setting: str | None) -> Column:
        limit = getattr(cfg, setting) if setting else 0
        value = X.truncate(F.col(name), limit) if limit else X.sanitize(F.col(name))
        return value.alias(name)

    return F.struct(*[cell(name, setting) for name, setting in REQUEST_FIELDS])


def payloads(batched: DataFrame, cfg: ScreeningConfig = ScreeningConfig()) -> DataFrame:
    """One row per batch: first track, DOIs, signature, JSON payload.

    A batch has ``batch_size`` rows, so the list it collects is bounded.
    """
    entry = F.struct(
        F.col("row_index"),
        valid_track().alias("track"),
        normalize_doi(text("doi")).alias("doi"),
        request_item(cfg).alias("item"),
    )
    listed = batched.groupBy("batch_id").agg(F.array_sort(F.collect_list(entry)).alias("_rows"))
    dois = F.filter(F.transform("_rows", lambda r: r["doi"]), lambda d: d != "")
    return listed.select(
        "batch_id",
        F.col("_rows")[0]["track"].alias("track"),
        F.size("_rows").alias("batch_rows"),
        dois.alias("dois"),
        list_signature(dois).alias("signature"),
        F.to_json(F.transform("_rows", lambda r: r["item"])).alias("payload"),
    )


# --- scoring -------------------------------------------------------------------


@dataclass(frozen=True)
class ChatScorer:
    """Scorer for a chat-completions endpoint (standard library only)."""

    api_base: str
    api_key: str
    model: str
    timeout: int = 90

    def __call__(self, system: str, payload: str) -> str:
        body = {
            "model": self.model,
            "temperature": 0.2,
            "messages": [
                {"role": "system", "content": system},
                {"role": "user", "content": payload},
            ],
        }
        request = urllib.request.Request(
            self.api_base.rstrip("/") + "/chat/completions",
            data=json.dumps(body).encode(),
            headers={"Authorization": f"Bearer {self.api_key}", "Content-Type": "application/json"},
        )
        with urllib.request.urlopen(request, timeout=self.timeout) as response:
            choices = json.load(response).get("choices") or []
        if not choices:
            raise ValueError("reply without choices")
        return ((choices[0].get("message") or {}).get("content") or "").strip()


class ScorerDown(Exception):
    """Raised by a scorer that cannot answer any more: its group of batches is not landed, and a resumed run asks again."""


# How long an answered group waits for others to be landed in the same file; a killed task loses no more than that and the request under way.
LAND_SECONDS = 2.0

REPLIES = "batch_id long, dois array<string>, signature string, attempt long, reply string"
_REPLIES = pa.schema([
    ("batch_id", pa.int64()), ("dois", pa.list_(pa.field("element", pa.string()))), ("signature", pa.string()),
    ("attempt", pa.int64()), ("reply", pa.string()),
])


def reply_sink(scorer: Scorer, prompts: Mapping[str, str] | None, workers: int, interval: float) -> type[units.UnitLanding]:
    """A sink that asks the scorer for each request and lands the replies group by group.

    A reply is null where the scorer failed for a batch. Groups that are answered within ``LAND_SECONDS`` share a file. All ``workers`` tasks together keep to one request in ``interval`` seconds: each
    begins its requests ``workers`` intervals apart, shifted by its number.
    """
    prompt_of = {track: system_prompt(track, prompts) for track in (*TRACKS, "")}

    class ReplyWriter(units.UnitWriter):
        seconds, next_request = LAND_SECONDS, None

        def pace(self) -> None:
            from pyspark import TaskContext

            now = time.monotonic()
            if self.next_request is None:
                self.next_request = now + interval * (TaskContext.get().partitionId() % workers)
            time.sleep(max(0.0, self.next_request - now))
            self.next_request = max(now, self.next_request) + interval * workers

        def work(self, rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            for row in rows.to_pylist():
                self.pace()
                try:
                    reply = scorer(prompt_of.get(row["track"], prompt_of[""]), row["payload"])
                except ScorerDown as error:
                    raise units.UnitFailed(f"ScorerDown: {error}") from error
                except Exception:
                    reply = None
                yield pa.RecordBatch.from_pylist([{**{n: row[n] for n in _REPLIES.names[:-1]}, "reply": reply}], _REPLIES)

    class ReplyLanding(units.UnitLanding):
        @classmethod
        def name(cls) -> str:
            return "reply_landing"

        def writer(self, schema, overwrite: bool) -> ReplyWriter:
            return ReplyWriter(self.options["path"])

    return ReplyLanding


def score(requests: DataFrame, scorer: Scorer, cfg: ScreeningConfig, path: str, attempt: int) -> None:
    """Ask the scorer for all requests (see ``payloads``) and land the replies below ``path``.

    Groups of ``batches_per_group`` batches are spread over all tasks; a group is landed as soon as it is
    answered. Raises when all groups are done and some could not be answered.
    """
    group = F.floor(F.col("batch_id") / cfg.batches_per_group).cast("long")
    grouped = cut_lineage(requests.withColumn("group", group))
    sizes = grouped.groupBy("group").agg(F.count("*").alias("unit_rows"))
    workers = max(1, min(sizes.count(), cfg.max_workers or requests.sparkSession.sparkContext.defaultParallelism))
    named = grouped.join(sizes, "group").select(
        F.format_string("%020d-%010d", F.lit(attempt), "group").alias("unit"), "unit_rows", F.lit(None).cast("string").alias("error"),
        "batch_id", "dois", "signature", F.lit(attempt).cast("long").alias("attempt"), "track", "payload",
    )
    dealt = named.repartition(workers, "unit").sortWithinPartitions("unit", "batch_id")
    units.land(dealt, path, reply_sink(scorer, cfg.prompts, workers, cfg.request_interval_sec))


# An object without objects in it, and a comma before its end.
_FLAT_OBJECT, _LAST_COMMA = r"\{[^{}]*\}", r",\s*\}$"


def reply_items(reply: Column) -> Column:
    """The items of a reply as an array of JSON texts, null if there are none to be had.

    A reply that is a JSON array is taken as it is. Any other is mended: what stands before the first bracket goes, and of the objects
    behind it those that can be read on their own are taken, without a trailing comma. So text around the array, commas too many, an end
    that is cut off and a broken object cost no more than that object.
    """
    body = X.strip_code_fence(reply)
    strict = F.when(F.startswith(body, F.lit("[")), F.from_json(body, "array<string>"))
    bracket, brace = F.instr(body, "["), F.instr(body, "{")
    rest = F.when((bracket > 0) & ((brace == 0) | (bracket < brace)), F.substring(body, bracket, F.length(body)))
    objects = F.transform(F.regexp_extract_all(rest, F.lit(_FLAT_OBJECT), F.lit(0)), lambda o: F.regexp_replace(o, _LAST_COMMA, "}"))
    sound = F.filter(objects, lambda o: F.from_json(o, REPLY_SCHEMA)["doi"].isNotNull())
    return F.coalesce(strict, F.when(F.size(sound) > 0, sound))


def parse_replies(replies: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Judgement items of good replies, and the DOIs of failed batches.

    The reply must hold a JSON array (see ``reply_items``); items that are no objects are ignored.
    """
    parsed = replies.withColumn("_items", reply_items(F.col("reply")))
    more = [c for c in ("attempt",) if c in replies.columns]
    failed = parsed.filter(F.col("_items").isNull()).select("batch_id", *more, F.explode("dois").alias("doi"))
    objects = F.filter("_items", lambda raw: F.startswith(F.ltrim(raw), F.lit("{")))
    good = (
        parsed.filter(F.col("_items").isNotNull())
        .select("batch_id", *more, F.posexplode(objects).alias("position", "raw"))
        .withColumn("judgement", F.from_json("raw", REPLY_SCHEMA))
        .select("batch_id", *more, "position", "judgement.*")
        .withColumn("doi", normalize_doi(F.col("doi")))
        .filter(F.col("doi") != "")
    )
    return good, failed.select("doi", *more).distinct()


def reply_stats(replies: DataFrame) -> DataFrame:
    """One row: batches answered, batches without a usable reply, mended replies, and objects lost in these."""
    body = X.strip_code_fence(F.col("reply"))
    strict = F.startswith(body, F.lit("[")) & F.from_json(body, "array<string>").isNotNull()
    strict, items = F.coalesce(strict, F.lit(False)), reply_items(F.col("reply"))
    mended = ~strict & items.isNotNull()
    begun = F.length(body) - F.length(F.replace(body, F.lit("{"), F.lit("")))
    return replies.agg(
        F.count("*").alias("ai_batches"),
        F.count_if(items.isNull()).alias("ai_errors"),
        F.count_if(mended).alias("ai_mended"),
        F.coalesce(F.sum(F.when(mended, begun - F.size(items))), F.lit(0)).cast("long").alias("ai_broken_items"),
    )


def last_judgement(judgements: DataFrame, order: str = SEQ) -> DataFrame:
    """The latest judgement per DOI."""
    keyed = judgements.withColumn("doi", normalize_doi(text("doi"))).filter(F.col("doi") != "")
    return keep_last(keyed, F.col("doi"), order)


# --- merge ---------------------------------------------------------------------


def _truthy(value: Column) -> Column:
    folded = F.lower(X.strip(F.coalesce(value, F.lit(""))))
    return ~folded.isin("", "false", "0", "no", "null", "none")


def judgement_columns(found: Column) -> dict[str, Column]:
    """Output columns of a judgement; ``found`` tells whether there is one."""
    kind = text("article_type")
    rationale = F.substring(
        X.strip(F.replace(text("rationale_zh"), F.lit("\n"), F.lit(" "))), 1, RATIONALE_LENGTH
    )
    passed = found & _truthy(F.col("pass_filter"))
    return {
        "ai_article_type": kind,
        "ai_domain_relevant": F.lower(text("domain_relevant")),
        "ai_has_experiment": text("has_experiment"),
        "ai_pass": F.when(passed, F.lit("true")).otherwise(F.lit("false")),
        "ai_rationale_zh": F.when(found, rationale).otherwise(F.lit(V.RATIONALE_MISSING)),
        "lit_type_zh": X.label_of(kind, V.TYPE_LABELS_ZH, V.TYPE_LABEL_DEFAULT),
        "ai_category": X.one_of(F.col("category"), V.CATEGORIES),
        "ai_synthesis_method": X.one_of(F.col("synthesis_method"), V.SYNTHESIS_METHODS),
        "ai_has_pathway_or_synthesis": X.one_of(F.col("has_pathway_or_synthesis"), V.YES_NO),
        "ai_compound": X.truncate(F.col("compound_name"), COMPOUND_LENGTH),
    }


def failed_columns() -> dict[str, Column]:
    """Output columns of a record whose batch failed and is kept."""
    out = {name: F.lit("") for name in AI_COLUMNS}
    out["ai_pass"] = F.lit("true")
    out["ai_rationale_zh"] = F.lit(V.RATIONALE_FAILED)
    out["lit_type_zh"] = F.lit(V.TYPE_LABEL_DEFAULT)
    return out


def merge_judgements(
    records: DataFrame, judgements: DataFrame, failed: DataFrame | None = None
) -> DataFrame:
    """Left join of the records with one judgement per DOI.

    A record without a judgement fails, one of a failed batch passes with a
    marked rationale.
    """
    fields = [c for c in REPLY_FIELDS if c != "doi"]
    side = judgements.select(F.col("doi").alias("_doi"), *fields, F.lit(True).alias("_judged"))
    side = side.withColumn("_failed", F.lit(False))
    if failed is not None:
        none = [F.lit(None).cast("string").alias(c) for c in fields]
        broken = failed.select(
            F.col("doi").alias("_doi"), *none, F.lit(False).alias("_judged"), F.lit(True).alias("_failed")
        )
        open_only = side.join(failed.select(F.col("doi").alias("_doi")), "_doi", "left_anti")
        side = open_only.unionByName(broken)
    base = [c for c in records.columns if c not in AI_COLUMNS]
    keyed = records.select(*base).withColumn("_doi", normalize_doi(text("doi")))
    joined = joins.lookup(keyed, side, "_doi")
    found = F.coalesce(F.col("_judged"), F.lit(False))
    broken = F.coalesce(F.col("_failed"), F.lit(False))
    judged, kept = judgement_columns(found), failed_columns()
    return joined.select(
        *base, *[F.when(broken, kept[c]).otherwise(judged[c]).alias(c) for c in AI_COLUMNS]
    )


def screening_stats(merged: DataFrame, cfg: ScreeningConfig) -> DataFrame:
    """One row: input, dropped, kept, records of failed batches."""
    passed = F.col("ai_pass") == "true"
    dropped = ~passed if cfg.only_keep_passed else F.lit(False)
    return merged.agg(
        F.count("*").alias("ai_input"),
        F.count_if(dropped).alias("ai_dropped"),
        F.count_if(~dropped).alias("ai_kept"),
        F.count_if(F.col("ai_rationale_zh") == V.RATIONALE_FAILED).alias("ai_failed_records"),
    )


# --- resumable run -------------------------------------------------------------


class JudgementStore:
    """Replies to a record set, landed group by group below one folder, and the judgements and failures they hold.

    A run that does not resume begins anew: what was stored before its beginning no longer counts. A
    resumed run continues from the last beginning, with all groups that any attempt since then has landed. Of a DOI's judgements and
    failures the latest counts.
    """

    def __init__(self, spark, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def begin(self, signature: str, attempt: int) -> None:
        """From now on only replies of this attempt and later ones count."""
        mark = self.spark.createDataFrame([(attempt,)], "attempt long")
        mark.write.mode("append").parquet(f"{self.path}/begun/signature={signature}")

    def clear(self, signature: str) -> None:
        """Forget what is stored for a record set."""
        self.begin(signature, time.time_ns())

    def _begun(self, signature: str) -> int:
        try:
            marks = self.spark.read.schema("attempt long").parquet(f"{self.path}/begun/signature={signature}")
        except AnalysisException as error:
            if not is_missing(error):
                raise
            return 0
        return marks.agg(F.max("attempt")).first()[0] or 0

    def replies_path(self, signature: str) -> str:
        return f"{self.path}/replies/signature={signature}"

    def replies(self, signature: str) -> DataFrame:
        """The replies that count: batch_id, dois, signature, attempt, reply; one for each batch of an attempt.

        A repeated task may have landed a batch twice; an answer counts before a failure.
        """
        found = units.read(self.spark, self.replies_path(signature), REPLIES).filter(F.col("attempt") >= self._begun(signature))
        same = found.groupBy("attempt", "batch_id").agg(F.first("dois").alias("dois"), F.first("signature").alias("signature"), F.max("reply").alias("reply"))
        return same.select(*units.names(REPLIES))

    def judgements(self, signature: str) -> DataFrame:
        good, _ = parse_replies(self.replies(signature))
        return good

    def failed(self, signature: str) -> DataFrame:
        _, failed = parse_replies(self.replies(signature))
        return failed


def pending_requests(requests: DataFrame, done: DataFrame) -> DataFrame:
    """Batches with at least one DOI that has no result yet (failed counts as a result)."""
    parts = requests.select("batch_id", F.explode("dois").alias("doi"))
    open_batches = parts.join(done.select("doi").distinct(), "doi", "left_anti").select("batch_id")
    return requests.join(open_batches.distinct(), "batch_id", "left_semi")


def screen(
    records: DataFrame,
    cfg: ScreeningConfig,
    scorer: Scorer | None = None,
    *,
    store: JudgementStore | None = None,
    resume: bool = False,
) -> DataFrame:
    """Screen all records and return them with their judgement columns."""
    if not cfg.enabled:
        return with_columns_default(records, AI_COLUMNS)
    if scorer is None:
        if not cfg.key():
            if cfg.fail_if_missing_key:
                raise RuntimeError(f"no API key in {cfg.api_key_env}")
            out = records.drop(*AI_COLUMNS)
            constants = {c: F.lit("") for c in AI_COLUMNS}
            constants["ai_rationale_zh"] = F.lit(V.RATIONALE_NO_KEY)
            constants["lit_type_zh"] = F.lit(V.TYPE_LABEL_DEFAULT)
            return out.withColumns(constants)
        scorer = ChatScorer(cfg.api_base, cfg.key(), cfg.model)
    spark = records.sparkSession
    requests = payloads(screening_batches(records, cfg.batch_size), cfg)
    signature = table_signature(records, text("doi")).first()["signature"]
    store = store or JudgementStore(spark, work_path(spark, "judgements"))
    attempt = time.time_ns()
    if not resume:
        store.begin(signature, attempt)
    else:
        done = store.judgements(signature).select("doi")
        if cfg.keep_on_batch_error:
            done = done.unionByName(store.failed(signature).select("doi"))
        requests = pending_requests(requests, done)
    score(requests, scorer, cfg, store.replies_path(signature), attempt)
    # The latest attempt wins, then the later line; batches of an attempt are disjoint in their DOIs.
    place = F.struct("attempt", "batch_id", "position")
    latest = store.judgements(signature).groupBy("doi").agg(
        F.max_by(F.struct(*[c for c in REPLY_FIELDS if c != "doi"]), place).alias("found")
    ).select("doi", "found.*")
    latest = cut_lineage(latest)
    failures = None
    if cfg.keep_on_batch_error:
        failures = cut_lineage(store.failed(signature).select("doi").distinct().join(latest.select("doi"), "doi", "left_anti"))
    merged = merge_judgements(records, latest, failures)
    return merged.filter(F.col("ai_pass") == "true") if cfg.only_keep_passed else merged
