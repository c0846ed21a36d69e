import json
import os
import time

import pytest
from pyspark.sql import functions as F

from papersieve.operators import ordering, screening
from papersieve.schema import AI_COLUMNS, BASE_COLUMNS

SCHEMA = "ingest_seq long, " + ", ".join(f"{c} string" for c in (*BASE_COLUMNS, "track"))
TRACKS = ["hybrid", "pathway", "", "gce"]


def records(spark, n=23):
    rows = [
        (i, "pubmed", "", f"10.5555/{i:03d}", f"Title {i}", "J", "2024", "text " * 3, "Journal Article", TRACKS[i % 4])
        for i in range(n)
    ]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def _scorer():
    # Nested, so that it travels to the workers by value.
    def judge(system, payload):
        items = json.loads(payload)
        if any(item["doi"] == "10.5555/005" for item in items):
            raise OSError("service down")
        out = [
            {"doi": "doi:" + item["doi"].upper(), "article_type": "review", "domain_relevant": True,
             "pass_filter": int(item["doi"][-1]) % 2 == 0, "category": "Hybrid", "rationale_zh": "a\nb"}
            for item in items if item["doi"] != "10.5555/002"
        ]
        return "```json\n" + json.dumps([1, *out]) + "\n```"

    return judge


judge = _scorer()


def config(**kw):
    return screening.ScreeningConfig(batch_size=4, only_keep_passed=False, request_interval_sec=0, **kw)


def test_row_numbers_follow_the_order(spark):
    frame = spark.range(0, 5000, 1, 7).withColumn("v", F.pmod(F.xxhash64("id"), F.lit(1000)))
    got = ordering.number_rows(frame, [F.col("v"), F.col("id")]).collect()
    ranked = sorted(got, key=lambda r: (r["v"], r["id"]))
    assert [r["row_index"] for r in ranked] == list(range(5000))


def test_head_without_limit(spark):
    frame = spark.range(5)
    assert [r[0] for r in ordering.head(frame, [F.desc("id")], 2).collect()] == [4, 3]
    assert ordering.head(frame, [F.col("id")], 0).count() == 5 == ordering.head(frame, [F.col("id")], None).count()
    with pytest.raises(ValueError):
        ordering.batches(frame, [F.col("id")], 0)


def test_payloads(spark):
    sent = screening.payloads(screening.screening_batches(records(spark), 4)).orderBy("batch_id").collect()
    assert [r["batch_rows"] for r in sent] == [4, 4, 4, 4, 4, 3]
    assert sent[0]["track"] == "pathway" and sent[-1]["track"] == ""
    items = [item for r in sent for item in json.loads(r["payload"])]
    assert [len(json.loads(r["payload"])) for r in sent] == [4, 4, 4, 4, 4, 3]
    assert list(items[0]) == [name for name, _ in screening.REQUEST_FIELDS]


def test_screen_merges_and_marks_failures(spark):
    got = {r["doi"]: r for r in screening.screen(records(spark), config(), judge).collect()}
    assert len(got) == 23
    failed = [d for d, r in got.items() if r["ai_rationale_zh"] == "batch_api_error_kept"]
    assert len(failed) == 4 and "10.5555/005" in failed and all(got[d]["ai_pass"] == "true" for d in failed)
    assert got["10.5555/002"]["ai_rationale_zh"] == "ai_missing_judgment" and got["10.5555/002"]["ai_pass"] == "false"
    good = got["10.5555/004"]
    assert (good["ai_pass"], good["ai_rationale_zh"], good["lit_type_zh"], good["ai_category"], good["ai_domain_relevant"]) == (
        "true", "a b", "综述", "hybrid", "true",
    )
    assert got["10.5555/003"]["ai_pass"] == "false"


def test_failed_batches_can_be_dropped(spark):
    cfg = config(keep_on_batch_error=False)
    got = {r["doi"]: r["ai_rationale_zh"] for r in screening.screen(records(spark), cfg, judge).collect()}
    assert got["10.5555/005"] == "ai_missing_judgment"


def test_resume_screens_only_what_is_missing(spark, tmp_path):
    rows = records(spark, 12)
    store = screening.JudgementStore(spark, str(tmp_path / "store"))
    log = tmp_path / "calls"

    def counting(system, payload):
        with open(log, "a") as handle:
            handle.write(payload + "\n")
        return judge(system, payload)

    first = screening.screen(rows, config(), counting, store=store).collect()
    assert len(log.read_text().splitlines()) == 3
    again = screening.screen(rows, config(), counting, store=store, resume=True).collect()
    # Batches whose records all have a result or a failure are not sent again.
    calls = len(log.read_text().splitlines()) - 3
    assert calls == sum(1 for r in [first] if any(x["ai_rationale_zh"] == "ai_missing_judgment" for x in r))
    key = lambda found: sorted((r["doi"], r["ai_pass"], r["ai_rationale_zh"]) for r in found)
    assert key(first) == key(again)


def test_a_new_run_forgets_earlier_results(spark, tmp_path):
    rows = records(spark, 6)
    store = screening.JudgementStore(spark, str(tmp_path / "store"))
    told = lambda found: sorted((r["doi"], r["ai_pass"], r["ai_rationale_zh"]) for r in found.collect())
    first = told(screening.screen(rows, config(), judge, store=store))
    silent = told(screening.screen(rows, config(), lambda system, payload: "[]", store=store))
    assert {r[2] for r in silent if r[0]} == {"ai_missing_judgment"} and silent != first
    resumed = told(screening.screen(rows, config(), judge, store=store, resume=True))
    assert resumed == first
    signature = screening.table_signature(rows, screening.text("doi")).first()["signature"]
    store.clear(signature)
    assert store.judgements(signature).isEmpty() and store.failed(signature).isEmpty()


def test_a_dying_scorer_keeps_finished_groups(spark, tmp_path):
    rows, log = records(spark, 40), tmp_path / "calls"
    log.mkdir()
    store = screening.JudgementStore(spark, str(tmp_path / "store"))
    cfg = config(batches_per_group=2)

    def dying(down):
        def ask(system, payload):
            dois = [item["doi"] for item in json.loads(payload)]
            (log / f"{dois[0][-3:]}-{time.time_ns()}").write_text("")
            if down and "10.5555/020" in dois:
                raise screening.ScorerDown("out of quota")
            return json.dumps([{"doi": d, "pass_filter": True} for d in dois])

        return ask

    with pytest.raises(Exception, match="1 units are missing: .*ScorerDown: out of quota"):
        screening.screen(rows, cfg, dying(True), store=store).count()
    signature = screening.table_signature(rows, screening.text("doi")).first()["signature"]
    done = store.replies(signature).count()
    assert done == 8
    asked = len(list(log.iterdir()))
    again = screening.screen(rows, cfg, dying(False), store=store, resume=True).collect()
    assert len(again) == 40 and {r["ai_pass"] for r in again} == {"true"}
    assert len(list(log.iterdir())) - asked == 2 and store.replies(signature).count() == 10


@pytest.mark.parametrize("seconds, shared", [(3600.0, True), (0.0, False)])
def test_quick_groups_share_files(spark, tmp_path, monkeypatch, seconds, shared):
    monkeypatch.setattr(screening, "LAND_SECONDS", seconds)
    rows, store = records(spark, 60), screening.JudgementStore(spark, str(tmp_path / "store"))
    cfg = config(batches_per_group=1)

    def judge(system, payload):
        dois = [item["doi"] for item in json.loads(payload)]
        if "10.5555/020" in dois:
            raise screening.ScorerDown("out of quota")
        return json.dumps([{"doi": d, "pass_filter": True} for d in dois])

    with pytest.raises(Exception, match="1 units are missing: .*ScorerDown: out of quota"):
        screening.screen(rows, cfg, judge, store=store).count()
    signature = screening.table_signature(rows, screening.text("doi")).first()["signature"]
    batches = -(-60 // cfg.batch_size)
    files = [p for p in (tmp_path / "store" / "replies" / f"signature={signature}").iterdir() if p.suffix == ".parquet"]
    # 4 tasks at most; a group that went wrong takes none of its file with it.
    assert len(files) <= 4 if shared else len(files) == batches - 1
    assert store.replies(signature).count() == batches - 1
    # What a repeated task lands again counts once.
    (files[0].parent / "again.parquet").write_bytes(files[0].read_bytes())
    assert store.replies(signature).count() == batches - 1


def test_tasks_share_the_request_rate(spark, tmp_path):
    log = tmp_path / "calls"
    log.mkdir()

    def ask(system, payload):
        (log / f"{time.time_ns()}-{os.getpid()}").write_text("")
        return "[]"

    cfg = screening.ScreeningConfig(batch_size=1, only_keep_passed=False, request_interval_sec=0.1, batches_per_group=2)
    screening.screen(records(spark, 30), cfg, ask).count()
    calls = sorted(tuple(map(int, p.name.split("-"))) for p in log.iterdir())
    seconds = (calls[-1][0] - calls[0][0]) / 1e9
    assert len(calls) == 30 and len({pid for _, pid in calls}) > 1
    # 4 tasks of at most 10 requests, 0.4 s apart; all together no more than 10 a second beyond the first of each task.
    assert seconds >= 0.1 * (30 - 4) * 0.9


@pytest.mark.parametrize("reply, dois, state", [
    ('[{"doi": "10.5555/a"}, {"doi": "10.5555/b"}]', ["a", "b"], (0, 0, 0)),
    ('Sure: [{"doi": "10.5555/a", "rationale_zh": "x, y"}, {"doi": "10.5555/b",},] Bye', ["a", "b"], (0, 1, 0)),
    ('```\n[{"doi": "10.5555/a"}, {"doi": "10.5555/b", "compound', ["a"], (0, 1, 1)),
    ('[{"doi": "10.5555/a"}, {doi 1}, {"doi": "10.5555/c"}]', ["a", "c"], (0, 1, 1)),
    ('{"doi": "10.5555/a"}', None, (1, 0, 0)), ("", None, (1, 0, 0)), (None, None, (1, 0, 0)), ("[]", [], (0, 0, 0)), ("no", None, (1, 0, 0)), ("[{x", None, (1, 0, 0)),
])
def test_replies_are_mended(spark, reply, dois, state):
    frame = spark.createDataFrame([(1, ["10.5555/z"], reply)], "batch_id long, dois array<string>, reply string")
    good, failed = screening.parse_replies(frame)
    assert [r["doi"] for r in good.orderBy("position").collect()] == [f"10.5555/{d}" for d in dois or []]
    assert failed.count() == (dois is None)
    row = screening.reply_stats(frame).first()
    assert (row["ai_batches"], row["ai_errors"], row["ai_mended"], row["ai_broken_items"]) == (1, *state)


def test_field_limits_are_settings(spark):
    long = spark.createDataFrame([(0, "s", "", "10.5555/a", "t" * 900, "j", "2024", "a" * 5000, "p" * 600, "hybrid")], SCHEMA)
    item = lambda **kw: json.loads(screening.payloads(screening.screening_batches(long, 4), config(**kw)).first()["payload"])[0]
    assert [len(item()[c]) for c in ("title", "abstract", "publication_types")] == [900, 5000, 600]
    assert [len(item(title_limit=800, abstract_limit=3500, types_limit=500)[c]) for c in ("title", "abstract", "publication_types")] == [800, 3500, 500]


def test_off_and_without_key(spark, monkeypatch):
    monkeypatch.delenv("SCREENING_API_KEY", raising=False)
    off = screening.screen(records(spark), screening.ScreeningConfig(enabled=False)).first()
    assert all(off[c] == "" for c in AI_COLUMNS)
    skipped = screening.screen(records(spark), config()).first()
    assert (skipped["ai_pass"], skipped["ai_rationale_zh"]) == ("", "skipped_no_api_key")
    with pytest.raises(RuntimeError):
        screening.screen(records(spark), config(fail_if_missing_key=True))


def test_prompts():
    assert screening.TRACK_PROMPTS["gce"] in screening.system_prompt("gce")
    assert screening.system_prompt("other").endswith(screening.DEFAULT_PROMPT)
    prompts = {"system_prompt_gce": "mine", "extra_instructions": "all", "extra_instructions_gce": "own"}
    assert screening.system_prompt("GCE", prompts) == "mine\n\nown"
    assert screening.system_prompt("hybrid", prompts).endswith("\n\nall")
