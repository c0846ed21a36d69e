import glob
import json
import os

import pytest
from pyspark.sql import functions as F

from papersieve.operators import history, overlay
from papersieve.plans import runs
from papersieve.schema import BASE_COLUMNS, TRACKS
from papersieve.sinks import csv_output as sink
from papersieve.sources.csv_files import latest_run_file, read_csv, run_files

SCHEMA = "ingest_seq long, " + ", ".join(f"{c} string" for c in (*BASE_COLUMNS, "track"))


def record(seq, doi, title, track="hybrid", types="Journal Article"):
    return (seq, "pubmed", str(seq), doi, title, "J", "2024-03", 'Line one,\r\nsays "norvaline"', types, track)


def config(tmp_path, **extra):
    (tmp_path / "master.csv").write_text("DOI,Filename\nhttps://doi.org/10.5555/M1,a.pdf\n10.5555/LIB1,b.pdf\n10.5555/LIB1,c.pdf\n10.5555/LIB2,d.pdf\n")
    return {
        "paths": {
            "master_csv": str(tmp_path / "master.csv"), "master_metadata_csv": str(tmp_path / "meta.csv"),
            "output_dir": str(tmp_path / "out"), "state_dir": str(tmp_path / "state"),
        },
        "search": {"date_range_mode": "explicit", "date_from": "2024-01-01", "date_to": "2024-12-31"},
        "article_type_filter": {"enabled": True}, "literature_cleaner": {"enabled": True},
        "deduplication": {"use_master_csv": False, "dedupe_by_title": True, "dedupe_by_title_and_pub_date": True,
                          "previous_output_glob": "new_dois_*.csv"},
        "ai_screening": {"enabled": True, "batch_size": 2, "only_keep_passed": False, "request_interval_sec": 0},
        "output": {"save_combined_in_run_dir": True, "save_legacy_flat_file": True},
        **extra,
    }


def _scorer():
    # Nested, so that it travels to the workers by value.
    def judge(system, payload):
        return json.dumps([
            {"doi": i["doi"], "article_type": "research_article", "pass_filter": not i["doi"].endswith("3"), "category": "gce"}
            for i in json.loads(payload)
        ])

    return judge


judge = _scorer()


ROWS = [
    record(0, "10.5555/M1", "Enzymatic route to norvaline one"),
    record(1, "10.5555/a2", "Enzymatic route to norvaline two", "chemical"),
    record(2, "10.5555/a2", "Enzymatic route to norvaline two"),
    record(3, "10.5555/a3", "Enzymatic route to something three", ""),
    record(4, "10.5555/a4", "Recent advances in routes and more"),
    record(5, "10.5555/a5", "Enzymatic route to norvaline five", types="Letter"),
]


def test_search_screen_export(spark, tmp_path):
    cfg = config(tmp_path)
    out = runs.search_run(spark, cfg, records=spark.createDataFrame(ROWS, SCHEMA))
    stats = out["stats"]
    assert (stats["total_raw"], stats["new_count"], stats["skipped_duplicate_in_batch"]) == (4, 3, 1)
    assert stats["article_type_dropped"] == 1 and stats["literature_cleaner_drop_title_prefix"] == 1
    assert stats["literature_cleaner_kept"] == 4 and stats["title_filter_kept"] == 3
    assert sorted(os.path.basename(p) for p in glob.glob(out["output"] + "/*.csv")) == sorted(
        [*sink.TRACK_FILES.values(), "all.csv"]
    )
    written = read_csv(spark, out["output"] + "/all.csv").fillna("")
    assert written.columns[0] == "doi" and written.count() == 3
    cells = {r["doi"]: r for r in written.collect()}
    assert cells["10.5555/m1"]["local_has_pdf"] == "true" and cells["10.5555/a2"]["local_has_pdf"] == "false"
    assert cells["10.5555/a2"]["abstract"] == 'Line one,\nsays "norvaline"' and cells["10.5555/a2"]["compounds"] == "Nva"
    assert read_csv(spark, out["output"] + "/gce.csv").count() == 0
    part = glob.glob(out["output"] + "/all.csv/part-*")[0]
    assert open(part, "rb").read(3) == b"\xef\xbb\xbf"

    screened = runs.screen_run(spark, cfg, judge)
    assert screened["signature"] == out["pending"]["signature"]
    table = read_csv(spark, screened["output"] + "/all.csv").fillna("")
    assert {r["doi"]: r["ai_pass"] for r in table.collect()} == {"10.5555/m1": "true", "10.5555/a2": "true", "10.5555/a3": "false"}

    summary = runs.export_run(spark, cfg, screened["output"] + "/all.csv", label="t")
    assert (summary["total_input"], summary["total_usable"]) == (3, 2)
    assert summary["by_track"] == {**{t: 0 for t in TRACKS}, "hybrid": 1, "chemical": 1}
    assert json.loads(open(summary["files"]["summary"], encoding="utf-8").read())["total_usable"] == 2
    assert read_csv(spark, summary["files"]["hybrid"]).count() == 1

    again = runs.search_run(spark, cfg, records=spark.createDataFrame(ROWS, SCHEMA))
    assert again["stats"]["new_count"] == 0 and again["stats"]["skipped_duplicate_in_master"] == 4


def test_import_library(spark, tmp_path):
    cfg = config(tmp_path)
    (tmp_path / "meta.csv").write_text(
        "DOI,title,journal,year\n10.5555/LIB1,An unnatural amino acid by transaminase,J,2024.0\n"
        "10.5555/LIB2,Amber suppression in yeast,J,2019\n10.5555/LIB9,Amber suppression in cells,J,2024\n,Amber suppression,J,\n"
    )
    first = runs.import_library_run(spark, cfg, skip_ai=True)
    assert (first["candidates"], first["imported"]) == (2, 2)
    rows = read_csv(spark, first["output_csv"]).collect()
    assert [(r["doi"], r["track"], r["source"]) for r in rows] == [("10.5555/lib1", "enzymatic", "master_library")] * 2
    assert runs.import_library_run(spark, cfg, skip_ai=True)["imported"] == 0
    wider = runs.import_library_run(spark, cfg, judge, all_years=True)
    assert (wider["candidates"], wider["imported"]) == (3, 1)
    assert read_csv(spark, wider["output_csv"]).count() == 3


def test_state_and_pending(spark, tmp_path):
    keeper = runs.RunState(spark, str(tmp_path))
    assert keeper.load() == {}
    keeper.save({"pubmed_last_run": "2024-01-01"})
    assert keeper.load() == {"pubmed_last_run": "2024-01-01"}
    keeper.reset()
    assert keeper.load() == {}
    with pytest.raises(FileNotFoundError):
        keeper.load_pending()
    keeper.save_pending(spark.createDataFrame([], SCHEMA), {})
    with pytest.raises(ValueError):
        keeper.load_pending()


def test_incremental_run_moves_the_date(spark, tmp_path):
    cfg = config(tmp_path, search={"date_range_mode": "incremental", "date_to": "2024-03-15"})
    runs.search_run(spark, cfg, records=spark.createDataFrame(ROWS[:1], SCHEMA), source="crossref")
    state = runs.RunState(spark, cfg["paths"]["state_dir"]).load()
    assert state == {"crossref_last_run": "2024-03-16"}


def test_known_doi_sources(spark, tmp_path):
    out = tmp_path / "out" / "2024-01-01"
    out.mkdir(parents=True)
    (out / "all.csv").write_text("Doi,title\n10.5555/OLD,x\n")
    (out / "pathway.csv").write_text("name\nno id column\n")
    (tmp_path / "extra.csv").write_text("id,DOI\n1,doi:10.5555/X\n2,\n")
    cfg = config(tmp_path)
    cfg["paths"]["extra_doi_csvs"] = [{"path": str(tmp_path / "extra.csv"), "doi_column": "missing"}, {"path": " "}, {"path": str(tmp_path / "gone.csv")}]
    got = {r["doi"] for r in history.known_from_config(spark, cfg["paths"], cfg["deduplication"]).collect()}
    assert got == {"10.5555/old", "10.5555/x"}
    full = {r["doi"] for r in history.known_from_config(spark, cfg["paths"], {"include_previous_outputs": False}).collect()}
    assert full == {"10.5555/x", "10.5555/m1", "10.5555/lib1", "10.5555/lib2"}
    assert len(run_files(spark, str(tmp_path / "out"), "new_dois_*.csv")) == 2
    assert latest_run_file(spark, str(tmp_path / "out"), "new_dois_*.csv").endswith("all.csv")
    assert latest_run_file(spark, str(tmp_path / "none"), "x*.csv") is None


def test_all_track_files_of_earlier_runs_count(spark, tmp_path):
    out = tmp_path / "out" / "run"
    out.mkdir(parents=True)
    (out / "gce.csv").write_text("doi,title\n10.5555/g,x\n")
    (out / "mine.csv").write_text("doi,title\n10.5555/m,x\n")
    paths = {"output_dir": str(tmp_path / "out")}
    known = lambda files: {r["doi"] for r in history.known_from_config(spark, paths, {}, files).collect()}
    assert known(None) == {"10.5555/g"} and known({"hybrid": "mine.csv"}) == {"10.5555/g", "10.5555/m"}


def test_empty_run_and_repair_order(spark, tmp_path):
    cfg = config(tmp_path)
    runs.RunState(spark, cfg["paths"]["state_dir"]).save_pending(spark.createDataFrame([], SCHEMA), {})
    assert runs.screen_run(spark, cfg)["output"] is None
    csv = tmp_path / "screened.csv"
    csv.mkdir()
    (csv / "part-00000.csv").write_text("doi,title,ai_pass\n10.5555/a,t,first\n" + "".join(f"10.5555/z{i},t,x\n" for i in range(300)))
    (csv / "part-00001.csv").write_text("doi,title,ai_pass\n10.5555/a,t,last\n")
    pending = spark.createDataFrame([(0, "10.5555/a", "t", "old")], "ingest_seq long, doi string, title string, ai_pass string")
    assert runs.repair_run(spark, str(csv), pending, str(tmp_path / "fixed.csv")) == 1
    assert read_csv(spark, str(tmp_path / "fixed.csv")).first()["ai_pass"] == "last"


def test_repair_and_append(spark):
    base = spark.createDataFrame([(0, "DOI:10.5555/A", "t", "old"), (1, "10.5555/b", "t", "old"), (2, "", "t", "old")],
                                 "ingest_seq long, doi string, title string, ai_pass string")
    out = spark.createDataFrame([(0, "10.5555/a", "no", "x", "1"), (1, "10.5555/a", "yes", "x", ""), (2, "bad", "z", "x", "")],
                                "ingest_seq long, doi string, ai_pass string, title string, fetched_at string")
    got = overlay.repair(base, out).orderBy("ingest_seq").collect()
    assert [(r["title"], r["ai_pass"], r["fetched_at"]) for r in got] == [("t", "yes", ""), ("t", "old", "")]
    merged = overlay.append_rows(base.drop("ingest_seq"), out.select("doi", F.lit("nan").alias("extra")), F.lit("now"))
    assert merged.count() == 6 and merged.columns == ["doi", "title", "ai_pass", "extra", "fetched_at"]
    assert merged.filter("extra = '' and fetched_at = 'now'").count() == 3


def test_older_column_names(spark):
    from papersieve.schema import adopt_columns

    old = spark.createDataFrame([("", "hybrid", "x"), ("gce", "hybrid", None)], "track string, old_track string, old_cat string")
    got = adopt_columns(old, {"old_track": "track", "old_cat": "ai_category", "none": "doi"})
    assert [tuple(r) for r in got.collect()] == [("hybrid", "x"), ("gce", "")]


def test_validation_and_preview(tmp_path):
    cfg = {"paths": {"master_csv": "/none.csv"}, "pubmed": {"email": "a@example.com"}, "crossref": {"mailto": "me@lab.org"},
           "ai_screening": {"enabled": True, "fail_if_missing_key": True, "api_key_env": "NO_SUCH_KEY"}}
    assert [level for level, _ in runs.validate(cfg, os.path.exists)] == ["fatal", "warning", "warning"]
    from datetime import date

    lines = runs.preview(cfg, ["hybrid"], (date(2024, 1, 1), date(2024, 2, 1)))
    assert lines[0] == "window 2024-01-01 .. 2024-02-01" and "hybrid" in lines[1]


def test_many_earlier_files_are_a_few_scans(spark, tmp_path):
    out = tmp_path / "out"
    out.mkdir()
    layouts = [["doi", "title"], ["title", "DOI", "note"], ["a", "b"], ["Doi"]]
    for i in range(60):
        names = layouts[i % 4]
        cells = {"doi": f"10.5555/x{i}", "DOI": f"https://doi.org/10.5555/X{i}", "Doi": f"10.5555/x{i % 8}", "title": f'"a, ""b""\nline {i}"'}
        bom = "\ufeff" if i % 3 == 0 else ""
        (out / f"new_dois_{i}.csv").write_text(bom + ",".join(names) + "\n" + ",".join(cells.get(n, "z") for n in names) + "\n", encoding="utf-8")
    spark.createDataFrame([("t", "10.5555/part")], "title string, doi string").write.option("header", True).csv(str(out / "new_dois_p.csv"))
    (out / "new_dois_e.csv").write_text("")
    found = history.dois_of_runs(spark, str(out), "new_dois_*.csv")
    want = {f"10.5555/x{i}" for i in range(60) if i % 4 < 2} | {"10.5555/x3", "10.5555/x7", "10.5555/part"}
    assert {r["doi"] for r in found.collect()} == want
    # One scan for each order of columns with a DOI, with and without a byte order mark.
    assert found._jdf.queryExecution().analyzed().toString().count("csv") <= 8


def test_trial_screens_some_rows_and_stores_nothing(spark, tmp_path):
    cfg = config(tmp_path)
    runs.search_run(spark, cfg, records=spark.createDataFrame(ROWS, SCHEMA))
    before = sorted(glob.glob(str(tmp_path / "**"), recursive=True))
    got = runs.trial_run(spark, cfg, 2, judge)
    assert len(got) == 2 and {g["ai_article_type"] for g in got} == {"research_article"}
    assert sorted(glob.glob(str(tmp_path / "**"), recursive=True)) == before
