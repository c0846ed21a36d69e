"""Command line: ``python -m papersieve run|search|ai|trial|import-library|repair|export|clear|keywords|check``."""

from __future__ import annotations

import argparse
import json
import os
import sys
from datetime import date

from . import vocabulary as V
from .functions.dates import run_window
from .operators import search
from .schema import TRACKS


def load_config(path: str) -> dict:
    with open(path, encoding="utf-8") as handle:
        if path.endswith(".json"):
            return json.load(handle)
        try:
            import yaml
        except ImportError as error:
            raise SystemExit("YAML configurations need PyYAML; use JSON instead") from error
        return yaml.safe_load(handle) or {}


def print_keywords() -> None:
    print("core terms:", *V.CORE_TERMS, sep="\n  ")
    for track in TRACKS:
        pubmed, works = search.pubmed_queries(track), search.crossref_queries(track)
        compounds = V.GCE_KEY_COMPOUNDS if track == "gce" else V.KEY_COMPOUNDS
        print(f"[{track}] {len(compounds) + len(V.METHOD_SIGNALS[track])} signals, "
              f"{len(works)} phrase searches, {len(pubmed)} field searches")
        for query in pubmed:
            print("   ", query if len(query) <= 120 else query[:117] + "...")


def parser() -> argparse.ArgumentParser:
    common = argparse.ArgumentParser(add_help=False)
    common.add_argument("-c", "--config", default="config.json")
    common.add_argument("--date-from", type=date.fromisoformat)
    common.add_argument("--date-to", type=date.fromisoformat)
    common.add_argument("--period", choices=["incremental", "rolling", "this_month", "prev_month"])
    common.add_argument("--track", choices=[*TRACKS, "all"], default="all")
    common.add_argument("--source", choices=["all", "pubmed", "crossref"], default="all")
    common.add_argument("--dry-run", action="store_true")
    common.add_argument("-i", "--input")
    common.add_argument("--label")
    common.add_argument("--resume", action="store_true")
    common.add_argument("--force-ai", action="store_true")
    common.add_argument("--all-years", action="store_true")
    common.add_argument("--skip-ai", action="store_true")
    common.add_argument("--reset-state", action="store_true")
    common.add_argument("--output-dir", help="folder of the outputs, in place of the configured one")
    common.add_argument("--rows", type=int, default=6, help="records of a trial")
    common.add_argument("--target", help="where repair writes its output")
    main_parser = argparse.ArgumentParser(prog="papersieve", description=__doc__)
    commands = main_parser.add_subparsers(dest="command", required=True)
    for name in ("run", "search", "ai", "trial", "import-library", "repair", "export", "clear", "keywords", "check"):
        commands.add_parser(name, parents=[common])
    return main_parser


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    if args.command == "keywords":
        print_keywords()
        return 0
    cfg = load_config(args.config)
    from .plans import runs

    if args.command == "check" or args.dry_run:
        for level, message in runs.validate(cfg, os.path.exists):
            print(f"{level}: {message}", file=sys.stderr)
        from .lexicon import search_term_table
        from .session import build_session

        spark = build_session()
        window = run_window(
            spark, cfg.get("search") or {}, date_from=args.date_from, date_to=args.date_to, period=args.period
        )
        terms = search_term_table(spark, (cfg.get("paths") or {}).get("search_term_table"))
        print("\n".join(runs.preview(cfg, search.resolve_tracks(args.track), window, terms)))
        return 0
    from .session import build_session

    spark = build_session()
    if args.force_ai:
        cfg["ai_screening"] = {**(cfg.get("ai_screening") or {}), "enabled": True}
    if args.reset_state:
        runs.RunState(spark, (cfg.get("paths") or {}).get("state_dir") or "state").reset()
    if args.output_dir:
        cfg["paths"] = {**(cfg.get("paths") or {}), "output_dir": args.output_dir}
    keeper = runs.RunState(spark, (cfg.get("paths") or {}).get("state_dir") or "state")
    if args.command == "clear":
        from .operators.screening import JudgementStore

        _, info = keeper.load_pending(allow_empty=True)
        JudgementStore(spark, f"{keeper.folder}/screening").clear(info["signature"])
        print(json.dumps({"cleared": info["signature"]}))
        return 0
    if args.command == "trial":
        print(json.dumps(runs.trial_run(spark, cfg, args.rows), ensure_ascii=False, indent=2))
        return 0
    if args.command == "repair":
        if not args.input or not args.target:
            raise SystemExit("repair needs --input and --target")
        pending, _ = keeper.load_pending()
        print(json.dumps({"rows": runs.repair_run(spark, args.input, pending, args.target), "output": args.target}))
        return 0
    ai = bool((cfg.get("ai_screening") or {}).get("enabled", False))
    out: dict = {}
    if args.command in ("run", "search"):
        if any(level == "fatal" for level, _ in runs.validate(cfg, os.path.exists)):
            return 1
        out["search"] = runs.search_run(
            spark, cfg, track=args.track, source=args.source, date_from=args.date_from,
            date_to=args.date_to, period=args.period, resume=args.resume,
        )
    if args.command == "ai" or (args.command == "run" and ai):
        out["ai"] = runs.screen_run(spark, cfg, resume=args.resume)
    if args.command == "import-library":
        out["import"] = runs.import_library_run(
            spark, cfg, all_years=args.all_years, skip_ai=args.skip_ai,
            date_from=str(args.date_from) if args.date_from else None,
            date_to=str(args.date_to) if args.date_to else None,
        )
    imported = (out.get("import") or {}).get("imported", 0) and not args.skip_ai
    if args.command == "export" or (args.command == "run" and ai) or imported:
        source = args.input or (out.get("import") or {}).get("output_csv") or None
        out["export"] = runs.export_run(spark, cfg, source, args.label)
    print(json.dumps(out, ensure_ascii=False, indent=2, default=str))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
