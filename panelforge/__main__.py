"""Command line: python -m panelforge STEP --raw DIR --lake DIR [--truth DIR] [--out DIR] [--settings FILE]."""

from __future__ import annotations

import argparse
import sys

from panelforge.config import Settings, ambiguous_headers, load_settings, unmapped_defects


def main(argv: list[str] | None = None) -> int:
    from panelforge.plans import ingest, lakehouse, synth

    p = argparse.ArgumentParser(prog="panelforge")
    p.add_argument("step", choices=("doctor", "generate-demo-data", *lakehouse.STEPS, "full-refresh"))
    for name, default in (("raw", "data/raw"), ("lake", "data/lake"), ("truth", "data/truth"), ("out", "data/exports")):
        p.add_argument(f"--{name}", default=default)
    p.add_argument("--settings", help="a file of JSON, TOML or YAML with what differs from the policy")
    p.add_argument("--only", nargs="+", help="of full-refresh, these steps")
    p.add_argument("--upstream", action="store_true", help="with --only, also what they need")
    p.add_argument("--model", help="link with this saved model instead of training one")
    p.add_argument("--profile", default="tiny", choices=("tiny", "demo", "large"))
    p.add_argument("--seed", type=int, default=2026)
    p.add_argument("--force", action="store_true", help="load files again that were loaded before")
    a = p.parse_args(argv)
    from panelforge import session
    from panelforge.operators import linkage
    from panelforge.operators.rules import check_policy

    settings = load_settings(a.settings) if a.settings else Settings()
    if a.step == "doctor":
        check_policy(settings.rules)
        linkage.check_settings(settings)
        bad = unmapped_defects(settings.rules)
        twice = ambiguous_headers(settings.datasets())
        print("defects without one rule:", bad or "none")
        print("headers that two fields claim:", twice or "none")
        return int(bool(bad or twice))
    spark = session.build()
    if a.step == "generate-demo-data":
        synth.generate(spark, a.raw, a.truth, a.profile, a.seed)
    elif a.step == "ingest":
        print(ingest.run(spark, a.raw, a.lake, settings, force=a.force))
    elif a.step == "run-linkage" and a.model:
        lakehouse.run_linkage(spark, a.lake, settings, linkage.load(spark, a.model))
    else:
        only = tuple(a.only) if a.only else None
        steps = only if a.step == "full-refresh" else (a.step,)
        print(*lakehouse.full_refresh(spark, a.raw, a.lake, a.truth, a.out, settings, steps, a.upstream and a.step == "full-refresh"), sep="\n")
    return 0


if __name__ == "__main__":
    sys.exit(main())
