"""Command line: one ATS record and one résumé to two JSON profiles."""

from __future__ import annotations

import argparse
import logging
from pathlib import Path

MARKS = {logging.INFO: "✓", logging.WARNING: "⚠", logging.ERROR: "✗"}


def progress(name: str = "rosterloom") -> logging.Logger:
    """A logger that prints a stage in 25 columns and a mark for the level."""
    log = logging.getLogger(name)
    if not log.handlers:
        handler = logging.StreamHandler()
        handler.format = lambda r: f"{MARKS.get(r.levelno, ' ')} {getattr(r, 'stage', ''):<25}{r.getMessage()}"
        log.addHandler(handler)
        log.setLevel(logging.INFO)
    return log


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--ats", default="data/input/ats.json")
    parser.add_argument("--resume", default="data/input/resume.txt")
    parser.add_argument("--config", default="config.yaml")
    parser.add_argument("--output", default="data/output")
    args = parser.parse_args(argv)
    if not Path(args.ats).exists():
        parser.error(f"{args.ats} doesn't exist")
    from pyspark.sql import SparkSession

    from rosterloom.plans.pipeline import run_pair
    from rosterloom.sources import config

    log, spark = progress(), SparkSession.builder.appName("rosterloom").getOrCreate()
    for wrong in config.check(config.load(args.config)):
        log.warning(wrong, extra={"stage": "Config"})
    out = run_pair(spark, args.ats, args.resume, args.config, args.output)
    log.info(f"Overall confidence: {out['canonical']['overall_confidence']}", extra={"stage": "Done"})
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
