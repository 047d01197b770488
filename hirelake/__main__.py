"""Command line: ``spark-submit … -m hirelake <step> [--source S]``, settings from the environment."""

from __future__ import annotations

import argparse
import logging

from hirelake.functions.rules import SOURCES
from hirelake.params import RunParams
from hirelake.plans.cards import run_cards
from hirelake.plans.daily import run_clear, run_day, run_gold
from hirelake.plans.details import run_details
from hirelake.plans.silver import run_silver
from hirelake.session import build_session


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="hirelake")
    parser.add_argument("step", choices=["cards", "details", "silver", "gold", "day", "clear"])
    parser.add_argument("--source", choices=SOURCES)
    parser.add_argument("--keep-days", type=float, default=7, help="clear: what was shown within so many days stays")
    options = parser.parse_args(arguments)
    if options.step in ("cards", "details", "silver") and not options.source:
        parser.error(f"{options.step} needs --source")
    logging.basicConfig(level=logging.INFO)
    params = RunParams.from_settings()
    spark = build_session(f"hirelake-{options.step}", params.spark_conf)
    try:
        if options.step == "cards":
            run_cards(spark, params, options.source)
        elif options.step == "details":
            run_details(spark, params, options.source)
        elif options.step == "silver":
            run_silver(spark, params, options.source)
        elif options.step == "gold":
            run_gold(spark, params)
        elif options.step == "clear":
            for path in run_clear(spark, params, options.keep_days):
                logging.info("cleared %s", path)
        else:
            run_day(spark, params, parse=True)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
