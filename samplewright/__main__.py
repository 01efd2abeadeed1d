"""Command line: `python -m samplewright check SHEET OUT`, `help`, `version`.

Exit codes: 0 done, 1 the sheet breaks a rule, 2 the sheet isn't there (as for wrong arguments).
"""

from __future__ import annotations

import argparse
import logging
import sys
from collections.abc import Sequence
from importlib.metadata import PackageNotFoundError, version

from pyspark.sql import SparkSession

LEVELS = ("CRITICAL", "ERROR", "WARNING", "INFO", "DEBUG")
log = logging.getLogger("samplewright")


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="samplewright", description="Checks sample sheets and explains run parameters.")
    out.add_argument("-l", "--log-level", choices=LEVELS, default="WARNING")
    commands = out.add_subparsers(dest="command", required=True)
    check = commands.add_parser("check", help="write a sheet anew if it keeps all rules")
    check.add_argument("sheet", help="path of the sheet, as Hadoop knows it")
    check.add_argument("out", help="path of the checked sheet")
    shown = commands.add_parser("parameters", help="list the parameters of a run")
    shown.add_argument("--all", action="store_true", help="hidden ones too")
    commands.add_parser("version", help="print the version")
    return out


def main(arguments: Sequence[str] | None = None, spark: SparkSession | None = None) -> int:
    given = parser().parse_args(arguments)
    logging.basicConfig(level=given.log_level, format="[%(levelname)s] %(message)s")
    if given.command == "version":
        try:
            print(version("samplewright"))
        except PackageNotFoundError:
            print("not installed")
        return 0
    session = spark or SparkSession.builder.appName("samplewright").getOrCreate()
    if given.command == "parameters":
        from samplewright.operators import params

        for row in params.help_lines(params.standard_schema(session), show_hidden=given.all).orderBy("ordinal").collect():
            print(row["line"])
        return 0
    from samplewright.operators.sheet import SheetError
    from samplewright.sources import config
    from samplewright.sources.sheet import check_sheet

    if not config.exists(session, given.sheet):
        log.error("there is no sheet at %s", given.sheet)
        return 2
    try:
        check_sheet(session, given.sheet, given.out)
    except SheetError as fault:
        log.critical("%s", fault)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
