"""Run a load from the command line or with spark-submit.

python -m playmart load  --logs 'logs/*/*/*-events.json' --songs 'songs/*/*/*/*.json' --root mart --style lake
python -m playmart month --logs 'logs/{year}/{month}' --songs songs --root mart --date 2018-11-01
"""

from __future__ import annotations

import argparse
import datetime as dt
from collections.abc import Sequence

from playmart.plans import etl
from playmart.session import build_session


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="playmart", description="Load raw feeds into a star schema.")
    commands = parser.add_subparsers(dest="command", required=True)
    for name, style in (("load", "lake"), ("month", "scheduled")):
        command = commands.add_parser(name)
        command.add_argument("--logs", required=True, help="log files; for a month a path with {year} and {month}")
        command.add_argument("--songs", required=True)
        command.add_argument("--root", required=True, help="where the tables go")
        command.add_argument("--style", default=style, choices=sorted(etl.DIALECTS))
        command.add_argument("--max-corrupt", type=int, default=0, help="corrupt rows of a feed a load may put aside")
        command.add_argument("--master", help="Spark master, if spark-submit does not set it")
    commands.choices["load"].add_argument("--recursive", action="store_true")
    commands.choices["month"].add_argument("--date", required=True, type=dt.date.fromisoformat)
    return parser


def main(arguments: Sequence[str] | None = None) -> etl.Loaded:
    options = _parser().parse_args(arguments)
    spark = build_session("playmart", options.master)
    dialect = etl.DIALECTS[options.style]
    if options.command == "load":
        return etl.run(
            spark, options.logs, options.songs, options.root, dialect,
            recursive=options.recursive, max_corrupt=options.max_corrupt,
        )
    return etl.load_period(
        spark, options.logs, options.songs, options.date, options.root, dialect, max_corrupt=options.max_corrupt
    )


if __name__ == "__main__":
    loaded = main()
    for (table, period), path in sorted(loaded.paths.items()):
        print(table, period, path)
    for feed, rows in loaded.rejected.items():
        print(f"corrupt rows of the {feed} feed: {rows}")
