"""Command line: ``python -m dayledger <job> ...``."""

from __future__ import annotations

import argparse
import json

from dayledger.plans import (
    every_arrival,
    initial_load,
    periodic_update,
    rebuild_all,
    rebuild_delays,
    rebuild_weather,
)
from dayledger.session import build_session


def _files(text: str) -> int | str:
    return text if text == "auto" else int(text)


def _arguments() -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="dayledger")
    jobs = parser.add_subparsers(dest="job", required=True)
    for name in ("initial-load", "periodic-update", "every-arrival"):
        job = jobs.add_parser(name)
        job.add_argument("--registry", required=True)
        job.add_argument("--registry-lines", action="store_true", help="one entry per line")
        job.add_argument("--responses", required=True)
        job.add_argument("--responses-format", help="json or parquet")
        job.add_argument("--output", required=True)
        job.add_argument("--on", nargs="+", help="key of a response")
        if name != "every-arrival":
            job.add_argument("--batch", type=int, help="all stations if not given")
            job.add_argument("--table", help="publish as this table, below the output folder")
        if name != "initial-load":
            job.add_argument("--arrivals", required=True)
        if name == "every-arrival":
            job.add_argument("--ledger", help="folder of what is loaded; below the output unless given")
        if name == "initial-load":
            job.add_argument("--start", help="all landed days if not given")
            job.add_argument("--end")
    for name in ("rebuild-weather", "rebuild-delays", "rebuild-all"):
        job = jobs.add_parser(name)
        job.add_argument("--root", required=True)
        job.add_argument("--changed-only", action="store_true")
        job.add_argument("--by-file", action="store_true", help="read each source file once")
        if name != "rebuild-delays":
            job.add_argument("--cluster-by", nargs="+", help="e.g. date")
            job.add_argument("--plain", action="store_true", help="Parquet without dictionaries")
        tables = {
            "rebuild-weather": ("--base", "--delta", "--target", "--delays", "--view"),
            "rebuild-delays": ("--base", "--delta", "--target"),
        }
        for table in tables.get(name, ()):
            job.add_argument(table, help="catalog name")
    for job in jobs.choices.values():
        job.add_argument("--files", type=_files, help='a number, or "auto"')
    return parser.parse_args()


def main() -> None:
    jobs = {
        "initial-load": initial_load,
        "periodic-update": periodic_update,
        "every-arrival": every_arrival,
        "rebuild-weather": rebuild_weather,
        "rebuild-delays": rebuild_delays,
        "rebuild-all": rebuild_all,
    }
    # What is not given keeps the job's own default.
    options = {key: value for key, value in vars(_arguments()).items() if value is not None}
    job = jobs[options.pop("job")]
    print(json.dumps(job(build_session(), **options)))


if __name__ == "__main__":
    main()
