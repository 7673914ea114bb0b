"""The queries in a copy of the repository from which the optional folders are gone."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as own

ROOT = Path(__file__).resolve().parent.parent
OPTIONAL = ("dayledger/llm", "tests/llm")
NAMES = "import __spark_entry__ as e; print(*sorted(e.queries())); print(*sorted(e.oracle_sql()))"


@pytest.mark.parametrize("pipeline", [True, False])
def test_queries_without_the_optional_folders(tmp_path, pipeline):
    left = {*OPTIONAL, ".git"} | (set() if pipeline else {"corpus_pipeline.py"})

    def ignore(folder, names):
        here = Path(folder).relative_to(ROOT)
        return [n for n in names if str(here / n) in left or n == "__pycache__"]

    shutil.copytree(ROOT, tmp_path / "copy", ignore=ignore)
    done = subprocess.run(
        [sys.executable, "-c", NAMES], cwd=tmp_path / "copy", capture_output=True, text=True
    )
    assert done.returncode == 0, done.stderr
    library = sorted(own._QUERIES)
    assert len(library) >= 39
    assert [line.split() for line in done.stdout.splitlines()] == [library, library]
