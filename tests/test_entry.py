"""The driver contract without the optional text operators."""

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent

#: Hides modules as if their files were deleted, then lists what the entry registers.
PROGRAM = """
import sys
from importlib.abc import MetaPathFinder
from importlib.machinery import PathFinder

hidden = set(sys.argv[1].split(","))
find = PathFinder.find_spec
PathFinder.find_spec = classmethod(lambda cls, name, path=None, target=None: None if any(name == h or name.startswith(h + ".") for h in hidden) else find(name, path, target))
import __spark_entry__
print(",".join(sorted(__spark_entry__.queries())))
"""


@pytest.mark.parametrize("hidden", ["marketmill.llm", "marketmill.llm,corpus_pipeline"])
def test_market_queries_stay_without_text_operators(hidden):
    from checks.catalog import QUERIES

    run = subprocess.run([sys.executable, "-c", PROGRAM, hidden], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert run.returncode == 0, run.stderr
    assert run.stdout.strip().split(",") == sorted(QUERIES)
