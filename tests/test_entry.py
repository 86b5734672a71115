"""The driver's entry points, with and without the training-data operators."""

import os
import shutil
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
COUNT = "import __spark_entry__ as e; print(len(e.queries()), set(e.oracle_sql()) <= set(e.queries()))"


HIDE = "import sys; sys.modules[{!r}] = None; "


def registered(folder, hidden=None):
    code = (HIDE.format(hidden) if hidden else "") + COUNT
    done = subprocess.run([sys.executable, "-B", "-c", code], cwd=folder, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr[-800:]
    n, known = done.stdout.split()
    assert known == "True"
    return int(n)


def test_the_rest_stands_alone(tmp_path):
    from fleetlake.catalog.queries import QUERIES
    bare = tmp_path / "bare"
    shutil.copytree(REPO, bare, ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__"))
    assert registered(bare) == len(QUERIES)
    (bare / "fleetlake" / "llm").mkdir()  # an empty folder is no package either
    assert registered(bare) == len(QUERIES)
    assert registered(REPO) >= len(QUERIES)


def test_a_missing_library_costs_its_operators_only():
    from fleetlake.catalog.queries import QUERIES
    for name in ("duckdb", "xxhash", "public_tokenizers", "tokenizers", "regex"):
        assert registered(REPO, name) == len(QUERIES)
