"""The entry module with and without the optional training-data subpackage."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
COUNT = "import __spark_entry__ as e; from tessera.plans import registry as r; q = e.queries(); assert set(r.queries()) <= set(q) and set(e.oracle_sql()) <= set(q); print(len(q) - len(r.queries()))"


@pytest.mark.parametrize("gone", [("tessera/llm", "tests/llm"), ("tessera/llm", "tests/llm", "corpus_pipeline.py")])
def test_engine_lives_without_the_subpackage(tmp_path, gone):
    copy = tmp_path / "repo"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "__pycache__", "spark-warehouse"))
    for name in gone:
        path = copy / name
        if path.is_dir():
            shutil.rmtree(path)
        else:
            path.unlink(missing_ok=True)
    out = subprocess.run([sys.executable, "-c", COUNT], cwd=copy, capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr
    assert out.stdout.strip() == "0"


def test_every_query_is_callable():
    sys.path.insert(0, str(ROOT))
    import __spark_entry__ as entry

    assert all(callable(f) for f in entry.queries().values())
    assert set(entry.oracle_sql()) <= set(entry.queries())
