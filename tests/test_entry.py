"""The entry points, whole and without the corpus operators."""

from __future__ import annotations

import shutil
import subprocess
import sys
from pathlib import Path

REPO = Path(__file__).resolve().parent.parent


def test_entry_points_without_the_corpus_operators(tmp_path):
    shutil.copy(REPO / "__spark_entry__.py", tmp_path)
    shutil.copytree(REPO / "tallyframe", tmp_path / "tallyframe", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    code = "import __spark_entry__ as e; q = e.queries(); assert 'nbv_detail' in q and set(q) == set(e.oracle_sql()); print(len(q))"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    assert int(done.stdout) >= 54


def test_every_report_query_has_sql():
    sys.path.insert(0, str(REPO))
    import __spark_entry__ as entry

    assert {n for n in entry.queries() if not n.startswith("op") and n != "pipeline"} <= set(entry.oracle_sql())
