"""The core stands without the subpackage for training data."""

from __future__ import annotations

import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
TELL = "import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql(); print(len(q), len(o), any(n[0] == 'p' and n[1].isdigit() and n[1] != '7' for n in q))"


def test_queries_without_the_subpackage(tmp_path):
    shutil.copytree(ROOT / "lexstrata", tmp_path / "lexstrata", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    queries, oracles, others = subprocess.run([sys.executable, "-c", TELL], cwd=tmp_path, capture_output=True, text=True, check=True, env={"PATH": "/usr/bin:/bin", "HOME": str(tmp_path)}).stdout.split()
    assert int(queries) > 50 and int(oracles) > 40 and others == "False"


def test_another_missing_module_is_an_error(tmp_path):
    shutil.copytree(ROOT / "lexstrata", tmp_path / "lexstrata", ignore=shutil.ignore_patterns("__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    (tmp_path / "lexstrata/llm/queries.py").write_text("import no_such_module_at_all\n") if (tmp_path / "lexstrata/llm").exists() else None
    done = subprocess.run([sys.executable, "-c", TELL], cwd=tmp_path, capture_output=True, text=True, env={"PATH": "/usr/bin:/bin", "HOME": str(tmp_path)})
    assert (done.returncode != 0 and "no_such_module_at_all" in done.stderr) == (ROOT / "lexstrata/llm").exists()
