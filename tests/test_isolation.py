"""Without the llm folders and the pipeline everything else imports, and only there is that guarded."""

from __future__ import annotations

import re
import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]


def test_the_rest_stands_alone(tmp_path):
    home = tmp_path / "repo"
    shutil.copytree(ROOT, home, ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__"))
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 60 and 'pipeline' not in q and not any(k.startswith('op') for k in q); assert set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-B", "-c", code], cwd=home, check=True)


def test_nothing_else_imports_the_subpackage():
    for p in ROOT.rglob("*.py"):
        parts = p.relative_to(ROOT).parts
        if "llm" not in parts and p.name not in ("corpus_pipeline.py", "__spark_entry__.py") and p != Path(__file__):
            assert not re.search(r"^\s*(from|import) .*\bllm\b", p.read_text(), re.M), p
