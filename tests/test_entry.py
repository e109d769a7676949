"""The entry points work with and without the subpackage of training-data operators."""

from __future__ import annotations

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SHOW = "import __spark_entry__ as e; print(sorted(e.queries()), sorted(e.oracle_sql()))"


def _names(root: str) -> str:
    return subprocess.run([sys.executable, "-c", SHOW], cwd=root, capture_output=True, text=True, check=True, env=os.environ | {"PYTHONPATH": root}).stdout


def test_entry_without_the_subpackage(tmp_path):
    for left in ((), ("corpus_pipeline.py",)):
        root = tmp_path / f"copy{len(left)}"
        shutil.copytree(ROOT, root, ignore=shutil.ignore_patterns(".git", "llm", "__pycache__"))
        (root / "tessera" / "llm" / "__pycache__").mkdir(parents=True)  # what deleting the files may leave behind
        if not left and (root / "corpus_pipeline.py").exists():
            (root / "corpus_pipeline.py").unlink()
        names = _names(str(root))
        assert "o95_digest_by_antibody" in names and "'op1_" not in names and "pipeline" not in names


def test_every_query_is_found():
    if os.path.isdir(f"{ROOT}/tessera/llm") and os.path.isfile(f"{ROOT}/tessera/llm/registry.py"):
        names = _names(ROOT)
        assert all(f"'op{n}_" in names for n in range(1, 11)) and "'pipeline'" in names
