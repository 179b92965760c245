"""The entry module works with and without the training-data modules."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent


@pytest.mark.parametrize("also", [(), ("corpus_pipeline.py",)])
def test_the_entry_module_works_without_the_training_data_modules(tmp_path, also):
    tree = tmp_path / "tree"
    skipped = shutil.ignore_patterns(".git", "__pycache__", "llm", "spark-warehouse", ".pytest_cache", *also)
    shutil.copytree(ROOT, tree, ignore=skipped)
    if also:   # what a deletion may leave
        (tree / "paylake" / "llm" / "__pycache__").mkdir(parents=True)
    code = ("import __spark_entry__ as e; q, s = e.queries(), e.oracle_sql(); "
            "print(len(q), len(s), any(n.startswith('op') and n[2].isdigit() for n in q), 'pipeline' in q)")
    done = subprocess.run([sys.executable, "-c", code], cwd=tree, capture_output=True, text=True, timeout=120,
                          env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(tree)})
    assert done.returncode == 0, done.stderr[-2000:]
    queries, sql, *rest = done.stdout.split()
    assert int(queries) == int(sql) > 200 and rest == ["False", "False"]
