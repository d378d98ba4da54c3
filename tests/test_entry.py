"""The driver contract holds without the training-text folder."""

import re
import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent
CODE = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 100 and set(e.oracle_sql()) <= set(q); print(sum(n.startswith('op') or n == 'pipeline' for n in q))"


def copy(folder, *left_out):
    target = Path(folder) / "repo"
    shutil.copytree(ROOT, target, ignore=lambda at, names: {n for n in names if n in {".git", "__pycache__", *left_out}})
    return target


def extras(where):
    return int(subprocess.run([sys.executable, "-c", CODE], cwd=where, capture_output=True, text=True, check=True).stdout)


def test_without_the_folder(folder):
    assert extras(copy(folder, "llm", "corpus_pipeline.py")) == 0


def test_without_the_folder_but_with_the_pipeline_file(folder):
    assert extras(copy(folder, "llm")) == 0


def test_nothing_else_imports_it():
    for path in [*ROOT.glob("cohortry/**/*.py"), *ROOT.glob("study_queries/*.py")]:
        assert "llm" in path.parts or not re.search(r"\bllm\b", path.read_text()), path
