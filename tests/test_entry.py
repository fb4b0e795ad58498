"""The entry point without the operators on text."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).parents[1]
CODE = "import __spark_entry__ as e; print(len(e.queries()), sum(n.startswith('op') or n == 'pipeline' for n in e.queries()))"


@pytest.mark.parametrize("leftover", ["nothing", "folder", "folder and pipeline"])
def test_import_without_the_folder_or_with_an_empty_rest_of_it(tmp_path, leftover):
    for name in ("checks", "pressroom"):
        shutil.copytree(ROOT / name, tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    if leftover != "nothing":
        (tmp_path / "pressroom/llm/__pycache__").mkdir(parents=True)
    if leftover == "folder and pipeline":
        (tmp_path / "corpus_pipeline.py").write_text("from pressroom.llm import decontaminate\n")
    done = subprocess.run([sys.executable, "-c", CODE], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    total, dealt = map(int, done.stdout.split())
    assert total > 90 and dealt == 0
