"""The entry points without the folders of the corpus operators."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
COUNT = "import __spark_entry__ as e; print(len(e.queries()), any(k.startswith(('op', 'pipeline')) for k in e.queries()), set(e.oracle_sql()) <= set(e.queries()))"


@pytest.mark.parametrize("gone", [["delaylens/llm", "corpus_pipeline.py"], ["delaylens/llm"], ["corpus_pipeline.py"]])
def test_imports_without_the_corpus_operators(tmp_path, gone):
    from delaylens.plans import QUERIES

    for name in ("delaylens", "__spark_entry__.py", "corpus_pipeline.py"):
        source = os.path.join(ROOT, name)
        away = shutil.ignore_patterns("__pycache__", *(["llm"] if "delaylens/llm" in gone else []))
        if os.path.isdir(source):
            shutil.copytree(source, tmp_path / name, ignore=away)
        elif os.path.exists(source) and name not in gone:
            shutil.copy(source, tmp_path / name)
    run = subprocess.run([sys.executable, "-c", COUNT], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert run.returncode == 0, run.stderr
    count, corpus, known = run.stdout.split()[-3:]
    assert known == "True" and int(count) >= len(QUERIES)
    if "delaylens/llm" in gone:
        assert int(count) == len(QUERIES) and corpus == "False"
