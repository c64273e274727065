"""The registry works without the corpus operators and the pipeline file."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_entry_imports_alone(tmp_path):
    shutil.copytree(os.path.join(ROOT, "stayput"), tmp_path / "stayput", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(os.path.join(ROOT, "__spark_entry__.py"), tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 100 and not any(k.startswith('op') for k in q); assert set(e.oracle_sql()) <= set(q)"
    env = {**os.environ, "PYTHONPATH": ""}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr


def test_nothing_else_imports_the_corpus_operators():
    for top, _, files in os.walk(os.path.join(ROOT, "stayput")):
        if os.sep + "llm" in top:
            continue
        for f in files:
            if f.endswith(".py"):
                with open(os.path.join(top, f)) as text:
                    assert "stayput.llm" not in text.read(), f
