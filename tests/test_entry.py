"""The driver contract without the training-data subpackage."""

import os
import shutil
import subprocess
import sys

from eventloom.catalog.queries import REGISTRY

HERE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_entry_works_without_the_subpackage(tmp_path):
    copy = tmp_path / "copy"
    shutil.copytree(os.path.join(HERE, "eventloom"), copy / "eventloom", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        if os.path.exists(os.path.join(HERE, name)):
            shutil.copy(os.path.join(HERE, name), copy)
    code = "import __spark_entry__ as e; print(*sorted(e.queries())); print(*sorted(e.oracle_sql()))"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=copy, env=env, capture_output=True, text=True, timeout=120, check=True)
    names, sql = done.stdout.splitlines()[-2:]
    assert names.split() == sorted(REGISTRY) == sql.split()
