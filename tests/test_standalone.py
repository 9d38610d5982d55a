"""The library without the training-data subpackage: everything else still imports and registers its queries."""

import json
import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
REPORT = """
import json
import __spark_entry__ as entry
print(json.dumps([sorted(entry.queries()), sorted(entry.oracle_sql())]))
"""


def registered(folder):
    done = subprocess.run([sys.executable, "-c", REPORT], cwd=folder, capture_output=True, text=True, timeout=300, check=True)
    return json.loads(done.stdout.splitlines()[-1])


@pytest.mark.parametrize("with_pipeline", [False, True])
def test_without_the_subpackage(tmp_path, with_pipeline):
    """Both as the folders are deleted with the pipeline's file and as they are deleted alone."""
    shutil.copytree(os.path.join(ROOT, "upkeep"), tmp_path / "upkeep", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(os.path.join(ROOT, "__spark_entry__.py"), tmp_path)
    pipeline = os.path.join(ROOT, "corpus_pipeline.py")
    if with_pipeline and os.path.exists(pipeline):
        shutil.copy(pipeline, tmp_path)
    queries, oracles = registered(tmp_path)
    assert len(queries) >= 45 and not [q for q in queries if q.startswith("op") or q == "pipeline"]
    assert set(oracles) <= set(queries)


def test_the_core_does_not_import_the_subpackage():
    for folder, _, files in os.walk(os.path.join(ROOT, "upkeep")):
        if os.path.basename(folder) == "llm":
            continue
        for name in files:
            if name.endswith(".py"):
                with open(os.path.join(folder, name)) as source:
                    assert "upkeep.llm" not in source.read(), name
