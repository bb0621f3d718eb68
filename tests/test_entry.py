"""The registry, with and without the operators on training data."""

from __future__ import annotations

import os
import shutil
import subprocess
import sys

import __spark_entry__
from checks.oracles import ORACLES
from checks.queries import REGISTRY

ROOT = os.path.dirname(os.path.abspath(__spark_entry__.__file__))
NAMES = "import __spark_entry__ as e; print(*sorted(e.queries()), '|', *sorted(e.oracle_sql()))"


def names(folder):
    run = subprocess.run([sys.executable, "-c", NAMES], cwd=folder, capture_output=True, text=True, check=True)
    queries, oracles = run.stdout.split("|")
    return set(queries.split()), set(oracles.split())


def test_the_rest_lives_without_the_subpackage(tmp_path):
    for left_out in (["llm"], ["llm", "corpus_pipeline.py"], ["corpus_pipeline.py"]):
        copy = tmp_path / "-".join(left_out)
        shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "__pycache__", *left_out))
        queries, oracles = names(copy)
        assert set(REGISTRY) <= queries and set(ORACLES) <= oracles
        if "llm" in left_out:
            assert queries == set(REGISTRY) and oracles == set(ORACLES)
        else:
            assert "pipeline" not in queries


def test_a_pipeline_elsewhere_on_the_path_does_not_count(tmp_path, monkeypatch):
    monkeypatch.setenv("PYTHONPATH", ROOT)
    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "__pycache__", "corpus_pipeline.py"))
    queries, oracles = names(copy)
    assert "pipeline" not in queries | oracles and set(REGISTRY) < queries


def test_whole_registry():
    assert set(REGISTRY) <= set(__spark_entry__.queries())
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
