"""The entry without the optional subpackage, without the pipeline, without tokenizers."""
import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
ASK = "import __spark_entry__ as e; q = e.queries(); s = e.oracle_sql(); print(len(q), len(s), sum(n.startswith('op') for n in q), 'pipeline' in q)"


def ask(folder, code=ASK):
    out = subprocess.run([sys.executable, "-c", code], cwd=folder, capture_output=True, text=True, timeout=300)
    assert out.returncode == 0, out.stderr[-2000:]
    return out.stdout.split()


def copied(tmp_path, *leave_out):
    gone = shutil.ignore_patterns(".git", "__pycache__", ".pytest_cache", *leave_out)
    return shutil.copytree(ROOT, tmp_path / "repo", ignore=gone)


@pytest.mark.parametrize("leave_out", [("llm",), ("llm", "corpus_pipeline.py")])
def test_without_the_subpackage(tmp_path, leave_out):
    queries, sql, ops, pipeline = ask(copied(tmp_path, *leave_out))
    assert int(queries) > int(sql) > 100 and (ops, pipeline) == ("0", "False")


def test_without_the_pipeline(tmp_path):
    if not os.path.isdir(f"{ROOT}/parlance/llm"):
        pytest.skip("the subpackage is absent")
    assert ask(copied(tmp_path, "corpus_pipeline.py"))[3] == "False"


def test_a_pipeline_elsewhere_is_not_taken(tmp_path, monkeypatch):
    monkeypatch.setenv("PYTHONPATH", ROOT)
    assert ask(copied(tmp_path, "corpus_pipeline.py"))[3] == "False"


def test_without_tokenizers():
    blocked = ("import importlib.util as u; real = u.find_spec; "
               "u.find_spec = lambda n, *a: None if n == 'public_tokenizers' else real(n, *a); ")
    assert ask(ROOT, blocked + ASK)[2:] == ["0", "False"]


def test_a_query_runs_without_the_subpackage(tmp_path):
    code = ("import __spark_entry__ as e; from pyspark.sql import SparkSession; "
            "s = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false').config('spark.sql.session.timeZone', 'UTC').getOrCreate(); "
            "print(e.queries()['share_by_model'](s, '/root/testdata/sf0.001').count())")
    assert int(ask(copied(tmp_path, "llm", "corpus_pipeline.py"), code)[-1]) > 0
