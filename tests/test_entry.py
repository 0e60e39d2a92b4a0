"""The registered queries do not need the training-data operators."""

import os
import shutil
import subprocess
import sys

import __spark_entry__ as contract

HERE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_the_rest_imports_without_the_subpackage(tmp_path):
    skip = shutil.ignore_patterns("llm", "corpus_pipeline.py", "__pycache__")
    shutil.copytree(os.path.join(HERE, "tallyrank"), tmp_path / "tallyrank", ignore=skip)
    shutil.copy(os.path.join(HERE, "__spark_entry__.py"), tmp_path)
    code = "import __spark_entry__ as c; print(*sorted(c.queries()), *sorted(c.oracle_sql()))"
    env = os.environ | {"PYTHONPATH": str(tmp_path)}
    done = subprocess.run([sys.executable, "-W", "ignore", "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
    extra = {"pipeline"} | {n for n in contract.queries() if n.startswith("op") and n[2:].split("_")[0].isdigit()}
    assert set(done.stdout.split()) == set(contract.queries()) - extra


def test_a_pipeline_without_its_operators_is_left_out(tmp_path):
    shutil.copytree(os.path.join(HERE, "tallyrank"), tmp_path / "tallyrank", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        if os.path.exists(os.path.join(HERE, name)):
            shutil.copy(os.path.join(HERE, name), tmp_path)
    code = "import __spark_entry__ as c; assert 'pipeline' not in c.queries() and c.oracle_sql()"
    env = os.environ | {"PYTHONPATH": str(tmp_path)}
    subprocess.run([sys.executable, "-W", "ignore", "-c", code], cwd=tmp_path, env=env, check=True)
