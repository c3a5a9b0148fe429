"""The entry module without the training-data subpackage, and the package on workers of another folder."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def run(code: str, cwd: str, path: str) -> str:
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", f"import sys; sys.path.insert(0, {path!r})\n{code}"], cwd=cwd, env=env, capture_output=True, text=True, timeout=240)
    assert done.returncode == 0, done.stderr[-2000:]
    return done.stdout


def test_entry_without_the_subpackage(tmp_path):
    shutil.copytree(os.path.join(ROOT, "mlspark"), tmp_path / "mlspark", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(os.path.join(ROOT, "__spark_entry__.py"), tmp_path)
    out = run("import __spark_entry__ as e; q = e.queries(); print(len(q), 'pipeline' in q, set(e.oracle_sql()) <= set(q))", str(tmp_path), str(tmp_path))
    n, pipeline, known = out.split()
    assert int(n) > 150 and pipeline == "False" and known == "True"


def test_workers_get_the_package(tmp_path):
    code = """
import __spark_entry__ as e
from mlspark.session import build_session
print(e.queries()["N3_lof"](build_session(2, "elsewhere"), "/root/testdata/sf0.001").count())
"""
    assert int(run(code, str(tmp_path), ROOT).split()[-1]) > 0
