import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]


def test_entry_query(spark):
    import __spark_entry__ as e

    df = e.entry(spark)
    assert df.count() > 0 and df.columns == ["host", "n_pages", "first_page"]


def test_sql_belongs_to_queries():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())


def test_without_the_optional_folders(tmp_path):
    for name in ("spindrift", "__spark_entry__.py"):
        src = ROOT / name
        if src.is_dir():
            shutil.copytree(src, tmp_path / name, ignore=shutil.ignore_patterns("__pycache__", "llm"))
        else:
            shutil.copy(src, tmp_path / name)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'pipeline' not in q and not [k for k in q if k[:2] == 'op' and k[2].isdigit()] and len(q) > 40; e.oracle_sql()"
    env = os.environ | {"PYTHONPATH": os.pathsep.join(p for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p and Path(p) != ROOT)}
    run = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=120)
    assert run.returncode == 0, run.stderr


def test_nothing_outside_imports_the_subpackage():
    for p in (ROOT / "spindrift").rglob("*.py"):
        if "llm" not in p.relative_to(ROOT).parts:
            assert "llm" not in p.read_text(), p


@pytest.mark.parametrize("name", ["resolution_rounds", "html_main_text", "token_chunks"])
def test_queries_without_sql_have_rows(spark, name):
    import __spark_entry__ as e

    assert e.queries()[name](spark, "/root/testdata/sf0.001").count() > 0
