"""The entry module with and without the training-data subpackage."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).parent.parent
COUNT = "import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql(); assert set(o) <= set(q); print(len(q), len(o), 'baseline_top_n' in q, any(n.startswith('op') for n in q))"


@pytest.fixture()
def copy(tmp_path):
    shutil.copytree(ROOT / "seasonlab", tmp_path / "seasonlab", ignore=shutil.ignore_patterns("__pycache__", "llm"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    return tmp_path


def count(folder):
    out = subprocess.run([sys.executable, "-c", COUNT], cwd=folder, capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr
    return out.stdout.split()


def test_without_the_subpackage(copy):
    plain = count(copy)
    assert plain[2:] == ["True", "False"]
    # the folder is left, as a cache of compiled files leaves it, and a pipeline that needs it
    (copy / "seasonlab" / "llm" / "__pycache__").mkdir(parents=True)
    (copy / "corpus_pipeline.py").write_text("from seasonlab.llm.stages import nothing\n")
    assert count(copy) == plain


def test_with_a_library_missing(copy):
    plain = count(copy)
    (copy / "seasonlab" / "llm").mkdir()
    for name in ("__init__", "oracles", "queries"):
        (copy / "seasonlab" / "llm" / f"{name}.py").write_text("import a_library_that_is_not_there\n")
    (copy / "corpus_pipeline.py").write_text("ORACLE_SQL = None\n\ndef run(spark, sf_dir):\n    pass\n")
    assert count(copy) == plain


def test_other_errors_are_not_hidden(copy):
    (copy / "corpus_pipeline.py").write_text("1 / 0\n")
    with pytest.raises(AssertionError, match="ZeroDivisionError"):
        count(copy)
