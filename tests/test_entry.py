import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).parent.parent
CODE = """
import __spark_entry__ as e
q = e.queries()
assert len(q) > 60 and not any(n.startswith("op") and n[2].isdigit() for n in q) and "pipeline" not in q
assert set(e.oracle_sql()) <= set(q)
"""


def test_the_rest_imports_with_the_removable_part_gone(tmp_path):
    shutil.copytree(ROOT / "rasterloom", tmp_path / "rasterloom", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    subprocess.run([sys.executable, "-c", CODE], check=True, cwd=tmp_path)


def test_a_missing_dependency_is_an_error(tmp_path):
    shutil.copytree(ROOT / "rasterloom", tmp_path / "rasterloom", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    (tmp_path / "corpus_pipeline.py").write_text("import a_module_that_is_not_there")
    run = subprocess.run([sys.executable, "-c", CODE], cwd=tmp_path, capture_output=True, text=True)
    assert run.returncode and "a_module_that_is_not_there" in run.stderr
