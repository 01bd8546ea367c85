"""The rest of the repository works without the training-data operators."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_import_without_the_training_data_operators(tmp_path):
    shutil.copytree(os.path.join(ROOT, "acadlake"), tmp_path / "acadlake", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(os.path.join(ROOT, "__spark_entry__.py"), tmp_path)
    code = ("import __spark_entry__ as E; q, o = E.queries(), E.oracle_sql(); "
            "assert 'student_view' in q and 'pipeline' not in q and not any(n.startswith('op1') for n in q); "
            "assert set(o) <= set(q)")
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env=os.environ | {"PYTHONPATH": str(tmp_path)})


def test_every_oracle_has_its_query():
    import __spark_entry__ as E
    assert set(E.oracle_sql()) <= set(E.queries())
