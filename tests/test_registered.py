"""Every registered query against its SQL twin on the smallest tables."""

import pytest

from tests.compare import check, duck
from tidemark.workload.catalog import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, connection, name):
    verdict, rows = check(spark, connection, name, SF)
    assert verdict == ("ok" if name in ORACLE else "no SQL")
    assert rows >= 0


def test_entry(spark):
    import __spark_entry__ as entry_points

    assert entry_points.entry(spark).count() > 0
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


@pytest.mark.parametrize("gone", [["tidemark/llm", "tests/llm", "corpus_pipeline.py"], ["tidemark/llm", "tests/llm"], ["corpus_pipeline.py"]])
def test_entry_without_the_training_data_part(tmp_path, gone):
    import shutil
    import subprocess
    import sys
    from pathlib import Path

    here = Path(__file__).resolve().parents[1]
    left_out = {str(here / g) for g in gone}
    copy = shutil.copytree(here, tmp_path / "copy", ignore=lambda folder, names: [
        n for n in names if n in (".git", "__pycache__") or str(Path(folder) / n) in left_out])
    script = ("import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql(); assert set(o) <= set(q); "
              "print(len(q), sum(n.startswith('op') for n in q), 'pipeline' in q)")
    done = subprocess.run([sys.executable, "-c", script], cwd=copy, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    n, operators, pipeline = done.stdout.split()[-3:]
    assert int(n) >= len(QUERIES) and (int(operators) > 0) == ("tidemark/llm" not in gone) and pipeline == "False"
