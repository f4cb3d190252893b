import duckdb
import pytest

import __spark_entry__
from millrace.catalog import ORACLES, QUERIES

DATA = "/root/testdata/sf0.001"
QUICK = ("clean_reasons", "chat_render", "length_band", "row_language", "quota_table", "eval_report", "latest_attempt", "tensor_audit", "running_quota")


def test_registry():
    assert set(QUERIES) - {"packing_plan"} == set(ORACLES) and set(QUERIES) <= set(__spark_entry__.queries())
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def plain(rows, names):
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(str([round(r[i], 6) if isinstance(r[i], float) else r[i] for i in order]) for r in rows)


@pytest.mark.parametrize("name", QUICK)
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations", "labels", "events", "embeddings"):
        con.execute(f"create view {t} as select * from read_parquet('{DATA}/{t}.parquet')")
    res = con.execute(ORACLES[name])
    want, names = res.fetchall(), [d[0] for d in res.description]
    got = QUERIES[name](spark, DATA)
    assert sorted(got.columns) == sorted(names)
    assert plain(got.collect(), got.columns) == plain(want, names)


def test_flagship(spark):
    assert __spark_entry__.entry(spark).count() > 0


def test_entry_without_the_subpackage(tmp_path):
    """A folder that only a cache is left in is no subpackage; the other queries stay."""
    import shutil
    import subprocess
    import sys
    from pathlib import Path

    root = Path(__file__).resolve().parents[2]
    shutil.copytree(root / "millrace", tmp_path / "millrace", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    (tmp_path / "millrace/llm/__pycache__").mkdir(parents=True)
    code = "import __spark_entry__ as e; assert 'mix_select' in e.queries() and not any(q.startswith('op') and q[2].isdigit() for q in e.queries())"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(tmp_path)})
