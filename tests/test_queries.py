"""Every query with an oracle, on the smallest tables, against DuckDB."""

import math
import os

import duckdb
import pytest

from varloom.queries import catalog

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(data_dir):
    c = duckdb.connect()
    c.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        if os.path.exists(f"{data_dir}/{t}.parquet"):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{data_dir}/{t}.parquet'")
    return c


def same(a, b):
    if isinstance(a, float) and isinstance(b, float):
        return math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9)
    return a == b


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, duck, data_dir, name):
    df = catalog.QUERIES[name](spark, data_dir)
    r = duck.execute(catalog.SQL[name])
    cols = [x[0] for x in r.description]
    assert sorted(cols) == sorted(df.columns)
    order = sorted(cols)
    key = lambda row: tuple(str(x) for x in row)
    mine = sorted((tuple(x[c] for c in order) for x in df.collect()), key=key)
    theirs = sorted((tuple(x[cols.index(c)] for c in order) for x in r.fetchall()), key=key)
    assert len(mine) == len(theirs)
    assert all(same(x, y) for a, b in zip(mine, theirs) for x, y in zip(a, b))


def test_entry_imports_without_the_text_operators(tmp_path):
    import shutil
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    shutil.copytree(f"{root}/varloom", tmp_path / "varloom", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{root}/__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'pipeline' not in q and len(q) > 50 and set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env=os.environ | {"PYTHONPATH": ""})


def test_densify_fill_all_fills_every_site_of_every_sample(spark, data_dir):
    from varloom.queries.views import Views

    v = Views(spark, data_dir)
    cells = catalog.QUERIES["q_densify_fill_all"](spark, data_dir)
    assert cells.count() == cells.select("s", "site_id").distinct().count() == v.sites.count() * v.ref_blocks.select("s").distinct().count()
