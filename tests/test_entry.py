import glob
import math
import os
import re

import pytest

duckdb = pytest.importorskip("duckdb")

import __spark_entry__ as entry  # noqa: E402
from millrace.plans import registry  # noqa: E402


def rows(columns, values):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def plain(v):
        if isinstance(v, float):
            return "nan" if math.isnan(v) else f"{v:.9g}"
        return str(v)

    return sorted(tuple(plain(r[i]) for i in order) for r in values)


@pytest.fixture(scope="module")
def duck(tiny):
    con = duckdb.connect()
    for p in glob.glob(f"{tiny}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return con


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_query_agrees_with_sql(spark, tiny, duck, name):
    got = registry.QUERIES[name](spark, tiny)
    want = duck.execute(registry.SQL[name])
    columns = [c[0] for c in want.description]
    assert sorted(got.columns) == sorted(columns)
    assert rows(got.columns, got.collect()) == rows(columns, want.fetchall())


def test_entry(spark, tiny):
    assert entry.entry(spark).columns == ["source", "n_tokens", "n_chunks"]
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_nothing_else_imports_the_optional_subpackage():
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    for path in glob.glob(f"{root}/millrace/**/*.py", recursive=True):
        if f"{os.sep}llm{os.sep}" not in path:
            with open(path, encoding="utf-8") as f:
                assert not re.search(r"millrace\.llm|from \.+llm|import llm", f.read()), path
