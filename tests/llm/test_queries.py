import math

import pytest

duckdb = pytest.importorskip("duckdb")

import os  # noqa: E402

from millrace.llm import queries  # noqa: E402
from millrace.llm.tokens import tokenizer_path  # noqa: E402

#: Columns that the test tables' description fixes.
FIXED = {"p2_found": ["split", "source_id", "ordinal"], "p3_found": ["hash_a", "hash_b"], "p6_ids": ["doc_id", "ids"], "p7_found": ["item_id", "doc_id"], "p8_found": ["doc_id", "kind", "mention"]}


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query_runs_over_whole_tables(spark, tiny, name):
    if name[:2] in ("p5", "p6") and not os.path.exists(tokenizer_path("byte_bpe_50k.tiktoken")):
        pytest.skip("no vocabulary files")
    df = queries.QUERIES[name](spark, tiny)
    assert df.columns == FIXED.get(name, df.columns)
    rows = df.collect()
    assert rows
    if name in FIXED and name != "p6_ids":
        assert len(set(rows)) == len(rows)
    if name == "p6_ids":
        assert len(rows) == spark.read.parquet(f"{tiny}/documents.parquet").count()


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_agrees_with_sql(spark, tiny, name):
    con = duckdb.connect()
    for t in ("documents", "upstream_identity_v1", "source_plan_2026_10_02", "cpt_labels", "decisions"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tiny}/{t}.parquet'")
    want = con.execute(queries.SQL[name])
    columns = [c[0] for c in want.description]
    got = queries.QUERIES[name](spark, tiny).select(*columns).collect()
    plain = lambda rows: sorted(tuple("nan" if isinstance(v, float) and math.isnan(v) else str(v) for v in r) for r in rows)
    assert plain(got) == plain(want.fetchall())
