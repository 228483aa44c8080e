"""Every query of the engine against its SQL on DuckDB, and the driver's entry points."""

import duckdb
import pytest

from dwellspark.plans.oracles import ORACLES
from dwellspark.plans.queries import QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(str(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck(data):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{data}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, data, duck, name):
    df = QUERIES[name](spark, data)
    result = duck.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    assert canonical(df.columns, [tuple(r) for r in df.collect()]) == canonical(columns, result.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_rows_only(spark, data, name):
    assert QUERIES[name](spark, data).count() > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_plans_push_down_and_prune(spark, data):
    plan = QUERIES["history_latest"](spark, data)._jdf.queryExecution().executedPlan().toString()
    events = next(line for line in plan.splitlines() if "FileScan" in line and "user_id" in line)
    assert "props" not in events and "CartesianProduct" not in plan


def test_whole_texts_are_stripped(spark, tmp_path):
    texts = ["x" * 60 + " end \u00a0\r\n", "\u2003 " * 30 + "late" + " \t" * 30, " " * 50, "", None]
    spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    rows = {r["doc_id"]: r["text"] for r in QUERIES["unicode_strip_whole"](spark, str(tmp_path)).collect()}
    assert rows == {i: t if t is None else t.strip() for i, t in enumerate(texts)}
