"""Every registered query gives what its SQL gives."""

import math
import os

import duckdb
import pytest
from conftest import SF

from fundscope.catalog import ORACLES, QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for t in TABLES:
        if os.path.exists(f"{SF}/{t}.parquet"):
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(row):
    return tuple(None if isinstance(v, float) and math.isnan(v) else round(float(v), 6) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v) if v is not None else None for v in (float(x) if type(x).__name__ == "Decimal" else x for x in row))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted((plain(r) for r in df.select([f"`{c}`" for c in columns]).collect()), key=repr)
    want = sorted((plain(r) for r in duck.sql(f"SELECT {', '.join(f'"{c}"' for c in columns)} FROM ({ORACLES[name]})").fetchall()), key=repr)
    assert got == want


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_sql_gives_rows(spark, name):
    df = QUERIES[name](spark, SF)
    assert df.columns and df.count() > 0


def test_no_query_is_cut_by_id():
    for sql in ORACLES.values():
        assert not any(cut in sql for cut in ("c_custkey <=", "s_suppkey <=", "o_orderkey % 50", "l_quantity >= 40", "p_size <= 3", "WHERE lang = 'en')"))


def test_command_line(spark, tmp_path, capsys):
    from fundscope.__main__ import main

    assert main(["list"]) == 0 and "job_audit\tsql" in capsys.readouterr().out
    assert main(["run", "group_count", "--tables", SF, "--out", str(tmp_path / "out")]) == 0
    assert spark.read.parquet(str(tmp_path / "out")).count() > 0
    with pytest.raises(SystemExit):
        main(["run", "no_such_query", "--tables", SF])
