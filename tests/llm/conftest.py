from __future__ import annotations

import duckdb
import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture
def docs(spark):
    """Documents from (doc_id, text) pairs, with columns whose names the operators use themselves."""

    def make(rows, names="doc_id bigint, text string"):
        rows = [(*r, "en", "s", None, 7, True, None) for r in rows]
        return spark.createDataFrame(rows, f"{names}, lang string, source string, n_chars bigint, key int, kept boolean, score double")

    return make


@pytest.fixture
def twin():
    """Rows of a DuckDB query over one table given as (schema, rows), sorted."""

    def run(sql, rows, name="documents", schema="doc_id bigint, text varchar"):
        db = duckdb.connect()
        db.execute(f"create table {name} ({schema})")
        if rows:
            db.executemany(f"insert into {name} values ({', '.join('?' * len(rows[0]))})", rows)
        result = db.execute(sql)
        names = [c[0] for c in result.description]
        return sorted((dict(sorted(zip(names, r, strict=True))) for r in result.fetchall()), key=repr)

    return run


def plain(df):
    """Rows as sorted dicts."""
    return sorted((dict(sorted(r.asDict().items())) for r in df.collect()), key=repr)
