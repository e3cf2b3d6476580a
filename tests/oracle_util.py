"""Spark vs DuckDB comparison used by the tests and scripts/oracle_check.py."""

import math

import duckdb

from custlens.sources.tables import TABLES, table_path


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(sf_dir, t)}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else float(v)
    if hasattr(v, "tolist") and not isinstance(v, str):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, (int, str, bool)):
        return v
    return str(v)


def rows(pdf):
    cols = sorted(pdf.columns)
    out = [tuple(_norm(x) for x in rec) for rec in pdf[cols].itertuples(index=False)]
    return cols, sorted(out, key=repr)


def compare(spark_pdf, duck_pdf):
    sc, sr = rows(spark_pdf)
    dc, dr = rows(duck_pdf)
    assert sc == dc, f"columns differ: {sc} vs {dc}"
    assert len(sr) == len(dr), f"row counts differ: {len(sr)} vs {len(dr)}"
    bad = [(a, b) for a, b in zip(sr, dr) if a != b]
    assert not bad, f"{len(bad)} rows differ, e.g. {bad[:2]}"
