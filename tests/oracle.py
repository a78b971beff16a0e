"""Compares queries with their SQL twins: column names, row counts and sorted values."""

from __future__ import annotations

import math


def cell(x) -> str:
    if x is None or (isinstance(x, float) and math.isnan(x)):
        return "NULL"
    if isinstance(x, float):
        return f"{x:.6g}"
    if hasattr(x, "isoformat"):
        return x.isoformat()
    return str(x)


def same(spark_rows, columns, con, sql) -> tuple[bool, str]:
    rel = con.sql(sql)
    theirs, names = rel.fetchall(), rel.columns
    if sorted(columns) != sorted(names):
        return False, f"columns {columns} and {names}"
    a = sorted(tuple(cell(r[columns.index(c)]) for c in sorted(columns)) for r in spark_rows)
    b = sorted(tuple(cell(r[names.index(c)]) for c in sorted(names)) for r in theirs)
    if a == b:
        return True, f"{len(a)} rows"
    odd = next(((x, y) for x, y in zip(a, b, strict=False) if x != y), None)
    return False, f"{len(a)} and {len(b)} rows; first difference {odd}"
