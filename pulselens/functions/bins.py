"""Right-closed bins (pandas ``cut``) and text formatting helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values (must equal the reference's age grouping): bin edges and labels,
# right-closed intervals (0,17], (17,25], (25,35], (35,45], (45,100].
AGE_EDGES = [0, 17, 25, 35, 45, 100]
AGE_LABELS = ["0-17", "18-25", "26-35", "36-45", "45+"]


def cut(c: Column, edges=AGE_EDGES, labels=AGE_LABELS) -> Column:
    """Label of the right-closed bin holding ``c``; NULL outside (edges[0], edges[-1]]."""
    expr = None
    for lo, hi, lab in zip(edges[:-1], edges[1:], labels):
        cond = (c > F.lit(lo)) & (c <= F.lit(hi))
        expr = F.when(cond, F.lit(lab)) if expr is None else expr.when(cond, F.lit(lab))
    return expr


def cut_sql(c: str, edges=AGE_EDGES, labels=AGE_LABELS) -> str:
    parts = " ".join(f"WHEN {c} > {lo} AND {c} <= {hi} THEN '{lab}'"
                     for lo, hi, lab in zip(edges[:-1], edges[1:], labels))
    return f"(CASE {parts} END)"


def pct_text(x: Column) -> Column:
    """``{:.2%}``-style text; rounds first so every engine prints the same.
    (``format_string`` would print a NULL as "nu%", hence the guard.)"""
    return F.when(x.isNotNull(), F.format_string("%.2f%%", F.round(x * F.lit(100.0), 2)))


def num_text(x: Column) -> Column:
    """``{:.2f}``-style text."""
    return F.when(x.isNotNull(), F.format_string("%.2f", F.round(x, 2)))
