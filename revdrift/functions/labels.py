"""Lambda labels, display labels and file-safe names (scalar expressions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import INF_K

# Spellings accepted for "all shingles" (any letter case).
INF_SPELLINGS = ("inf", "infty", "infinite")
INF_LABEL = "inf"
INF_DISPLAY = "∞"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lambda_label(raw) -> Column:
    """Normalised label: 'inf' for the infinity spellings, else str(int(x)).

    Values that are neither (or not positive) map to NULL; callers report or
    reject those rows.
    """
    raw = F.trim(_col(raw).cast("string"))
    as_int = raw.try_cast("int")
    return (
        F.when(F.lower(raw).isin(*INF_SPELLINGS), F.lit(INF_LABEL))
        .when(as_int > 0, as_int.cast("string"))
        .otherwise(F.lit(None).cast("string"))
    )


def lambda_k(label) -> Column:
    """Sketch size for a normalised label; INF_K for 'inf'."""
    label = _col(label)
    return F.when(label == F.lit(INF_LABEL), F.lit(INF_K)).otherwise(
        label.try_cast("int"))


def lambda_display(label, style: str = "series") -> Column:
    """'∞' for inf; otherwise 'λ=8' (series legends) or '8' (timing table)."""
    label = _col(label)
    finite = F.concat(F.lit("λ="), label) if style == "series" else label
    return F.when(label == F.lit(INF_LABEL), F.lit(INF_DISPLAY)).otherwise(finite)


def lambda_order(label) -> Column:
    """Sort key: finite lambdas ascending, inf last."""
    return lambda_k(label)


def safe_name(s) -> Column:
    """Every character outside [A-Za-z0-9._-] becomes '-'."""
    return F.regexp_replace(_col(s), "[^A-Za-z0-9._-]", "-")


def safe_path_token(s) -> Column:
    """'/' and '\\' become '-', spaces become '_' (plot/artifact names)."""
    return F.translate(_col(s), "/\\ ", "--_")
