"""Small text helpers used by the load jobs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def split_codes(c) -> Column:
    """'gbp, brl,,' -> ['GBP', 'BRL']: split on commas, trim, upper-case, drop empties."""
    col = F.col(c) if isinstance(c, str) else c
    parts = F.transform(F.split(col, ","), lambda x: F.upper(F.trim(x)))
    return F.filter(parts, lambda x: x != F.lit(""))


def parse_codes(text: str) -> list[str]:
    """Driver-side twin of split_codes for job parameters; empty is an error."""
    codes = [p.strip().upper() for p in (text or "").split(",") if p.strip()]
    if not codes:
        raise ValueError("no codes given")
    return codes


def clip_text(c, limit: int = 2000) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.substring(col, 1, limit)


def path_join(*parts) -> Column:
    return F.concat_ws("/", *[F.col(p) if isinstance(p, str) else p for p in parts])
