"""Text normalisation used by the cleaning step."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfwise.functions._util import to_col


def strip_spaces(c) -> Column:
    """Remove leading/trailing space characters only (tabs are kept)."""
    return F.trim(to_col(c))


def title_case(c) -> Column:
    """Lower-case, then upper-case the first letter of each space-separated word."""
    return F.initcap(strip_spaces(c))
