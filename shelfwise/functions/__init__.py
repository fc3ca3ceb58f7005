from shelfwise.functions.casts import legacy_date, legacy_double, legacy_int, zero_if_missing
from shelfwise.functions.text import strip_spaces, title_case

__all__ = ["legacy_date", "legacy_double", "legacy_int", "zero_if_missing", "strip_spaces", "title_case"]
