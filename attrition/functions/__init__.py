"""Column expressions used by the operators."""

from attrition.functions.dates import as_col, calendar_months, in_period, months_30day, parse_date
from attrition.functions.flags import flag, membership_flag
from attrition.functions.ratios import exact_avg, relative_change, safe_ratio
from attrition.functions.text import equivalent_forms, one_spelling, same_text

__all__ = [
    "as_col", "calendar_months", "in_period", "months_30day", "parse_date",
    "flag", "membership_flag", "exact_avg", "relative_change", "safe_ratio",
    "equivalent_forms", "one_spelling", "same_text",
]
