"""Native column expressions (no Python UDFs)."""

from driftwood.functions.text import (  # noqa: F401
    is_non_numeric, parse_double, repair_mojibake, token_jaccard, tokens,
)
from driftwood.functions.keys import (  # noqa: F401
    composite_key, key_part, key_to_date, month_of_day, year_of_key,
)
