"""Column -> Column helpers (JVM expressions only)."""

from .text import (COMMUNITY_KEYWORDS, NON_COMMUNITY_KEYWORDS, VENUE_PATTERNS,  # noqa: F401
                   as_text, flatten_category, four_field_text, norm_str, norm_url,
                   parse_label, py_strip, strip_accents, title_desc_text, tokens,
                   venue_flags, weak_label_expr, with_bigrams)
from .timefmt import (calendar_fields, calendar_fields_from, display_datetime, hour_or_missing,  # noqa: F401
                      is_weekend, parse_start, percent_1, wall_clock)
