"""Scalar Column functions."""

from .dates import (calendar_columns, cut_date, date_key, first_year, infer_month,
                    infer_year, month_name, month_start, parse_date, parse_period,
                    shift_months, year_from_text)
from .hashing import canonical_json, canonical_text, exact_double, resource_id, row_sha, surrogate_key, version_name
from .labels import code_label, homologate, level, literal_map, parse_indicator
from .numbers import (dual_scale_violation, exact_sum, growth, identifier, loses_at_scale, match_label,
                      parse_int, parse_number, ratio, row_sum, scale, within_tolerance)
from .text import (canonical_label, clean_text, contains_token, digits, is_non_analytic,
                   measure_text, nfkc, normalize_match, plain_text,
                   safe_filename, strip_accents)

__all__ = [n for n in dir() if not n.startswith("_")]
