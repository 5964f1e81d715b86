"""Column-expression helpers (no DataFrame plumbing)."""

from strata.functions.calendar import (
    BEGINNING_OF_TIME,
    MONTH_NAMES_PT,
    WEEKDAY_NAMES_PT,
    date_sk,
    month_start,
    name_lookup,
    period_of_year,
)
from strata.functions.keys import (
    fingerprint,
    legacy_fingerprint,
    surrogate_key,
    version_key,
)
from strata.functions.masking import digits_masked, email_domain_only, hash_with_salt, nullify, partial
from strata.functions.ordering import encode_last, parse_order, sort_columns

__all__ = [
    "BEGINNING_OF_TIME", "MONTH_NAMES_PT", "WEEKDAY_NAMES_PT", "date_sk", "month_start", "name_lookup",
    "period_of_year", "fingerprint", "legacy_fingerprint", "surrogate_key", "version_key",
    "digits_masked", "email_domain_only", "hash_with_salt", "nullify", "partial", "encode_last",
    "parse_order", "sort_columns",
]
