"""Column helpers: casts, text forms, keys, rounding and time."""

from sedimenta.functions.keys import content_hash, fingerprint, hmac_sha256, surrogate_key
from sedimenta.functions.numbers import ratio_to_limit, round_half_up
from sedimenta.functions.text import blank_to_null, cell_text, number_text, number_texts, to_date, to_double, to_int
from sedimenta.functions.time import local_to_utc, session_ordinal, utc_iso, year_from_position

__all__ = [
    "blank_to_null",
    "cell_text",
    "content_hash",
    "fingerprint",
    "hmac_sha256",
    "local_to_utc",
    "number_text",
    "number_texts",
    "ratio_to_limit",
    "round_half_up",
    "session_ordinal",
    "surrogate_key",
    "to_date",
    "to_double",
    "to_int",
    "utc_iso",
    "year_from_position",
]
