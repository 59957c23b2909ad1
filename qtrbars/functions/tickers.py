"""Ticker predicates and the alias remap."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the source job's for the same universe:
# symbols containing any of these characters are dropped,
# and these share-class symbols are rewritten (after filtering).
MALFORMED_CHARS = ["/", "*"]
TICKER_ALIASES = {"BRKB": "BRK-B", "BRKA": "BRK-A"}


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def has_digit(t) -> Column:
    return _c(t).rlike("[0-9]")


def leading_digit(t) -> Column:
    return _c(t).rlike("^[0-9]")


def is_malformed(t, chars=MALFORMED_CHARS) -> Column:
    cls = "".join("\\" + ch if ch in "]\\^-" else ch for ch in chars)
    return _c(t).rlike(f"[{cls}]")


def keep_ticker(t, digits: str = "any", chars=MALFORMED_CHARS) -> Column:
    """True for a usable symbol. ``digits='any'`` rejects a digit anywhere,
    ``'leading'`` only a leading digit. Null symbols are rejected."""
    if digits not in ("any", "leading"):
        raise ValueError("digits must be 'any' or 'leading'")
    digit_test = has_digit(t) if digits == "any" else leading_digit(t)
    return F.coalesce(~digit_test & ~is_malformed(t, chars), F.lit(False))


def remap_alias(t, aliases: dict | None = None) -> Column:
    """Rewrite known aliases; identity otherwise. The map is a literal, so the
    lookup runs inside codegen with no join."""
    aliases = TICKER_ALIASES if aliases is None else aliases
    if not aliases:
        return _c(t)
    lookup = F.create_map(*[F.lit(x) for kv in aliases.items() for x in kv])
    return F.coalesce(F.try_element_at(lookup, _c(t)), _c(t))
