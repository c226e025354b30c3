"""Listing text -> typed values, as native Column expressions.

Every function here is ``Column -> Column`` (or returns a few Columns) and
stays inside whole-stage codegen: no Python runs per row. Regexes carry
``(?U)`` where Python's Unicode ``\\w``/``\\d`` must be matched, and ``(?d)``
where only ``\\n`` may end a line (Python's ``.``).
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import (
    NA_WORDS,
    PICKUP_PATTERN,
    PRICE_PATTERN,
    PRICE_TYPE,
    PRODUCT_ID_PATTERN,
    PROMO_RULES,
    UNIT_BASE_TYPE,
    UNIT_PRICE_PATTERN,
    UNIT_PRICE_TYPE,
)

# Java regex flags that give the Python meaning: (?U) Unicode \w and \d,
# (?d) only '\n' ends a line for '.'.
PRODUCT_ID_RE = "(?U)" + PRODUCT_ID_PATTERN
PRICE_RE = "(?d)" + PRICE_PATTERN
UNIT_PRICE_RE = "(?dU)" + UNIT_PRICE_PATTERN
# Python's blanks: Unicode white space and the four separators U+001C to U+001F.
BLANK = r"[\s\x1c-\x1f]"
PICKUP_RE = "(?U)" + PICKUP_PATTERN.replace(r"\s", BLANK)


def strip(c: Column) -> Column:
    """Without blanks at either end (``trim`` knows the ASCII blank only)."""
    return F.regexp_replace(c, f"(?U)^{BLANK}+|{BLANK}+$", "")


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _extract(c: Column, pattern: str, group: int) -> Column:
    """``regexp_extract`` that gives null (not '') when nothing matches."""
    return F.nullif(F.regexp_extract(c, pattern, group), F.lit(""))


# P-17 ---------------------------------------------------------------------
_NA_LITERALS: dict[tuple, list] = {}


def _na_literals(na_words) -> list:
    """Literal Columns for the word list, made once (each is a JVM round trip)."""
    key = tuple(na_words)
    if key not in _NA_LITERALS:
        _NA_LITERALS[key] = [F.lit(w) for w in key]
    return _NA_LITERALS[key]


def null_na_words(c, na_words=NA_WORDS) -> Column:
    """Text that a pandas CSV reader would read as missing becomes null."""
    c = _col(c)
    return F.when(~c.isin(*_na_literals(na_words)), c)


# P-1 ----------------------------------------------------------------------
def product_id(link) -> Column:
    """Last path segment of the link, word characters only, at the very end."""
    return _extract(_col(link), PRODUCT_ID_RE, 1)


# P-4 / P-5 ----------------------------------------------------------------
def first_line(c) -> Column:
    return F.substring_index(_col(c), "\n", 1)


def promo_category(label, rules=PROMO_RULES) -> Column:
    """First matching rule wins; case-sensitive; no match or null -> null."""
    label = _col(label)
    out = None
    for needle, category in rules:
        cond = label.contains(needle)
        out = F.when(cond, F.lit(category)) if out is None else out.when(cond, F.lit(category))
    return out


def _try_cast(c: Column, type_sql: str) -> Column:
    return c.try_cast(type_sql)


# P-6 ----------------------------------------------------------------------
def parse_price(text) -> Column:
    """Everything after the first ``$`` on its line, as decimal(12,2).

    Thousands commas, suffixes or a missing ``$`` give null (a reject),
    never a guessed value.
    """
    return _try_cast(_extract(_col(text), PRICE_RE, 1), PRICE_TYPE.simpleString())


# P-7 ... P-12 ---------------------------------------------------------------
class UnitParts(NamedTuple):
    n_parts: Column        # number of comma parts (A-5 measure, per row)
    middle_has_dollar: Column
    unit_part: Column      # amount text such as '500 g' (null if it holds '$')
    price_part: Column     # unit price text such as '$1.20/100g' (null if no '$')
    price_per_unit_1: Column
    price_per_unit_2: Column
    n_price_tokens: Column


def unit_parts(per_price) -> UnitParts:
    """Split the unit text into the amount part and one or two unit prices.

    ``'500 g, $1.20/100g'`` -> unit ``'500 g'``, price ``'$1.20/100g'``;
    ``'1 ea, $1,200/1ea'`` (three parts) -> price ``'$1.200/1ea'``;
    ``'$4.39/1kg $1.99/1lb'`` -> two unit prices. Each row is parsed by its
    own number of parts.
    """
    per = _col(per_price)
    parts = F.split(per, ",")
    n = F.size(parts)
    p0 = F.get(parts, 0)
    p1 = F.get(parts, 1)
    p2 = F.get(parts, 2)
    repaired = F.when(n == 3, F.concat(p1, F.lit("."), F.replace(p2, F.lit("."), F.lit("")))).when(n == 2, p1)
    price_text = strip(F.coalesce(repaired, p0))
    unit_part = F.when(~p0.contains("$"), p0)
    price_part = F.when(price_text.contains("$"), price_text)
    tokens = F.split(price_part, f"(?U){BLANK}+")
    return UnitParts(
        n_parts=F.when(per.isNotNull(), n),
        middle_has_dollar=F.coalesce(p1.contains("$"), F.lit(False)),
        unit_part=unit_part,
        price_part=price_part,
        price_per_unit_1=F.get(tokens, 0),
        price_per_unit_2=F.get(tokens, 1),
        n_price_tokens=F.size(tokens),
    )


class UnitPrice(NamedTuple):
    unit_price: Column   # decimal(12,4)
    base: Column         # decimal(8,0)
    word: Column         # unit word, e.g. 'g', 'kg', 'ea'


def unit_price(ppu) -> UnitPrice:
    """``'$0.40/100g'`` -> (0.40, 100, 'g'); no match -> nulls."""
    ppu = _col(ppu)
    return UnitPrice(
        unit_price=_try_cast(_extract(ppu, UNIT_PRICE_RE, 1), UNIT_PRICE_TYPE.simpleString()),
        base=_try_cast(_extract(ppu, UNIT_PRICE_RE, 2), UNIT_BASE_TYPE.simpleString()),
        word=_extract(ppu, UNIT_PRICE_RE, 3),
    )


# P-13 / P-15 ----------------------------------------------------------------
def number_text(dec) -> Column:
    """Decimal rendered the way a binary float prints: ``1.0``, ``997.5``,
    ``10570052.11`` (plain digits, trailing zeros dropped, at least one
    decimal digit). Goes through the decimal's own text, not a double, so
    values of 1e7 and more do not switch to exponent form."""
    text = _col(dec).cast("string")
    trimmed = F.rtrim(text, F.lit("0"))  # only fraction digits: the text holds a '.'
    fixed = F.when(trimmed.endswith("."), F.concat(trimmed, F.lit("0"))).otherwise(trimmed)
    return F.when(text.contains("."), fixed).otherwise(F.concat(text, F.lit(".0")))


def derived_amount(price, up: UnitPrice) -> Column:
    """``round(price * base / unit_price, 2)`` + blank + unit word.

    Decimal arithmetic, HALF_UP rounding; a zero unit price gives null.
    """
    amount = F.round(F.try_divide(_col(price) * up.base, up.unit_price), 2)
    return F.when(
        up.unit_price.isNotNull() & up.base.isNotNull() & up.word.isNotNull() & amount.isNotNull(),
        F.concat(number_text(amount), F.lit(" "), up.word),
    )


def average_unit(unit_part, price, up: UnitPrice) -> Column:
    return F.coalesce(_col(unit_part), derived_amount(price, up))


# P-14 ---------------------------------------------------------------------
def unit_price_text(ppu1, price, avg_unit) -> Column:
    """Default unit price ``'$ <price> / <unit>'`` when none was listed."""
    price = _col(price)
    avg_unit = _col(avg_unit)
    default = F.when(
        price.isNotNull() & avg_unit.isNotNull(),
        F.concat_ws(" ", F.lit("$"), number_text(price), F.lit("/"), avg_unit),
    )
    return F.coalesce(_col(ppu1), default)


# P-20 ---------------------------------------------------------------------
def clean_name(name) -> Column:
    """Drop the pick-up phrase; surrounding blanks are kept (no trim)."""
    return F.regexp_replace(_col(name), PICKUP_RE, "")


# P-18 ---------------------------------------------------------------------
def record_id(*key_cols, stable: bool = True) -> Column:
    """Row id: a hash of the key (same on retry; null if a key part is) or a random uuid."""
    if not stable:
        return F.expr("uuid()")
    parts = [_col(c).cast("string") for c in key_cols]
    sep = [x for p in parts for x in (F.lit("|"), p)][1:]
    return F.sha2(F.concat(*sep), 256)


__all__ = [
    "null_na_words",
    "product_id",
    "first_line",
    "promo_category",
    "parse_price",
    "unit_parts",
    "unit_price",
    "number_text",
    "derived_amount",
    "average_unit",
    "unit_price_text",
    "clean_name",
    "record_id",
    "UnitParts",
    "UnitPrice",
]
