"""Text rules over JSON payloads kept as one string column.

The rules work on the raw text, not on parsed JSON: the first textual match of a
key wins even when it is nested, broken documents still yield their readable
fields, and a value ends at the next quote.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns. A value follows its key, a colon and optional spaces.
TEXT_VALUE = r'"([^"]*)"'
BARE_NUMBER = r"([0-9.\-]+)"
NUMBER = r'"?([0-9.\-]+)'
DECIMAL = r"[+-]?(?:(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:e[+-]?[0-9]+)?|inf|infinity|nan)"

# Template tokens and the field each one takes, in replacement order.
TEMPLATE_TOKENS = {
    "{{LOAN_ID}}": "loan_id",
    "{{EVENT_ID}}": "event_id",
    "{{EFFECTIVE_DATE}}": "effective_date",
    "{{AMENDMENT_TYPE}}": "amendment_type",
    "{{NEW_RATE}}": "new_rate",
    "{{NEW_TERM_MONTHS}}": "new_term_months",
}

# Unicode whitespace plus the four ASCII separators; needs the (?U) flag.
_SPACE = r"[\s\x1C-\x1F]"


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _after_key(key: str) -> str:
    literal = key.replace("\\E", "\\E\\\\E\\Q")
    return rf'(?U)"\Q{literal}\E"{_SPACE}*:{_SPACE}*'


def _first_value(payload: Column | str, key: str, value: str) -> Column:
    return F.coalesce(F.regexp_extract(_col(payload), _after_key(key) + value, 1), F.lit(""))


def json_string(payload: Column | str, key: str) -> Column:
    """First quoted value stored under ``key``; empty text when there is none."""
    return _first_value(payload, key, TEXT_VALUE)


def json_number(payload: Column | str, key: str, allow_quotes: bool = True) -> Column:
    """First number stored under ``key`` as text; empty text when there is none.

    ``allow_quotes=False`` accepts bare numbers only.
    """
    return _first_value(payload, key, NUMBER if allow_quotes else BARE_NUMBER)


def is_blank(value: Column | str) -> Column:
    """True for NULL, empty and whitespace-only text; never NULL."""
    text = _col(value)
    return text.isNull() | text.rlike(rf"(?U)\A{_SPACE}*\z")


def is_empty(value: Column | str) -> Column:
    """True for NULL and empty text; whitespace counts as a value."""
    text = _col(value)
    return text.isNull() | (text == "")


def parse_rate(value: Column | str) -> Column:
    """Text as a double, NULL when it is not a plain decimal number.

    The shape is checked by pattern because a Java parse also takes ``3.5d``.
    """
    shape = rf"(?i)(?U)\A{_SPACE}*({DECIMAL}){_SPACE}*\z"
    return F.regexp_extract(_col(value), shape, 1).try_cast("double")


def render_template(template: Column | str, **fields: Column | str) -> Column:
    """Put field values in place of the template tokens.

    A NULL value or template counts as empty text. Values are not escaped, and
    tokens are replaced one after the other, so a token inside a value is
    replaced as well when its turn comes later.
    """
    values = {name: _col(fields.get(name, name)) for name in TEMPLATE_TOKENS.values()}
    return reduce(
        lambda text, token: F.replace(
            text, F.lit(token), F.coalesce(values[TEMPLATE_TOKENS[token]], F.lit(""))
        ),
        TEMPLATE_TOKENS,
        F.coalesce(_col(template), F.lit("")),
    )


def text_length(value: Column | str) -> Column:
    """Length in characters as an integer."""
    return F.length(_col(value))
