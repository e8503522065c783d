"""String helpers, and fields of ``k=v<delimiter>k=v`` text.

Each is one built-in regular-expression call, so it stays in generated code.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_empty(text: Column) -> Column:
    return text.isNull() | (text == "")


def is_not_empty(text: Column) -> Column:
    return ~is_empty(text)


def trim_comma(text: Column) -> Column:
    """Drop one comma at either end."""
    return F.regexp_replace(text, "^,|,$", "")


def pad_two(text: Column) -> Column:
    """A ``0`` in front unless two long; longer text is padded too, never cut."""
    return F.when(F.length(text) == 2, text).otherwise(F.concat(F.lit("0"), text))


def _literal(text: str) -> str:
    return "\\Q" + text.replace("\\E", "\\E\\\\E\\Q") + "\\E"


def get_field(text: Column, delimiter: str, field: str) -> Column:
    """Value of the first item ``field=value``; null when absent or empty.

    ``delimiter`` is a regular expression without groups. Trailing ``=`` of an
    item are dropped; an item with another ``=`` in its value is not a match.
    """
    inside = f"(?:(?!{delimiter})[^=])"
    found = F.regexp_extract(
        text, f"(?:^|{delimiter}){_literal(field)}=({inside}+)=*(?={delimiter}|\\z)", 1
    )
    return F.nullif(found, F.lit(""))


def set_field(text: Column, delimiter: str, field: str, value: Column | str) -> Column:
    """Give every item named ``field`` the new value; all other text stays as it is.

    A field that is not there is not added.
    """
    value = F.lit(value) if isinstance(value, str) else value
    item = f"(?s)(^|{delimiter}){_literal(field)}(?:=(?:(?!{delimiter}).)*)?(?={delimiter}|\\z)"
    quoted = F.regexp_replace(value, r"([\\$])", r"\\$1")
    name = field.replace("\\", "\\\\").replace("$", "\\$")
    return F.regexp_replace(text, F.lit(item), F.concat(F.lit("$1" + name + "="), quoted))
