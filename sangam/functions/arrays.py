"""String arrays written as text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# A quoted run with backslash escapes, kept raw. Possessive, as no shorter run could be followed by the
# quote: so a long item is matched in a loop, with nothing kept to go back to.
SINGLE_QUOTED = r"'((?:[^'\\]++|\\.)*+)'"
DOUBLE_QUOTED = r'"((?:[^"\\]++|\\.)*+)"'


def parse_array_repr(cell: Column, strict: bool = False) -> Column:
    """Items of a printed array such as ``['a' 'b']``; a null cell has none.

    By default only single quotes delimit an item, so a double-quoted item is
    lost or cut at its apostrophe.  ``strict`` takes both kinds of quotes.
    """
    if strict:
        quoted = F.regexp_extract_all(cell, F.lit(f"{SINGLE_QUOTED}|{DOUBLE_QUOTED}"), F.lit(0))
        items = F.transform(quoted, lambda q: q.substr(F.lit(2), F.length(q) - 2))
    else:
        items = F.regexp_extract_all(cell, F.lit(SINGLE_QUOTED), F.lit(1))
    return F.coalesce(items, F.array().cast("array<string>"))


def array_to_text(items: Column) -> Column:
    """JSON text of a string array, for sinks without array columns."""
    return F.to_json(items)


def text_to_array(cell: Column) -> Column:
    return F.from_json(cell, "array<string>")
