"""Names made from times: window ids and time-routed target names."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

WINDOW_TIME = "yyyy.MM.dd.HH.mm.ss.SSS"
#: Longest query name kept whole, in bytes; the id has to fit a folder name of 255.
NAME_BYTES = 190
ESCAPED_NAME_BYTES = 60
DEFAULT_LAYOUT = "2006-01-02"

# Reference-time layout element -> date_format pattern.
LAYOUT = {
    "2006": "yyyy",
    "06": "yy",
    "January": "MMMM",
    "Jan": "MMM",
    "01": "MM",
    "1": "M",
    "Monday": "EEEE",
    "Mon": "EEE",
    "02": "dd",
    "2": "d",
    "15": "HH",
    "03": "hh",
    "3": "h",
    "04": "mm",
    "4": "m",
    "05": "ss",
    "5": "s",
    "PM": "a",
    "002": "DDD",
    "MST": "z",
    "-0700": "xx",
    "-07:00": "xxx",
    "-07": "x",
    "Z0700": "XX",
    "Z07:00": "XXX",
    "Z07": "X",
}
# Elements that no pattern gives: padding with blanks, small letters.
REFUSED = ("_2", "__2", "pm")
#: Parts of a second: zeros or nines after a mark, with no other digit behind them.
_FRACTION = r"[.,](?:0+|9+)(?![0-9])"
_ELEMENT = re.compile(
    "|".join([_FRACTION, "__2", "_2(?!006)", *(
        re.escape(k) for k in sorted((*LAYOUT, *REFUSED), key=len, reverse=True) if k[0] != "_"
    )])
)


def date_pattern(layout: str) -> str:
    """A ``date_format`` pattern for a reference-time layout such as ``2006-01-02``.

    A layout with an element that no pattern gives is refused.
    """
    out, at = [], 0
    for m in _ELEMENT.finditer(layout):
        element = m.group()
        if element[0] == "." and 2 <= len(element) <= 10 and not element.strip(".0"):
            pattern = "." + "S" * (len(element) - 1)
        elif element in LAYOUT:
            pattern = LAYOUT[element]
        else:
            raise ValueError(f"layout element not supported: {element} in {layout}")
        out += [_literal(layout[at : m.start()]), pattern]
        at = m.end()
    return "".join(out + [_literal(layout[at:])])


def _literal(text: str) -> str:
    # Letters, quotes and brackets mean something in a pattern, so quote them.
    quoted = text.replace("'", "''")
    return f"'{quoted}'" if re.search(r"[A-Za-z'\[\]{}#]", text) else text


def target_name(base: str | Column, time: Column, layout: str = DEFAULT_LAYOUT) -> Column:
    """``base`` or ``base-<formatted time>``; an empty layout leaves the base alone."""
    base = F.lit(base) if isinstance(base, str) else base
    if not layout:
        return base
    return F.concat(base, F.lit("-"), F.date_format(time, date_pattern(layout)))


def window_id(
    name: str | Column, on_or_after: Column, on_or_before: Column, before_first: bool = False
) -> Column:
    """Name, ``A<start>`` and ``B<end>``; ids of different windows always differ.

    The bounds are never cut. A name too long for a folder is shortened to its beginning
    and a hash of the whole; one with characters that folder names escape is too long
    sooner. ``before_first`` puts the end first, for a query whose filters list it first.
    """
    name = short_name(F.lit(name) if isinstance(name, str) else name)
    start = F.concat(F.lit("A"), F.date_format(on_or_after, WINDOW_TIME))
    end = F.concat(F.lit("B"), F.date_format(on_or_before, WINDOW_TIME))
    marks = [end, start] if before_first else [start, end]
    return F.concat(name, *marks)


def short_name(name: Column) -> Column:
    limit = F.when(name.rlike(r"^[A-Za-z0-9_. -]*\z"), NAME_BYTES).otherwise(ESCAPED_NAME_BYTES)
    short = F.concat(F.regexp_replace(F.substring(name, 1, 32), "[^A-Za-z0-9_. -]", "_"),
                     F.lit("-"), F.substring(F.sha2(name, 256), 1, 32))
    return F.when(F.octet_length(name) <= limit, name).otherwise(short)
