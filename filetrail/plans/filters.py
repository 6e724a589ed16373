"""Query specifications: a small filter tree compiled to one predicate column."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, replace
from datetime import UTC, datetime, timedelta
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from filetrail.functions.fields import event_time, insertion_time
from filetrail.functions.names import date_pattern
from filetrail.schemas import RAW_LISTS

IS, AFTER, BEFORE = "IS", "ON_OR_AFTER", "ON_OR_BEFORE"
MILLISECOND = timedelta(milliseconds=1)
# Fixed value: text of an unset time, which means "unbounded" like empty text.
ZERO_TIME = "0001-01-01 00:00:00 +0000 UTC"


@dataclass(frozen=True)
class Filter:
    operator: str
    term: str
    value: str = ""


@dataclass(frozen=True)
class Group:
    filters: tuple[Filter, ...]
    clause: str = "AND"


@dataclass(frozen=True)
class QuerySpec:
    """A named pull: its filter tree, window gap, and target naming."""

    name: str
    groups: tuple[Group, ...]
    gap: timedelta = timedelta(seconds=10)
    base: str = "events"
    layout: str = "2006-01-02"
    route_by: str = "timeNow"

    def __post_init__(self) -> None:
        date_pattern(self.layout)  # refuses what it can't write

    @staticmethod
    def from_dict(d: Mapping) -> QuerySpec:
        """From the nested form ``{name, groups: [{filters: [...], filterClause}]}``."""
        groups = tuple(
            Group(
                tuple(
                    Filter(f["operator"], f["term"], f.get("value", "")) for f in g["filters"]
                ),
                g.get("filterClause", "AND"),
            )
            for g in d["groups"]
        )
        extra = {k: d[k] for k in ("gap", "base", "layout", "route_by") if k in d}
        return QuerySpec(d["name"], groups, **extra)

    def filters(self) -> list[Filter]:
        return [f for g in self.groups for f in g.filters]

    def first(self, operator: str) -> Filter | None:
        return next((f for f in self.filters() if f.operator == operator), None)

    @property
    def time_term(self) -> str:
        """The time column the bounds are on."""
        bound = self.first(AFTER) or self.first(BEFORE)
        return bound.term if bound else "eventTimestamp"

    @property
    def before_first(self) -> bool:
        order = [f.operator for f in self.filters() if f.operator in (AFTER, BEFORE)]
        return order[:1] == [BEFORE]


def _time(value: str) -> datetime | None:
    if value in ("", ZERO_TIME):
        return None
    t = datetime.fromisoformat(value)
    return t.replace(tzinfo=UTC) if t.tzinfo is None else t.astimezone(UTC)


def bounds(spec: QuerySpec) -> tuple[datetime | None, datetime | None]:
    """(start, end) of the first start and first end filter; None is unbounded."""
    start, end = spec.first(AFTER), spec.first(BEFORE)
    return (_time(start.value) if start else None, _time(end.value) if end else None)


def with_bounds(spec: QuerySpec, start: datetime | None, end: datetime | None) -> QuerySpec:
    """The spec with its first start and first end filter set, in millisecond text."""
    todo = {AFTER: start, BEFORE: end}
    groups = []
    for g in spec.groups:
        filters = []
        for f in g.filters:
            if f.operator in todo:
                f = replace(f, value=_text(todo.pop(f.operator)))
            filters.append(f)
        groups.append(replace(g, filters=tuple(filters)))
    return replace(spec, groups=tuple(groups))


def _text(t: datetime | None) -> str:
    if t is None:
        return ""
    return t.astimezone(UTC).strftime("%Y-%m-%dT%H:%M:%S.") + f"{t.microsecond // 1000:03d}Z"


def instant(t: datetime) -> Column:
    """A UTC instant that compares with timestamp columns of either kind and still
    reaches the scan: Spark folds the text to the column's own type."""
    return F.lit(t.astimezone(UTC).strftime("%Y-%m-%d %H:%M:%S.%fZ"))


def matches(c: Column, value: str) -> Column:
    """``IS``: equality; ``*`` alone means present, not empty; other ``*`` match any text."""
    if value == "*":
        return F.coalesce(c.cast("string") != "", F.lit(False))
    if "*" not in value:
        return c == value
    escaped = value.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_")
    return c.like(escaped.replace("*", "%"))


def compile_filters(
    spec: QuerySpec,
    window: tuple[datetime | None, datetime | None] | None = None,
    times: Mapping[str, Column] | None = None,
    columns: Mapping[str, Column] | None = None,
    strict: bool = False,
) -> Column:
    """One predicate for the whole tree, optionally with other time bounds.

    ``times`` gives the timestamp column for a time term and ``columns`` the column
    for another term, when they are not raw text columns. The end bound is inclusive
    at millisecond precision, so it is read as "before the next millisecond". With
    ``strict``, a time text that doesn't parse fails the query instead of being left out.
    """
    if window is not None:
        spec = with_bounds(spec, *window)
    columns = columns or {}
    first = {id(spec.first(AFTER)), id(spec.first(BEFORE))}
    terms = []
    for g in spec.groups:
        if g.clause.upper() != "AND":
            raise ValueError(f"filter clause not supported: {g.clause}")
        for f in g.filters:
            if f.operator == IS:
                c = columns.get(f.term, F.col(f.term))
                terms.append(_is(c, f))
            elif f.operator in (AFTER, BEFORE):
                if id(f) in first:  # later bounds are ignored
                    terms += _bound(f, (times or {}).get(f.term), strict)
            else:
                raise ValueError(f"filter operator not supported: {f.operator}")
    return reduce(lambda a, b: a & b, terms, F.lit(True))


def _is(c: Column, f: Filter) -> Column:
    if f.term in RAW_LISTS:
        if f.value == "*":
            return F.coalesce(F.size(c) > 0, F.lit(False))
        return F.exists(c, lambda item: matches(item, f.value))
    return matches(c, f.value)


def unread_times(spec: QuerySpec, windowed: bool = False) -> Column:
    """Terms of the times that the query needs of a row and can't read, as an array.

    Needed are the terms of set bounds and, with ``windowed``, the one that windows go by.
    Absent and empty text is not a time either.
    """
    found = [spec.first(op) for op in (AFTER, BEFORE)]
    terms = {f.term for f in found if f and _time(f.value)} | ({spec.time_term} if windowed else set())
    lacking = [F.when(_parsed(t).isNull(), F.lit(t)) for t in sorted(terms)]
    return F.array_compact(F.array(*lacking)) if lacking else F.array().cast("array<string>")


def unreadable(spec: QuerySpec, windowed: bool = False) -> Column:
    """Whether all but the time filters match a row that lacks a time the query needs."""
    others = tuple(replace(g, filters=tuple(f for f in g.filters if f.operator == IS)) for g in spec.groups)
    rest = compile_filters(replace(spec, groups=others))
    return F.coalesce(rest, F.lit(False)) & (F.size(unread_times(spec, windowed)) > 0)


def scan_filter(spec: QuerySpec, window: tuple[datetime | None, datetime | None]) -> Column:
    """What the raw time text of a match must satisfy: a coarse test the file reader can use."""
    spec = with_bounds(spec, *window)
    terms = [t for op in (AFTER, BEFORE) if (f := spec.first(op)) for t in _coarse(f)]
    return reduce(lambda a, b: a & b, terms, F.lit(True))


def _coarse(f: Filter) -> list[Column]:
    """Time text starts with its date, so comparing dates as text is safe."""
    t = _time(f.value)
    if t is None:
        return []
    raw = F.col(f.term)
    if f.operator == AFTER:
        return [raw >= t.date().isoformat()]
    return [raw < (t + MILLISECOND + timedelta(days=1)).date().isoformat()]


def _parsed(term: str, strict: bool = False) -> Column:
    parse = insertion_time if term == "insertionTimestamp" else event_time
    return parse(F.col(term), strict)


def _bound(f: Filter, column: Column | None, strict: bool = False) -> list[Column]:
    t = _time(f.value)
    if t is None:
        return []
    typed = column is not None
    if not typed:
        column = _parsed(f.term, strict)
    terms = [column >= instant(t) if f.operator == AFTER else column < instant(t + MILLISECOND)]
    if not typed and not strict:
        terms += _coarse(f)
    return terms
