"""Data-quality predicates on user names and target names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Lengths count bytes in UTF-8.
MAX_USER_BYTES = 254
MAX_TARGET_BYTES = 255

# Fixed value: what counts as an e-mail address (the HTML5 form-field rule).
EMAIL = (
    r"^[a-zA-Z0-9.!#$%&'*+\/=?^_`{|}~-]+@[a-zA-Z0-9](?:[a-zA-Z0-9-]{0,61}[a-zA-Z0-9])?"
    r"(?:\.[a-zA-Z0-9](?:[a-zA-Z0-9-]{0,61}[a-zA-Z0-9])?)*\z"
)

# Characters a target name must not have, and must not start with.
FORBIDDEN = ["\\", "/", "*", "?", '"', "<", ">", "|", " "]
FORBIDDEN_FIRST = ["_", "-", "+"]


def valid_user_name(c: Column) -> Column:
    """True for an e-mail address of at most 254 bytes, also false for NULL."""
    return F.coalesce((F.octet_length(c) <= MAX_USER_BYTES) & c.rlike(EMAIL), F.lit(False))


def target_name_problem(c: Column) -> Column:
    """The first rule a target name breaks, or NULL for a valid name."""
    out = F.when(c.isNull() | (c == ""), "empty").when(c.rlike("[A-Z]"), "capital letter")
    for mark in FORBIDDEN:
        out = out.when(c.contains(mark), f"contains {mark}" if mark != " " else "contains space")
    for mark in FORBIDDEN_FIRST:
        out = out.when(c.startswith(mark), f"starts with {mark}")
    return (
        out.when(c == ".", "is .")
        .when(c == "..", "is ..")
        .when(F.octet_length(c) > MAX_TARGET_BYTES, "too long")
    )
