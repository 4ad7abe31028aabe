"""Lenient text-to-value expressions with the meaning of a pandas CSV read.

The expressions are SQL text over a column name: a wide table is then cleaned in one ``selectExpr``.
"""

from __future__ import annotations

# Texts that a pandas CSV read takes as missing, and the marker of the wide file.
NULL_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
    "\\N",
)

# Fixed value: what a plain cast reads as a number and pandas does not: not-a-number, hexadecimal
# digits, and Java's type suffixes ('1d', '2.f'; but 'inf' stays).
UNREADABLE_PATTERN = r"(?i)(nan|[0-9.][df])\s*$|x"

_TOKEN_LIST = ", ".join("'" + token.replace("\\", "\\\\") + "'" for token in NULL_TOKENS)


def null_if_token(column: str) -> str:
    """Null for a missing-value token, the text itself otherwise."""
    return f"if({column} IN ({_TOKEN_LIST}), NULL, {column})"


def to_number(column: str) -> str:
    """Double, or null where the text holds no number; only texts with letters meet the pattern."""
    letters = f"upper({column}) <> lower({column})"
    unreadable = f"{letters} AND {column} RLIKE r'{UNREADABLE_PATTERN}'"
    return f"if({unreadable}, NULL, try_cast({column} AS DOUBLE))"


def to_whole(column: str, kind: str = "bigint") -> str:
    """Whole number, or null; ``3.0`` counts as 3 because a nullable count is read as a double."""
    plain = f"try_cast({column} AS {kind})"
    return f"coalesce({plain}, try_cast(regexp_replace({column}, r'\\.0*\\s*$', '') AS {kind}))"


def to_day(column: str) -> str:
    """Date, or null where the text holds none."""
    return f"try_cast({column} AS DATE)"
