"""Lookups on coded columns: diagnosis codes, age brackets, id groups.

Each function takes the SQL text of its argument and returns SQL text.
"""

from __future__ import annotations

from collections.abc import Iterable

from riskloom.functions import sqltext
from riskloom.schema import AGE_BRACKETS, ICD_RANGES, ICD_WHOLE_CODES

# A decimal number as text. Words such as "inf", and suffixes such as the "d" of
# "250d", parse as doubles in the engine but are not diagnosis codes.
NUMBER_PATTERN = "^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"


def code_number(code: str) -> str:
    """Numeric value of a diagnosis code, null for anything else."""
    return f"CASE WHEN trim({code}) RLIKE '{NUMBER_PATTERN}' THEN try_cast(trim({code}) AS DOUBLE) END"


def icd9_category(code: str, number: str | None = None) -> str:
    """Clinical group of an ICD-9 code.

    ``number`` is the code's ``code_number`` when the caller has it as a column, which
    saves parsing the text again for every range.
    """
    number = number or f"({code_number(code)})"
    cases = [f"WHEN upper(left(trim({code}), 1)) IN ('V', 'E') THEN 'External'"]
    for whole, group in ICD_WHOLE_CODES:
        cases.append(f"WHEN {number} = {whole}D THEN '{group}'")
    for low, high, group in ICD_RANGES:
        # The truncated value lies in [low, high].
        cases.append(f"WHEN {number} >= {low}D AND {number} < {high + 1}D THEN '{group}'")
    return f"CASE {' '.join(cases)} ELSE 'Other' END"


def group_pairs(groups: Iterable[tuple[str, tuple[int, ...]]]) -> list[tuple[int, str]]:
    """Flatten ``(group, codes)`` into ``(code, group)`` rows."""
    return [(code, group) for group, codes in groups for code in codes]


def code_group(code: str, groups: Iterable[tuple[str, tuple[int, ...]]], default: str = "Other") -> str:
    """Group of an id in a fixed table, ``default`` when absent or null."""
    cases = " ".join(
        f"WHEN {code} IN ({sqltext.values(codes)}) THEN {sqltext.value(group)}"
        for group, codes in groups
    )
    return f"CASE {cases} ELSE {sqltext.value(default)} END"


def age_ordinal(age: str) -> str:
    """0..9 for a ten-year bracket, -1 otherwise."""
    brackets = sqltext.values(AGE_BRACKETS)
    # array_position is 1-based, 0 for no match and null for null.
    return f"coalesce(int(array_position(array({brackets}), {age})), 0) - 1"
