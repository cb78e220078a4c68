"""Small pieces of SQL text.

Wide projections are stated as SQL text: one parsed expression per column is far
cheaper to build on the driver than hundreds of nested column objects.
"""

from __future__ import annotations

from collections.abc import Iterable


def name(column: str) -> str:
    """Quoted identifier."""
    return "`" + column.replace("`", "``") + "`"


def value(literal: object) -> str:
    """SQL literal; doubles keep all their digits."""
    if literal is None:
        return "NULL"
    if isinstance(literal, bool):
        return "true" if literal else "false"
    if isinstance(literal, int):
        return str(literal)
    if isinstance(literal, float):
        return f"{literal!r}D"
    text = str(literal).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{text}'"


def values(literals: Iterable[object]) -> str:
    return ", ".join(value(v) for v in literals)


def flag(condition: str) -> str:
    """0/1 with null conditions counted as 0."""
    return f"int(coalesce({condition}, false))"
