"""Exact money arithmetic as SQL text: decimals end to end, one rounding at the end."""

from __future__ import annotations

from collections.abc import Iterable

from finloom.schemas import MONEY, TOTAL

# Operands of a division are narrowed to this type so that Spark keeps 14 fractional digits in the quotient
# (two decimal(28,2) would leave 10, and 6 after the multiplication by 100). 22 integer digits remain.
_OPERAND = "DECIMAL(24,2)"


def money(expression: str) -> str:
    return f"CAST({expression} AS {MONEY.simpleString()})"


def amount(expression: str) -> str:
    """A summed amount, decimal(28,2)."""
    return f"CAST({expression} AS {TOTAL.simpleString()})"


def add_up(names: Iterable[str]) -> str:
    """Sum of columns of one row; one NULL part makes the sum NULL."""
    return money(" + ".join(names))


def total(expression: str) -> str:
    """SUM over a group."""
    return amount(f"SUM({expression})")


def quotient(numerator: str, denominator: str) -> str:
    """numerator / denominator to 2 places, half up; NULL for a zero denominator."""
    return amount(f"round(CAST({numerator} AS {_OPERAND}) / nullif(CAST({denominator} AS {_OPERAND}), 0), 2)")


def percentage(part: str, whole: str) -> str:
    """part / whole * 100 to 2 places, half up; NULL for a zero whole."""
    return amount(f"round(CAST({part} AS {_OPERAND}) / nullif(CAST({whole} AS {_OPERAND}), 0) * 100, 2)")
