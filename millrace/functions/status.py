"""Repayment-status characters: severity, grade and the 24-position worst-status aggregate."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Status characters from least (rank 1) to most severe (rank 19).
SEVERITY = "/#C*MNA01234567GDZB"
# Overdue grade of each status character.
GRADES = {
    "B": "8", "Z": "8", "D": "8", "G": "8",
    "7": "7", "6": "6", "5": "5", "4": "4", "3": "3", "2": "2", "1": "1",
    "0": "0", "A": "0", "N": "0", "M": "0",
    "*": ".", "C": ".", "#": ".", "/": ".",
}
POSITIONS = 24
_DIGITS = "0123456789abcdefghijklmnopqrstuv"
_PER_NUMBER = 12  # five bits each, so that a number stays below 2^60


def status_rank(c: Column, severity: str = SEVERITY) -> Column:
    """1..19, 0 for anything else."""
    return F.when(F.length(c) == 1, F.instr(F.lit(severity), c)).otherwise(F.lit(0))


def status_grade(c: Column) -> Column:
    """Overdue grade, null for an unknown character."""
    pairs = [F.lit(x) for kv in GRADES.items() for x in kv]
    return F.create_map(*pairs)[c]


def worst_status(column: str, severity: str = SEVERITY, positions: int = POSITIONS) -> Column:
    """Aggregate: per position the most severe character of the group.

    The last ``positions`` characters count; shorter text is an error; nulls are passed over and a
    group of nulls only gives the least severe character everywhere.
    """
    return F.expr(worst_status_sql(column, severity, positions))


def worst_status_sql(text: str, severity: str = SEVERITY, positions: int = POSITIONS) -> str:
    """The same aggregate as SQL text, for scripts: hand it in as a variable.

    A text becomes a few numbers, each holding the ranks of twelve positions as base-32 digits, so
    that the aggregate takes plain maxima of five-bit fields. All buffers have a fixed width, which
    keeps it a hash aggregate.
    """
    if len(severity) >= len(_DIGITS):
        raise ValueError(f"at most {len(_DIGITS) - 1} status characters")
    if "'" in severity or "\\" in severity:
        raise ValueError("quotes and backslashes cannot be status characters")
    known = re.escape(severity)
    clean = (
        f"CASE WHEN {text} RLIKE r'^[{known}]*$' THEN {text} "
        f"ELSE translate(regexp_replace({text}, r'[^{known}]', '~'), '~', '{severity[0]}') END"
    )
    ranks = f"translate(right({clean}, {positions}), '{severity}', '{_DIGITS[1 : len(severity) + 1]}')"
    chars = []
    for start in range(0, positions, _PER_NUMBER):
        width = min(_PER_NUMBER, positions - start)
        number = f"cast(conv(substring({ranks}, {start + 1}, {width}), 32, 10) as bigint)"
        for i in range(width):
            rank = f"shiftright({number}, {5 * (width - 1 - i)}) & 31"
            chars.append(f"substring('{severity}', cast(coalesce(max({rank}), 1) as int), 1)")
    shortest = f"min(length({text}))"
    message = f"concat('status text shorter than {positions}: length ', {shortest})"
    return (
        f"CASE WHEN {shortest} < {positions} THEN cast(raise_error({message}) as string) "
        f"ELSE concat({', '.join(chars)}) END"
    )


def is_integer_text(c: Column) -> Column:
    """Optional sign and digits; empty text and a bare sign pass too."""
    return c.rlike(r"^[-+]?[0-9]*$")
