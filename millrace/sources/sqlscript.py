"""Running SQL script files."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

_PIECES = re.compile(
    r"""(?P<skip>--[^\n]*|/\*.*?\*/)|(?P<quoted>'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*"|`[^`]*`)|(?P<end>;)|(?P<other>.)""",
    re.S,
)


def substitute(text: str, variables: dict[str, str]) -> str:
    """Replace ``${name}``; names without a value stay as they are."""
    return re.sub(r"\$\{(\w+)\}", lambda m: variables.get(m.group(1), m.group(0)), text)


def split_statements(text: str) -> list[str]:
    """Cut at semicolons outside quotes and comments; blank statements are skipped."""
    parts, current = [], []
    for m in _PIECES.finditer(text):
        if m.lastgroup == "end":
            parts.append("".join(current))
            current = []
        else:
            current.append(" " if m.lastgroup == "skip" else m.group(0))
    parts.append("".join(current))
    return [p.strip() for p in parts if p.strip()]


def run_sql_script(
    spark: SparkSession, text: str, variables: dict[str, str] | None = None
) -> list[DataFrame]:
    """Run each statement in order; queries stay lazy, commands run at once."""
    return [spark.sql(s) for s in split_statements(substitute(text, variables or {}))]


def read_script(spark: SparkSession, path: str) -> str:
    """The text of one script file on any file system Spark can reach."""
    return spark.read.text(path, wholetext=True).first()[0]
