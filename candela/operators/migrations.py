"""Schema migrations: numbered SQL files, applied in order of their names."""

from __future__ import annotations

import re
from pathlib import Path

from pyspark.sql import SparkSession

NAME = re.compile(r"\d{3}_.*\.sql")
#: A quoted text, a comment, or the end of a statement.
PIECE = re.compile(r"'(?:[^']|\'\')*'|\"[^\"]*\"|`[^`]*`|--[^\n]*|/\*.*?\*/|;", re.DOTALL)


def statements(text: str) -> list[str]:
    """The statements of a file, cut at semicolons outside quotes and comments; comments are left out."""
    out, parts, at = [], [], 0
    for m in PIECE.finditer(text):
        parts.append(text[at : m.start()])
        at = m.end()
        if m[0] == ";":
            out.append("".join(parts).strip())
            parts = []
        elif not m[0].startswith(("--", "/*")):
            parts.append(m[0])
    out.append("".join([*parts, text[at:]]).strip())
    return [s for s in out if s]


def apply_migrations(spark: SparkSession, folder: str) -> list[str]:
    """Runs every file of the driver's folder named NNN_*.sql, by name; each must be safe to run again. Names of the files run."""
    files = sorted(p for p in Path(folder).iterdir() if NAME.fullmatch(p.name))
    for file in files:
        for statement in statements(file.read_text()):
            spark.sql(statement)
    return [p.name for p in files]
