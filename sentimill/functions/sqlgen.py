"""Tiny helpers to write one SQL expression for two dialects.

The same text-processing rules are rendered as Spark SQL (used by the engine through
``F.expr``) and as DuckDB SQL (used by the correctness oracle). Only the handful of
constructs that differ between the two are abstracted here.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Dialect:
    name: str  # "spark" or "duckdb"

    def lit(self, s: str) -> str:
        if self.name == "spark":
            # Spark SQL string literals treat backslash as an escape character.
            return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"
        return "'" + s.replace("'", "''") + "'"

    def let(self, value: str, var: str, body: str) -> str:
        """Bind ``value`` to ``var`` inside ``body`` (evaluated once)."""
        if self.name == "spark":
            return f"transform(array({value}), {var} -> {body})[0]"
        return f"list_transform([{value}], lambda {var}: {body})[1]"

    def replace_all(self, s: str, pattern: str, repl: str) -> str:
        """Regex replace of every match; ``repl`` may use ``$1``-style groups."""
        if self.name == "spark":
            return f"regexp_replace({s}, {self.lit(pattern)}, {self.lit(repl)})"
        return f"regexp_replace({s}, {self.lit(pattern)}, {self.lit(repl.replace('$', chr(92)))}, 'g')"

    def ends_with(self, s: str, suffix: str) -> str:
        fn = "endswith" if self.name == "spark" else "ends_with"
        return f"{fn}({s}, {self.lit(suffix)})"


SPARK = Dialect("spark")
DUCKDB = Dialect("duckdb")

LOWER = "abcdefghijklmnopqrstuvwxyz"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def ascii_lower(d: Dialect, s: str) -> str:
    return f"translate({s}, {d.lit(UPPER)}, {d.lit(LOWER)})"


def ascii_upper(d: Dialect, s: str) -> str:
    return f"translate({s}, {d.lit(LOWER)}, {d.lit(UPPER)})"
