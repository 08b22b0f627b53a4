"""Scientific markup rendered as plain characters: a chain of built-in replacements.

Covers degree signs, arrows, comparison and Greek commands, units, super- and subscripts of digits and signs.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Commands and the characters they stand for.
SYMBOLS = {
    "alpha": "α", "beta": "β", "gamma": "γ", "delta": "δ", "epsilon": "ε", "theta": "θ", "kappa": "κ", "lambda": "λ",
    "mu": "μ", "pi": "π", "rho": "ρ", "sigma": "σ", "tau": "τ", "phi": "φ", "chi": "χ", "psi": "ψ", "omega": "ω",
    "Delta": "Δ", "Omega": "Ω", "rightarrow": "→", "uparrow": "↑", "downarrow": "↓", "times": "×", "cdot": "·",
    "geq": "≥", "leq": "≤", "sim": "～", "triangle": "△", "pm": "±",
}
SUPERSCRIPTS = ("0123456789+-", "⁰¹²³⁴⁵⁶⁷⁸⁹⁺⁻")
SUBSCRIPTS = ("0123456789+-", "₀₁₂₃₄₅₆₇₈₉₊₋")


def _scripts(c: Column, mark: str, table: tuple[str, str]) -> Column:
    """Each braced or single run after the mark, translated; pieces between runs stay."""
    pattern = rf"\{mark}(?:\{{([0-9+\-]+)\}}|([0-9+\-]))"
    marked = F.regexp_replace(c, pattern, "\u0001$1$2\u0002")
    parts = F.split(marked, "\u0001")
    rest = F.transform(F.slice(parts, 2, F.size(parts)), lambda p: F.concat(F.translate(F.substring_index(p, "\u0002", 1), *table), F.substring_index(p, "\u0002", -1)))
    return F.when(F.contains(c, F.lit(mark)), F.concat(parts[0], F.array_join(rest, ""))).otherwise(c)


def science(c: Column) -> Column:
    c = F.regexp_replace(c, r"\\(?:mathrm|mathbf|mathit|text)\{([^{}]+)\}", "$1")
    c = F.regexp_replace(c, r"\$?\s*\^\s*\{?\\circ\}?\s*\$?\s*C\b", "℃")
    c = F.regexp_replace(c, r"[°˚]\s*C\b", "℃")
    c = F.regexp_replace(c, r"\^\s*\{?\\circ\}?", "°")
    for name in sorted(SYMBOLS, key=len, reverse=True):
        c = F.regexp_replace(c, rf"\$?\\{name}(?![A-Za-z])\$?", SYMBOLS[name])
    c = F.regexp_replace(c, r"\\(?:left|right)(?![A-Za-z])", "")
    c = F.replace(c, F.lit("\\%"), F.lit("%"))
    c = _scripts(_scripts(c, "^", SUPERSCRIPTS), "_", SUBSCRIPTS)
    c = F.regexp_replace(c, r"\$([^$]+)\$", "$1")
    return F.regexp_replace(c, r"[ \t]{2,}", " ")
