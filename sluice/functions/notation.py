"""Scientific and blood-group notation as plain characters: an ordered table of rewriting steps, applied in Arrow batches.

The steps depend on one another's results, look behind and ahead, and translate what they match, which built-in replacements
cannot do. Each names literals without which it cannot match, so that a text without markup passes most of
them by a substring test. Runs of white space are entered at their first character only, so a long run costs its length.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import lru_cache
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# Commands, and the characters that digits, signs, letters and ordinals become.
COMMANDS = {"alpha": "α", "beta": "β", "delta": "δ", "epsilon": "ε", "varepsilon": "ε", "gamma": "γ", "theta": "θ", "chi": "χ", "mu": "μ", "zeta": "ζ"}
SUB = dict(zip("0123456789+-", "₀₁₂₃₄₅₆₇₈₉₊₋", strict=True))
SUP = dict(zip("0123456789+-", "⁰¹²³⁴⁵⁶⁷⁸⁹⁺⁻", strict=True))
SUP_LETTERS = dict(zip("abcdekmnuw", "ᵃᵇᶜᵈᵉᵏᵐⁿᵘʷ", strict=True))
SUB_LETTERS = dict(zip("aehijklmnoprstuvx", "ₐₑₕᵢⱼₖₗₘₙₒₚᵣₛₜᵤᵥₓ", strict=True))
ORDINALS = {"st": "ˢᵗ", "nd": "ⁿᵈ", "rd": "ʳᵈ", "th": "ᵗʰ"}

Part = str | int | tuple[int, dict[str, str]]


class Step(NamedTuple):
    """What the pattern matches becomes `parts`: texts, groups, and groups looked up whole or letter by letter."""

    pattern: str
    parts: tuple[Part, ...] | Callable[[re.Match], str]
    needs: tuple[str, ...] = ()
    flags: int = 0


def literal(old: str, new: str) -> Step:
    return Step(re.escape(old), (new,), (old,))


_COMMAND = "|".join(sorted(COMMANDS, key=len, reverse=True))
_SLASH, _CIRC, _DEGREE, _GREEK = ("\\",), ("\\circ",), ("°", "˚"), "[α-ωΑ-Ω]"
# One of these is in whatever a step matches: Greek letters, doubled blanks, blood-group systems.
_GREEKS = tuple(map(chr, (*range(0x3B1, 0x3CA), *range(0x391, 0x3AA))))
_WIDE = ("  ", " \t", "\t ", "\t\t")
_SYSTEMS = ("Fy", "Jk", "JK", "Le", "Lu", "Di", "Mi", "Kp", "C")
_NUMBER, _LOWERED = r"(-?\d+(?:\.\d+)?)", "[₀₁₂₃₄₅₆₇₈₉]"

# Patterns and their order.
SCIENCE: tuple[Step, ...] = (
    Step(r"\$?\\mu\$?\s*([a-zA-Z])", ("μ", 1), _SLASH),
    Step(r"\\mu\s+([a-zA-Z])", ("μ", 1), _SLASH),
    Step(rf"\$?\\({_COMMAND})\$?\s*_\{{?(\d+)\}}?", ((1, COMMANDS), 2), _SLASH),
    Step(rf"\$?\\({_COMMAND})\$?\s+(\d+)", ((1, COMMANDS), 2), _SLASH),
    Step(rf"\$?\\({_COMMAND})\$?", ((1, COMMANDS),), _SLASH),
    Step(r"\\(?:mathbf|mathrm|mathit|text)\{([^{}]+)\}", (1,), _SLASH),
    literal(r"\triangle", "△"),
    literal(r"\%", "%"),
    Step(r"(\d+(?:\.\d+)?)\s*\$?\s*\^\{(?:\\mathrm\{)?(st|nd|rd|th)(?:\})?\}", (1, (2, ORDINALS)), ("^{",)),
    Step(rf"\$?\s*{_NUMBER}\s*\$?\s*\^\s*\{{?\\circ\}}?\s*\$?\s*(?:\\mathrm\{{C\}}|C)", (1, "℃"), _CIRC),
    Step(rf"\$?\s*{_NUMBER}\s*(?:°|˚)\s*C\b", (1, "℃"), _DEGREE),
    Step(r"\^\s*\{?\\circ\}?\s*(?:\\mathrm\{C\}|C)", ("℃",), _CIRC),
    Step(r"(?:°|˚)\s*C\b", ("℃",), _DEGREE),
    Step(r"\^\s*\{?\\circ\}?", ("°",), _CIRC),
    Step(r"(\d+(?:\.\d+)?)\s*-\s*(\d+(?:\.\d+)?)℃", (1, "-", 2, "℃"), ("℃",)),
    literal(r"\rightarrow", "→"),
    literal(r"\to", "→"),
    literal(r"\uparrow", "↑"),
    literal(r"\downarrow", "↓"),
    literal(r"\left", ""),
    literal(r"\right", ""),
    literal(r"\times", "×"),
    literal(r"\cdot", "·"),
    literal(r"\log", "log"),
    literal(r"\sim", "～"),
    literal("∼", "～"),
    Step(r"\\mathrm\{([^{}]+)\}", (1,), _SLASH),
    literal(r"\geq", "≥"),
    literal(r"\leq", "≤"),
    literal("T_{1/2}", "T₁/₂"),
    literal("t_{1/2}", "t₁/₂"),
    literal(r"V_{\max}", "Vmax"),
    literal(r"V_{max}", "Vmax"),
    Step(r"\^\{\s*([0-9]+)\s*([+-])\s*\}", ((1, SUP), (2, SUP)), ("^{",)),
    Step(r"_\{([0-9A-Za-z+-.]+)\}", ((1, SUB),), ("_{",)),
    Step(r"_\{([A-Za-z]+[₀₁₂₃₄₅₆₇₈₉₊₋]+)\}", (1,), ("_{",)),
    Step(r"\^\{([0-9A-Za-z+-]+)\}", ((1, SUP),), ("^{",)),
    Step(r"_([0-9+-])", ((1, SUB),), ("_",)),
    Step(r"\^([0-9+-])", ((1, SUP),), ("^",)),
    Step(r"\b2₂S\b", ("2₂s",), ("2₂S",)),
    literal("R₄S", "R₄s"),
    Step(r"\b4₁S\b", ("4₁s",), ("4₁S",)),
    Step(r"\b10[Xx]\b", ("10ₓ",), ("10X", "10x")),
    Step(r"\\mathrm\{([^{}]+)\}", (1,), _SLASH),
    Step(r"(?<=\d)\\\s+(?=[A-Za-zμ])", (" ",), _SLASH),
    Step(r"\$([^$]+)\$", (1,), ("$",)),
    literal("$", ""),
    Step(r"(?<!\\)\}\s*$", ("",), ("}",)),
    Step(rf"({_GREEK}\d*)\s*-\s*", (1, "-"), ("-",)),
    Step(rf"\(\s*({_GREEK}\d*)\s*-\s*", ("(", 1, "-"), ("(",)),
    Step(rf"({_GREEK})\s+([\u4e00-\u9fff])", (1, 2), _GREEKS),
    Step(rf"([A-Za-z])\s+({_LOWERED})", (1, 2), tuple(SUB.values())),
    Step(r"（\s*([^（）]+?)\s*）", ("（", 1, "）"), ("（",)),
    Step(rf"(?<={_LOWERED})\s+(?=[A-Z])", ("",), tuple(SUB.values())),
    Step(r"\b([μmunp])\s+g\b", (1, "g"), ("g",)),
    Step(r"μ\s*m\b", ("μm",), ("μ",)),
    Step(r"(?<!\s)\s+([μmunp]?mol|[μmunp]?g|mL|dL|L|cm|m)\b", (" ", 1)),
    Step(r"\b([μmunp]?g)\s*/\s*(dL|mL|L)\b", (1, "/", 2), ("/",)),
    Step(r"\b(MΩ)\s*/\s*(cm)\b", (1, "/", 2), ("MΩ",)),
    Step(r"\b([pP]CO)2\b", (1, "₂"), ("CO2",)),
    Step(r"\b([pP])\s*O₂\b", (1, "O₂"), ("O₂",)),
    Step(r"\b([pP])\s*CO₂\b", (1, "CO₂"), ("CO₂",)),
    Step(r"\bDL\s+CO\b", ("DLCO",), ("CO", "Co", "cO", "co"), re.I),
    Step(r"\bSO\s*₂\b", ("SO₂",), ("₂",)),
    Step(r"\bFEV\s*₁(?:\.₀)?\s*%\b", ("FEV₁%",), ("FEV",)),
    Step(r"\bFEV\s*₁(?:\.₀)?\s*/\s*FVC\b", ("FEV₁/FVC",), ("FEV",)),
    Step(r"(?<!\s)\s+([，。；：、])", (1,), ("，", "。", "；", "：", "、")),
    Step(r"[ \t]{2,}", (" ",), _WIDE),
)


def _antibody(m: re.Match) -> str:
    system = {"JK": "Jk"}.get(m["system"], m["system"])
    return ("Anti-" if m["prefix"] else "") + system + SUP_LETTERS[m["suffix"]]


def _subtype(m: re.Match) -> str:
    kind = (m["braced"] or m["plain"]).lower()
    return m["abo"].upper() + {"h": "ₕ", "m": "ₘ"}.get(kind, f"_{{{kind}}}")


def _anti(rest: str) -> Callable[[re.Match], str]:
    return lambda m: m[1].capitalize() + rest


# Patterns and their order.
BLOOD_GROUPS: tuple[Step, ...] = (
    Step(r"(?<![A-Za-z])(?P<prefix>(?:[Aa]nti|ANTI|Anti)\s*[- ]\s*)?(?P<system>Fy|Jk|JK|Le|Lu|Di|Mi|Kp|C)\s*(?P<suffix>[abcw])(?![A-Za-z])", _antibody, _SYSTEMS),
    Step(r"\b([Aa]nti)\s*-\s*P\s*₁\b", _anti("-P₁"), ("₁",)),
    Step(r"\b([Aa]nti)-PP₁P\s*k\b", _anti("-PP₁Pᵏ"), ("-PP₁P",)),
    Step(r"\bweak\s+D\s*\(\s*D\s*u\s*\)", ("weak D (Dᵘ)",), ("(",), re.I),
    Step(r"\bD\s+u\b", ("Dᵘ",), ("D",)),
    Step(r"\bRh\s*null\b", ("Rh_{null}",), ("RH", "Rh", "rH", "rh"), re.I),
    Step(r"\b([ABO])\s*_\s*h\b", (1, "ₕ"), ("_",), re.I),
    Step(r"\b([AO])\s*([12])\b(?=\s*(?:cells?|cell|亞型|血型|抗原|subgroup|subtype))", (1, (2, SUB)), ("1", "2"), re.I),
    Step(r"\b(?P<abo>[ABO])\s*(?:_\{?(?P<braced>h|el|end|m)\}?|(?P<plain>h|el|end|m))\b", _subtype, (), re.I),
    Step(r"\b(BFU|CFU)\s*E\b", (1, "_{E}"), ("FU",)),
    Step(r"\blate\s+BFU\s*E\b", ("late BFU_{E}",), ("FU", "Fu", "fU", "fu"), re.I),
    Step(r"\bFactor\s+V_\{\\text\{Leiden\}\}", ("Factor V_{Leiden}",), ("Leiden",)),
    Step(r"\bPFA-100\s*\^\{®\}", ("PFA-100®",), ("PFA-100",)),
    Step(r"\bSe\s*w(?=[⁰¹²³⁴⁵⁶⁷⁸⁹0-9])", ("Seʷ",), ("Se",)),
)
# What follows the blood groups.
AFTERWARDS: tuple[Step, ...] = (
    literal("R₄S", "R₄s"),
    literal(r"\~", "～"),
    Step(r"(?<!\s)\s*[~～]\s*(?=mmHg\b)", (" ",), ("mmHg",)),
)
# Readings of candidates that are peculiar to haematology.
HAEMATOLOGY: tuple[Step, ...] = (
    Step(r"\b([GA])y\b", (1, "γ"), ("y",)),
    Step(r"\bFC\s*Y\s+receptor\b", ("Fcγ receptor",), ("FC", "Fc", "fC", "fc"), re.I),
    Step(r"\bB_\{\.H⁺\}", ("B·H⁺",), ("H⁺",)),
)
FULL = (*SCIENCE, *BLOOD_GROUPS, *AFTERWARDS)
CANDIDATE = (*FULL, *BLOOD_GROUPS, *HAEMATOLOGY)


def _replacement(parts: tuple[Part, ...] | Callable[[re.Match], str]) -> Callable[[re.Match], str]:
    if callable(parts):
        return parts

    def looked_up(value: str, names: dict[str, str]) -> str:
        return names[value] if value in names else "".join(names.get(c, c) for c in value)

    def made(m: re.Match) -> str:
        return "".join(p if isinstance(p, str) else m[p] if isinstance(p, int) else looked_up(m[p[0]], p[1]) for p in parts)

    return made


def rewriter(steps: tuple[Step, ...]) -> Callable[[str], str]:
    """One text through all steps, in order; those whose literals cannot all be made from its characters are passed at once."""
    ready = [(re.compile(s.pattern, s.flags), _replacement(s.parts), s.needs) for s in steps]
    starts = frozenset(x[0] for s in steps for x in s.needs)

    @lru_cache(4096)
    def with_characters(present: frozenset[str], since: int) -> tuple[int, ...]:
        return tuple(i for i in range(since, len(ready)) if not ready[i][2] or any(x[0] in present for x in ready[i][2]))

    def of(text: str) -> str:
        todo = with_characters(starts.intersection(text), 0)
        while todo:
            for i in todo:
                pattern, made, needs = ready[i]
                if not needs or any(x in text for x in needs):
                    new = pattern.sub(made, text)
                    if new != text:  # what comes later is judged on the new characters
                        text, todo = new, with_characters(starts.intersection(new), i + 1)
                        break
            else:
                break
        return text

    return of


#: Rows whose texts are Python objects at once, and the texts that are remembered.
ROWS, KNOWN, SHORT = 128, 20_000, 400


def _remembered(of: Callable[[str], str]) -> Callable[[str | None], str | None]:
    """`of`, with the results of a bounded number of short texts kept."""
    known: dict[str, str] = {}

    def one(text: str | None) -> str | None:
        if text is None or len(text) > SHORT:
            return text and of(text)
        if text not in known:
            if len(known) >= KNOWN:
                known.clear()
            known[text] = of(text)
        return known[text]

    return one


def _by_rows(column: pa.Array, kind: pa.DataType, f: Callable) -> pa.Array:
    """f of each value, ROWS at a time, so that a batch of long texts is never whole as Python objects."""
    parts = [pa.array([f(x) for x in column.slice(at, ROWS).to_pylist()], kind) for at in range(0, len(column), ROWS)]
    return pa.concat_arrays(parts) if parts else pa.array([], kind)


def _batches(steps: tuple[Step, ...]):
    """The steps over an Arrow column."""

    @F.arrow_udf("string")
    def rewritten(column: pa.Array) -> pa.Array:
        return _by_rows(column, pa.string(), _remembered(rewriter(steps)))

    return rewritten


def science_notation(c: Column) -> Column:
    """All steps of science, then blood groups; null stays null."""
    return _batches(FULL)(c)


def blood_groups(c: Column) -> Column:
    return _batches(BLOOD_GROUPS)(c)


def candidate_notation(c: Column) -> Column:
    """science_notation, and the readings of haematology.

    Blood groups are gone through twice, as results must equal the source's: a braced subtype then gains a brace.
    """
    return _batches(CANDIDATE)(c)


def _all(steps: tuple[Step, ...]):
    """The steps over every text of arrays of texts."""

    @F.arrow_udf("array<string>")
    def rewritten(column: pa.Array) -> pa.Array:
        one = _remembered(rewriter(steps))
        return _by_rows(column, pa.list_(pa.string()), lambda texts: None if texts is None else [one(t) for t in texts])

    return rewritten


def candidate_notation_all(c: Column) -> Column:
    """candidate_notation of every text of an array of texts."""
    return _all(CANDIDATE)(c)


def science_notation_all(c: Column) -> Column:
    """science_notation of every text of an array of texts."""
    return _all(FULL)(c)
