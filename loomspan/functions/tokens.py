"""Key tokens and their categories."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The tokens of each category.
CATEGORIES = {
    "space": ("SPACE", " "),
    "backspace": ("BACKSPACE",),
    "delete": ("DELETE", "DEL"),
    "enter": ("ENTER", "RETURN"),
    "capslock": ("CAPSLOCK", "CAPS_LOCK"),
    "shift": ("SHIFT", "SHIFTLEFT", "SHIFTRIGHT"),
    "control": ("CTRL", "CONTROL", "CONTROLLEFT", "CONTROLRIGHT", "CTRLL", "CTRLR"),
    "alt": ("ALT", "ALTLEFT", "ALTRIGHT", "OPTION"),
    "tab": ("TAB",),
    "escape": ("ESC", "ESCAPE"),
    "insert": ("INSERT", "INS"),
    "cursor": ("ARROWLEFT", "ARROWRIGHT", "ARROWUP", "ARROWDOWN", "LEFT", "RIGHT", "UP", "DOWN", "HOME", "END", "PAGEUP", "PAGEDOWN"),
}
# Cells that a CSV reader of the pandas kind takes for missing.
MISSING = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")


def normalise(raw: Column) -> Column:
    """Missing cells become the empty token; others are trimmed and upper-cased, but for a single character that is no letter. A lone space is trimmed away."""
    s = F.regexp_replace(raw, r"^\s+|\s+$", "")
    return F.when(raw.isNull() | raw.isin(*MISSING), F.lit("")).when((F.length(s) == 1) & ~s.rlike(r"^\p{L}$"), s).otherwise(F.upper(s))


def is_space(token: Column) -> Column:
    return token.isin(*CATEGORIES["space"])


def category(token: Column) -> Column:
    out = None
    for name, tokens in CATEGORIES.items():
        out = (F if out is None else out).when(token.isin(*tokens), F.lit(name))
    return out.when(token.rlike(r"^\p{L}$"), "alphabetic").when(token.rlike(r"^[\p{Nd}²³¹⁰-⁹₀-₉]$"), "digit").when((F.length(token) == 1) & ~token.rlike(r"^[\p{L}\p{N}]$"), "punctuation").otherwise("other")
