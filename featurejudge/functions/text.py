"""Text functions: keyword flags, first token, defaults, display labels.

All functions return Spark Columns; none is a Python UDF.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# FIXED VALUES.  Keyword vocabularies that must equal the surveyed workflow's
# for flag parity.  Each tuple is in the order the workflow lists it.  Terms
# are matched as plain substrings, case-insensitively, with no word
# boundaries (so "ring" also hits "herring", "port" hits "newport").
# ---------------------------------------------------------------------------
SUPPLY_V2 = (
    "siege", "blockade", "cut off", "rail", "bridge", "encircled", "starved",
    "isolated", "pocket", "investment", "surrounded", "cauldron", "trapped",
    "strangled", "choked", "starvation", "supply", "logistics", "besieged",
    "invested", "cordoned", "ring", "kessel", "fortress", "pocketed", "bottled",
)
NAVAL_V2 = (
    "navy", "ship", "submarine", "blockade", "landing", "amphibious", "fleet",
    "convoy", "port", "harbor", "black sea", "mediterranean", "baltic",
    "atlantic", "pacific", "naval", "marine", "gunboat", "torpedo", "destroyer",
    "cruiser", "battleship", "carrier", "uboat", "u-boat", "dreadnought",
    "gallipoli", "tarawa", "normandy", "leyte", "midway", "trafalgar",
    "jutland", "river", "lake",
)
SUPPLY_THEORY = (
    "siege", "blockade", "fall of", "investment of", "relief of", "leningrad",
    "stalingrad", "port arthur", "singapore", "malta", "tob", "tobruk",
    "corregidor", "bastogne", "dien bien phu", "encircled", "cut off",
    "isolated", "pocket", "cauldron", "kessel", "starvation", "besieged",
    "invested", "surrounded", "fortress",
)
NAVAL_THEORY = (
    "naval", "battle of the", "leyte", "midway", "atlantic", "java sea",
    "coral sea", "guadalcanal", "solomons", "savo island", "matapan",
    "jutland", "trafalgar", "river plate", "denmark strait", "bismarck",
    "scharnhorst", "yamato", "musashi", "submarine", "u-boat", "uboat",
    "convoy", "merchant", "wolfpack", "gallipoli", "dardanelles", "tarawa",
    "peleliu", "okinawa", "amphibious", "landing", "beach", "normandy",
    "inchon",
)
SUPPLY_NARROW = (
    "siege", "blockade", "fall of", "investment", "relief of", "leningrad",
    "stalingrad", "port arthur", "singapore", "malta", "tobruk", "corregidor",
    "bastogne", "dien bien phu", "encircled", "cut off", "pocket", "cauldron",
    "kessel", "starvation", "besieged", "surrounded", "fortress",
)
NAVAL_NARROW = (
    "naval", "leyte", "midway", "java sea", "coral sea", "guadalcanal",
    "matapan", "jutland", "trafalgar", "river plate", "denmark strait",
    "bismarck", "yamato", "submarine", "u-boat", "convoy", "gallipoli",
    "dardanelles", "tarawa", "peleliu", "okinawa", "amphibious", "landing",
    "beach", "normandy", "inchon",
)
SUPPLY_FINAL = (
    "siege", "blockade", "leningrad", "stalingrad", "singapore", "malta",
    "tobruk", "bastogne", "dien bien phu", "pocket", "kessel", "surrounded",
    "cut off", "cauldron", "isolated", "encircled",
)
NAVAL_FINAL = (
    "naval", "midway", "leyte", "guadalcanal", "trafalgar", "normandy",
    "inchon", "okinawa", "tarawa", "amphibious", "landing", "beach",
    "dardanelles", "gallipoli", "java sea", "coral sea",
)
# Default texts used for a missing name.
UNKNOWN_BATTLE = "Unknown Battle"
UNKNOWN = "Unknown"
# ---------------------------------------------------------------------------

VOCABULARIES = {
    "v2": {"supply": SUPPLY_V2, "naval": NAVAL_V2},
    "theory": {"supply": SUPPLY_THEORY, "naval": NAVAL_THEORY},
    "narrow": {"supply": SUPPLY_NARROW, "naval": NAVAL_NARROW},
    "final": {"supply": SUPPLY_FINAL, "naval": NAVAL_FINAL},
}

_REGEX_SPECIAL = set("\\.^$|?*+()[]{}")


def escape_term(term: str) -> str:
    """Escape a literal term for both Java regex and RE2."""
    return "".join("\\" + ch if ch in _REGEX_SPECIAL else ch for ch in term)


def keyword_pattern(terms: Iterable[str] | str, word: bool = False) -> str:
    """Alternation of literal terms (or a caller pattern given as str).

    ``word=True`` wraps the alternation in ``\\b`` so that "ring" no longer
    matches inside "herring".
    """
    body = terms if isinstance(terms, str) else "|".join(escape_term(t) for t in terms)
    return rf"\b(?:{body})\b" if word else body


def case_folded(text: Column | str) -> Column:
    """Lower-cased text with the two lower-case letters whose upper case is
    an ASCII letter (long s, dotless i) folded too, so a literal ASCII term
    found in it is a case-insensitive match.  ``replace`` is a byte search,
    much cheaper than a per-character ``translate``."""
    c = F.col(text) if isinstance(text, str) else text
    low = F.lower(c)
    return F.replace(F.replace(low, F.lit("\u017f"), F.lit("s")), F.lit("\u0131"), F.lit("i"))


def _needed(terms: Iterable[str]) -> list[str]:
    """Lower-case terms without those that contain another one of the list: a
    text with the longer term has the shorter one too."""
    low = list(dict.fromkeys(t.lower() for t in terms))
    return [t for t in low if not any(o != t and o in t for o in low)]


def _contains_any(folded: Column, terms: Iterable[str]) -> Column:
    hit = None
    for t in _needed(terms):
        h = folded.contains(t)
        hit = h if hit is None else (hit | h)
    return F.lit(0) if hit is None else F.coalesce(hit.cast("int"), F.lit(0))


def keyword_flag(text: Column | str, terms: Iterable[str] | str, word: bool = False) -> Column:
    """1 when ``text`` contains any term (case-insensitive), 0 otherwise and
    for null text.

    Literal term lists are matched as substrings of the case-folded text
    (``contains`` chains stay in generated code and measured ~3x faster than
    one case-insensitive regex alternation on long documents).  A caller
    pattern given as str, or ``word=True``, uses a Unicode-aware
    case-insensitive regex.  For several flags on one text column use
    ``with_keyword_flags``, which folds the text once per row."""
    c = F.col(text) if isinstance(text, str) else text
    if isinstance(terms, str) or word:
        pattern = "(?iu)" + keyword_pattern(terms, word)
        return F.coalesce(c.rlike(pattern).cast("int"), F.lit(0))
    return _contains_any(case_folded(c), terms)


def with_keyword_flags(df, text: str, flags: dict, word: bool = False):
    """Add one 0/1 column per ``{name: terms_or_pattern}``.

    The folded text is its own projection, so it is computed once per row
    and shared by every term of every flag (inside one OR chain Spark would
    not reuse it: only the first operand of a short-circuit OR counts as
    always evaluated).  Terms that several flags have in common are looked
    for once a row, in a projection of their own."""
    literal = {n: t for n, t in flags.items() if not isinstance(t, str) and not word}
    folded, shared = f"__{text}_folded", f"__{text}_shared"
    out = df.withColumn(folded, case_folded(text)) if literal else df
    lists = {n: _needed(t) for n, t in literal.items()}
    groups: dict[tuple, list[str]] = {}
    for term in dict.fromkeys(t for terms in lists.values() for t in terms):
        groups.setdefault(tuple(n for n, terms in lists.items() if term in terms), []).append(term)
    # one column for the terms that the same flags have in common
    common = {names: f"{shared}{i}" for i, names in enumerate(g for g in groups if len(g) > 1)}
    if common:
        out = out.withColumns({c: _contains_any(F.col(folded), groups[names]) for names, c in common.items()})

    def flag(n):
        parts = [F.col(c) for names, c in common.items() if n in names]
        parts += [_contains_any(F.col(folded), groups[(n,)])] if (n,) in groups else []
        return F.greatest(*parts) if len(parts) > 1 else parts[0] if parts else F.lit(0)
    cols = {n: flag(n) if n in literal else keyword_flag(text, t, word) for n, t in flags.items()}
    out = out.withColumns(cols)
    return out.drop(folded, *common.values()) if literal else out


def text_or_default(col: Column | str, default: str = UNKNOWN) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(c.cast("string"), F.lit(default))


def first_token(col: Column | str, sep: str = ",") -> Column:
    """Trimmed text before the first separator (whole text if none)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.trim(F.split(c, escape_term(sep), 2).getItem(0))


def display_label(col: Column | str) -> Column:
    """``supply_cut`` -> ``Supply Cut``."""
    c = F.col(col) if isinstance(col, str) else col
    return F.initcap(F.regexp_replace(c, "_", " "))


def percent_text(col: Column | str, decimals: int = 1) -> Column:
    """Share as percent text, e.g. 0.4 -> ``40.0%``; rounded half-up first."""
    c = F.col(col) if isinstance(col, str) else col
    return F.format_string(f"%.{decimals}f%%", F.round(c * 100.0, decimals))
