"""Text cleaning as native Column expressions (no Python worker involved)."""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# The edition keywords a trailing "- Live ..." / ": Remastered 2011 ..." may start with.
EDITION_KEYWORDS = (
    r"single|remaster(?:ed)?(?: \d{2,4})?|remix|mix|live|radio edit"
    r"|explicit|clean|version|deluxe"
)

# Python counts U+001C..U+001F as white space and Java does not, so they are listed.
_SPACE = r"[\s\x1c-\x1f]"
# (?d): only \n ends a line, as in Python.  (?iuU): Unicode-aware case, digits and spaces.
_EDITION_TAIL = rf"(?diuU){_SPACE}*[-:–—]{_SPACE}*(?:{EDITION_KEYWORDS}).*$"
# Possessive: a space is never a bracket, so giving spaces back cannot help.
_BRACKETED = rf"(?d){_SPACE}*+[(\[].*?[)\]]"
_FEATURING = r"(?di)feat\.? .*"
_STRIP = rf"(?U)\A{_SPACE}+|{_SPACE}+\z"

_NON_ASCII = r"[^\x00-\x7F]"
_PAIR, _KV = "\x01", "\x02"


@lru_cache(maxsize=1)
def _fold_tables() -> tuple[str, str, dict[str, str]]:
    """ASCII remainder of every character's compatibility decomposition.

    The fold works per character because reordering inside a decomposition only moves
    combining marks, which are never ASCII.  Returns (from, to) strings for one-to-one folds and
    a dict for characters that expand to several ASCII characters (ligatures, fractions ...).
    """
    source, target, expanding = [], [], {}
    for code in range(0x80, sys.maxunicode + 1):
        char = chr(code)
        if not unicodedata.decomposition(char):
            continue
        ascii_part = unicodedata.normalize("NFKD", char).encode("ascii", "ignore").decode()
        if len(ascii_part) == 1:
            source.append(char)
            target.append(ascii_part)
        elif ascii_part:
            expanding[char] = ascii_part
    return "".join(source), "".join(target), expanding


@lru_cache(maxsize=1)
def _fold_literals() -> tuple[str, str, str, str]:
    source, target, expanding = _fold_tables()
    pairs = "".join(f"{_PAIR}{char}{_KV}{text}" for char, text in expanding.items()) + _PAIR
    return source, target, pairs, _covering_class(expanding)


def _covering_class(chars: dict[str, str]) -> str:
    """A few character ranges that hold all of `chars`, and some others.

    An exact class of hundreds of single characters is tested one by one for every character of
    a text; this one only has to tell the rows (and characters) that need a closer look.
    """
    codes = sorted(map(ord, chars))
    starts = [c for i, c in enumerate(codes) if i == 0 or c - codes[i - 1] > 64]
    ends = [c for i, c in enumerate(codes) if i == len(codes) - 1 or codes[i + 1] - c > 64]
    return "[" + "".join(f"{chr(a)}-{chr(b)}" for a, b in zip(starts, ends)) + "]"


def _literal(text: str) -> str:
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def _replaced(text: str, pattern: str) -> str:
    return f"regexp_replace({text}, {_literal(pattern)}, '')"


def _folded(text: str) -> str:
    source, target, pairs, expanding_class = (_literal(part) for part in _fold_literals())
    non_ascii = _literal(_NON_ASCII)
    # The table stays one string: a map literal of this size would travel with every task.
    key = f"concat({_literal(_PAIR)}, char_, {_literal(_KV)})"
    entry = f"split_part(substring_index({pairs}, {key}, -1), {_literal(_PAIR)}, 1)"
    expand = f"char_ -> CASE WHEN char_ RLIKE {expanding_class} AND instr({pairs}, {key}) > 0 THEN {entry} ELSE char_ END"
    opened = (
        f"CASE WHEN {text} RLIKE {expanding_class}"
        f" THEN array_join(transform(split({text}, ''), {expand}), '') ELSE {text} END"
    )
    folded = _replaced(f"translate({opened}, {source}, {target})", _NON_ASCII)
    return f"CASE WHEN {text} RLIKE {non_ascii} THEN {folded} ELSE {text} END"


def fold_ascii(column: str) -> Column:
    """Compatibility-decompose and drop what is not ASCII; pure-ASCII rows are passed through."""
    return F.expr(_folded(column))


def trim_edition_tail(column: str) -> Column:
    """Cut a trailing edition note: a dash or colon, an edition keyword, and all that follows."""
    return F.expr(_replaced(column, _EDITION_TAIL))


def clean_text(column: str, trim_tail: bool = False) -> Column:
    """The comparison form of a title, artist or album: lower-case ASCII letters, digits, spaces.

    In order: edition tail (optional), ASCII fold, bracketed parts, "feat." tails, & to and, all
    other characters, outer spaces, case.  One SQL text, which sets up faster than Column calls.
    """
    text = f"coalesce(CAST({column} AS STRING), '')"
    if trim_tail:
        text = _replaced(text, _EDITION_TAIL)
    # An ASCII text without brackets is its own fold and has no bracketed parts.
    closer_look = f"contains({text}, '(') OR contains({text}, '[') OR {text} RLIKE {_literal(_NON_ASCII)}"
    text = f"CASE WHEN {closer_look} THEN {_replaced(_folded(text), _BRACKETED)} ELSE {text} END"
    text = _replaced(text, _FEATURING)
    return F.expr(f"lower(trim({_replaced(f'replace({text}, {_literal("&")}, {_literal("and")})', '[^a-zA-Z0-9 ]')}))")


def token_set(cleaned: Column) -> Column:
    """Distinct words of a cleaned text."""
    # A single character splits without a regular expression; repeated spaces leave one empty word.
    return F.array_remove(F.array_distinct(F.split(cleaned, " ")), "")


def first_token(cleaned: Column) -> Column:
    return F.substring_index(cleaned, " ", 1)


def strip_spaces(text: Column) -> Column:
    """Remove leading and trailing white space, Unicode spaces included."""
    return F.regexp_replace(text, _STRIP, "")
