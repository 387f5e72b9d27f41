"""Per-text features, and the signal bounds they give for a pair without comparing the texts.

The longest common subsequence of two texts cannot be longer than the characters they share as
bags.  Bags are kept as bits: character c with n occurrences sets the first min(n, width) of its
`width` bits, so the shared part of two bags is the bit count of an AND.  Occurrences beyond the
width are only counted in total (`over`), which keeps the result an upper limit.  Likewise words:
each sets one bit of `mask`, and a word shared by two texts has its bit in both.

Expressions are SQL text, as in `functions.similarity`.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Bits per character of a cleaned text; frequent characters get more. Two 63-bit words in all.
_WIDTHS = {" ": 6} | dict.fromkeys("aeo", 5) | dict.fromkeys("inrtsl", 4) | dict.fromkeys("cdumhgpby", 3)
_WIDTHS |= dict.fromkeys("fwkvjxzq0123456789", 2)
_WORD_BITS = 63


def _layout() -> list[tuple[str, int, int, int]]:
    """(character, width, word, first bit) of every character."""
    layout, word, bit = [], 0, 0
    for char, width in _WIDTHS.items():
        if bit + width > _WORD_BITS:
            word, bit = word + 1, 0
        layout.append((char, width, word, bit))
        bit += width
    return layout


def _slots(word: int | None = None) -> str:
    rows = [
        f"named_struct('c', '{char}', 'width', {width}, 'bit', {bit})"
        for char, width, at, bit in _layout()
        if word in (None, at)
    ]
    return f"array({', '.join(rows)})"


def _bag_word(text: str, word: int) -> str:
    filled = f"least(length({text}) - length(replace({text}, slot_.c, '')), slot_.width)"
    return f"aggregate({_slots(word)}, 0L, (bits_, slot_) -> bits_ | shiftleft(shiftleft(1L, {filled}) - 1L, slot_.bit))"


def _bag_overflow(text: str) -> str:
    beyond = f"greatest(length({text}) - length(replace({text}, slot_.c, '')) - slot_.width, 0)"
    return f"aggregate({_slots()}, 0, (over_, slot_) -> over_ + {beyond})"


def _words(text: str) -> str:
    return f"CASE WHEN {text} = '' THEN CAST(array() AS ARRAY<STRING>) ELSE array_distinct(split({text}, ' +')) END"


def features(text: str, bound: bool = True) -> Column:
    """Struct of a cleaned text, its size, its words, their number and size and, with `bound`, what the pair bounds need."""
    words = _words(text)
    fields = {"text": text, "size": f"length({text})", "words": words}
    fields |= {"count": f"size({words})", "words_size": f"length(array_join({words}, ' '))"}
    if bound:
        mask = f"aggregate({words}, 0L, (mask_, word_) -> mask_ | shiftleft(1L, pmod(hash(word_), 64)))"
        fields |= {
            "mask": mask,
            "spare": f"size({words}) - bit_count({mask})",
            "per_word": f"1D / greatest(size({words}), 1)",
            "bag0": _bag_word(text, 0),
            "bag1": _bag_word(text, 1),
            "over": _bag_overflow(text),
        }
    return F.expr(f"named_struct({', '.join(f'{name!r}, {sql}' for name, sql in fields.items())})")


# The bounds are kept short on purpose: they run for every tested pair, inside the generated code
# of the join, and the JVM leaves a method beyond 8,000 bytes of code uncompiled.


def bag_overlap(a: str, b: str) -> str:
    """Upper limit of the characters that two texts share as bags."""
    return f"(bit_count({a}.bag0 & {b}.bag0) + bit_count({a}.bag1 & {b}.bag1) + least({a}.over, {b}.over))"


def ratio_bound(a: str, b: str) -> str:
    """Upper limit of the blended ratio.

    With n shared characters at most, and w the summed word sizes (never more than the summed text
    sizes), the plain ratio is at most 2n / w, and so is the token-set ratio if no word is shared;
    if one is, it is at most 1.  Two empty texts have ratio 0.5.
    """
    n = bag_overlap(a, b)
    apart = f"({a}.mask & {b}.mask) = 0"
    size = f"greatest({a}.words_size + {b}.words_size, 1)"
    empty = f"{a}.words_size + {b}.words_size = 0"
    return f"({n} * IF({apart}, 2D, 1D) / {size} + IF({apart}, IF({empty}, 0.5D, 0D), 0.5D))"


def overlap_bound(a: str, b: str) -> str:
    """Upper limit of the word overlap.

    A shared word has its bit in both masks; words of `a` that share a bit with another word of
    `a` are counted on top (`spare`).
    """
    return f"least(1D, (bit_count({a}.mask & {b}.mask) + IF(({a}.mask & {b}.mask) = 0, 0, {a}.spare)) * {a}.per_word)"
