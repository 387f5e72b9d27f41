"""String similarity, given the common-subsequence lengths of the kernel.

The functions build SQL expression text (for `F.expr`) from column names.  These formulas are
long and sit in wide projections, and one parsed text is much cheaper to set up than hundreds of
Column calls.
"""

from __future__ import annotations


def indel_ratio(left: str, right: str, lcs: str) -> str:
    """1 - insertions and deletions / total length; two empty texts are equal.

    Times 100 and back, because the score is defined as a percentage and the last bit decides ties.
    """
    total = f"(length({left}) + length({right}))"
    edits = f"CAST({total} - 2 * {lcs} AS DOUBLE)"
    return f"CASE WHEN {total} = 0 THEN 1D ELSE (1D - {edits} / {total}) * 100D / 100D END"


def other_words(words: str, shared: str) -> str:
    """The words of a set that are not shared, as sorted text."""
    return f"array_join(array_sort(array_except({words}, {shared})), ' ')"


def token_set_ratio(left: str, right: str, parts: dict[str, str], rest_lcs: str) -> str:
    """Best of: the two remainders against each other, and the shared words against either side.

    `parts` has the number of shared words, their length as a text, and the lengths of both remainders.  Without shared words the second kind comes out as 0, so it needs no
    case of its own.  A larger `rest_lcs` never gives less.
    """

    def percent(edits: str, total: str) -> str:
        return f"(100D - 100D * CAST({edits} AS DOUBLE) / ({total}))"

    shared, size = parts["shared"], parts["shared_size"]
    left_rest, right_rest = parts["left_rest_size"], parts["right_rest_size"]
    gap = f"least({shared}, 1)"
    left_all, right_all = (f"({size} + {gap} + {rest})" for rest in (left_rest, right_rest))
    rests = percent(f"{left_rest} + {right_rest} - 2 * {rest_lcs}", f"{left_all} + {right_all}")
    best = (
        f"greatest({rests}, {percent(f'{gap} + {left_rest}', f'{size} + {left_all}')},"
        f" {percent(f'{gap} + {right_rest}', f'{size} + {right_all}')})"
    )
    return (
        f"CASE WHEN {left} = '' OR {right} = '' THEN 0D"
        f" WHEN {shared} > 0 AND ({left_rest} = 0 OR {right_rest} = 0) THEN 100D ELSE {best} END / 100D"
    )


def token_overlap(left_count: str, right_count: str, shared: str) -> str:
    """Shared words over the larger word count, 0 if either side has none."""
    return (
        f"CASE WHEN {left_count} = 0 OR {right_count} = 0 THEN 0D"
        f" ELSE CAST({shared} AS DOUBLE) / greatest({left_count}, {right_count}) END"
    )


def blend(indel: str, token_set: str) -> str:
    return f"(({indel}) + ({token_set})) * 0.5D"
