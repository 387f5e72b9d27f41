"""Signals of a candidate pair and their weighted score (expressions as SQL text)."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlink.functions.lcs import lcs_length
from ledgerlink.functions.similarity import blend, indel_ratio, other_words, token_overlap, token_set_ratio
from ledgerlink.operators.features import bag_overlap, overlap_bound, ratio_bound

SIGNALS = ("ratio_title", "ratio_artist", "ratio_album", "ngram_title", "ngram_artist", "ngram_album")

SLACK = 1e-9  # float error a bound may have against the exact score


@dataclass(frozen=True)
class Weights:
    """How much each signal counts, and the score a fuzzy match must reach."""

    min_score: float = 0.85
    title: float = 0.35
    artist: float = 0.45
    ngram: float = 0.20
    album: float = 0.20

    @property
    def each_ngram(self) -> float:
        return self.ngram / 2.0 if self.ngram > 0 else 0.0

    @property
    def bounded(self) -> bool:
        """Whether better signals can only raise the score, which pruning by bounds relies on."""
        return min(self.title, self.artist, self.album) >= 0

    def score(self) -> str:
        """Weighted sum of the signal columns; not normalised, up to 1.2 with albums by default.

        The terms are added in this order, because ties and the threshold depend on the last bit.
        Without albums the last term adds exactly 0.
        """
        return (
            f"{self.title!r}D * ratio_title + {self.artist!r}D * ratio_artist"
            f" + {self.each_ngram!r}D * ngram_title + {self.each_ngram!r}D * ngram_artist"
            f" + {self.album!r}D * ((ratio_album + ngram_album) / 2D)"
        )

    def artist_part(self, limit: Mapping[str, str]) -> str:
        return f"{self.artist!r}D * {limit['ratio_artist']} + {self.each_ngram!r}D * {limit['ngram_artist']}"

    def limit(self, bounds: Mapping[str, str], artist: bool = True) -> str:
        """Upper limit of the score; signals without a limit given are taken at their best."""
        limit = {signal: "1D" for signal in SIGNALS} | dict(bounds)
        total = (
            f"{self.title!r}D * {limit['ratio_title']} + {self.each_ngram!r}D * {limit['ngram_title']}"
            f" + {self.album / 2!r}D * ({limit['ratio_album']} + {limit['ngram_album']})"
        )
        return f"{total} + {self.artist_part(limit)}" if artist else total

    def reachable(self, bounds: Mapping[str, str], floor: str | None = None) -> Column:
        """Whether the threshold, or a higher `floor`, can be reached with these limits; never false for a match."""
        if not self.bounded:
            return F.lit(True)
        return F.expr(f"{self.limit(bounds)} >= {floor or f'{self.min_score!r}D'} - {SLACK!r}D")


def text_bounds(field: str, a: str, b: str) -> dict[str, str]:
    """Limits of a field's two signals from its feature columns; an absent album counts nothing."""
    ratio, overlap = ratio_bound(a, b), overlap_bound(a, b)
    if field == "album":
        ratio = f"IF({a}.words_size = 0 OR {b}.words_size = 0, 0D, {ratio})"
    return {f"ratio_{field}": ratio, f"ngram_{field}": overlap}


def flat(sql: str, sides: Iterable[str]) -> str:
    """The expression with the parts of feature structs as columns of their own, `a_mask` for `a.mask`."""
    for side in sides:
        sql = sql.replace(f"{side}.", f"{side}_")
    return sql


def _with_shared(pairs: DataFrame, fields: Mapping[str, tuple[str, str]], limits: bool, in_columns: bool = False) -> DataFrame:
    """The pairs with each field's shared words, the sizes that signals need and, with `limits`, `ratio_limit`.

    No common subsequence is longer than the characters n that the texts share as bags.  Shared words, z
    characters and gaps with a space each (g is 1 if there are any), are in both bags, so remainders of
    x and y characters have m = min(x, y, n - z - g) in common at most.  The token-set ratio is then the
    larger of 2(z + g + m) / (2z + 2g + x + y) and 2z / (2z + g + min(x, y)), or 1 if a remainder of
    shared words is empty.

    All this comes out of a generator with lambdas, which is on purpose.  It is computed once, as no
    filter or projection takes in the text of a generator.  And generated code ends there: the join's
    condition and these formulas together make a method beyond the size that the JVM compiles, which
    is some ten times slower than evaluating them step by step.
    """
    for name, (a, b) in fields.items():
        sized = "named_struct('both', w, 'n', size(w), 'z', length(array_join(w, ' ')), 'g', least(size(w), 1))"
        rest = "IF({x}.count = s.n, 0, {x}.words_size - s.z - s.g)"
        parts = f"'s', s, 'x', {rest.format(x=a)}, 'y', {rest.format(x=b)}"
        out = "'_{0}_both', t.s.both, '_{0}_shared', t.s.n, '_{0}_shared_size', t.s.z, '_{0}_left_rest_size', t.x, '_{0}_right_rest_size', t.y"
        out = out.format(name)
        if limits:
            parts += f", 'bag', {bag_overlap(a, b)}, 'size', {a}.size + {b}.size"
            whole = "2D * (t.s.z + t.s.g + least(t.x, t.y, t.bag - t.s.z - t.s.g)) / greatest(2 * (t.s.z + t.s.g) + t.x + t.y, 1)"
            either = "2D * t.s.z / greatest(2 * t.s.z + t.s.g + least(t.x, t.y), 1)"
            tokens = f"IF(t.s.g = 1 AND least(t.x, t.y) = 0, 1D, greatest({whole}, {either}))"
            limit = f"least((IF(t.size = 0, 1D, 2D * t.bag / t.size) + {tokens}) * 0.5D, 1D)"
            if name == "album":
                limit = f"IF({a}.count = 0 OR {b}.count = 0, 0D, {limit})"
            out += f", '_{name}_ratio_limit', {limit}"
        found = f"transform(array(array_intersect({a}.words, {b}.words)), w -> {sized})"
        found = f"transform(transform({found}, s -> named_struct({parts})), t -> named_struct({out}))"
        pairs = pairs.select("*", F.expr(f"inline({flat(found, (a, b)) if in_columns else found})"))
    return pairs


def _ratio(name: str, a: str, b: str, lcs: str, rest_lcs: str) -> str:
    named = {part: f"_{name}_{part}" for part in ("shared", "shared_size", "left_rest_size", "right_rest_size")}
    ratio = blend(indel_ratio(f"{a}.text", f"{b}.text", lcs), token_set_ratio(f"{a}.text", f"{b}.text", named, rest_lcs))
    return f"CASE WHEN {a}.text = '' OR {b}.text = '' THEN 0D ELSE {ratio} END" if name == "album" else ratio


def _overlap(name: str, a: str, b: str) -> str:
    return token_overlap(f"{a}.count", f"{b}.count", f"_{name}_shared")


def tight_bounds(fields: Mapping[str, tuple[str, str]]) -> dict[str, str]:
    """Limits of the signals of pairs whose shared words are known: overlaps are exact, ratios lack only order."""
    return {f"ratio_{name}": f"_{name}_ratio_limit" for name in fields} | {
        f"ngram_{name}": f"({_overlap(name, a, b)})" for name, (a, b) in fields.items()
    }


def with_tight_bounds(pairs: DataFrame, fields: Mapping[str, tuple[str, str]]) -> tuple[DataFrame, dict[str, str]]:
    """Pairs whose features are columns as of `flat`, with what `tight_bounds` need, and these bounds."""
    sides = [side for pair in fields.values() for side in pair]
    bounds = {signal: flat(limit, sides) for signal, limit in tight_bounds(fields).items()}
    return _with_shared(pairs, fields, limits=True, in_columns=True), bounds


def with_text_signals(
    pairs: DataFrame, fields: Mapping[str, tuple[str, str]], keep=None, spread: tuple[str, ...] = ()
) -> DataFrame:
    """Add `ratio_<field>` and `ngram_<field>` for pairs of feature columns.

    The kernel columns of all fields are computed in one projection, so a batch crosses to Python
    once; texts whose result is known without it are sent as NULL.  Albums count only where both
    are present.

    `keep(bounds)` says from upper limits which pairs can matter; others may be left out before the
    kernel.  The rest is then dealt out by the columns `spread`, if given, whatever task they are from.
    """
    kept = pairs.columns
    pairs = _with_shared(pairs, fields, limits=keep is not None)
    if keep is not None:
        pairs = pairs.filter(keep(tight_bounds(fields)))
    if spread:
        pairs = pairs.repartition(int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions")), *spread)
    kernel = []
    for name, (a, b) in fields.items():
        both = f"{a}.text != '' AND {b}.text != ''"
        left_rest, right_rest = f"_{name}_left_rest", f"_{name}_right_rest"
        text = F.expr(f"CASE WHEN {both} THEN {a}.text END")
        # Without other words on a side no remainder matters, and they need not be made.
        apart = f"{both} AND {left_rest}_size > 0 AND {right_rest}_size > 0"
        left, right = (F.expr(f"CASE WHEN {apart} THEN {other_words(f'{x}.words', f'_{name}_both')} END") for x in (a, b))
        kernel.append(lcs_length(text, F.col(f"{b}.text")).alias(f"_{name}_lcs"))
        kernel.append(lcs_length(left, right).alias(f"_{name}_rest_lcs"))
    pairs = pairs.select("*", *kernel)
    signals = []
    for name, (a, b) in fields.items():
        signals.append(F.expr(_ratio(name, a, b, f"_{name}_lcs", f"_{name}_rest_lcs")).alias(f"ratio_{name}"))
        signals.append(F.expr(_overlap(name, a, b)).alias(f"ngram_{name}"))
    return pairs.select(*kept, *signals)
