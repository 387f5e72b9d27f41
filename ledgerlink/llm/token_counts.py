"""Token counts of sections, from one encoding of the whole text.

The whole text is encoded once.  Each token has a span of characters; a character that several byte
tokens share counts as the first one's.  Spans are joined to the sections by interval, with sorted
bounds.  A token that crosses a bound goes whole to the section that holds most of its characters,
in a tie to the earlier one; a token without characters of its own goes with the one before it.  So
the counts of a text's sections add up to its tokens.

Every row gives one row.  A null or empty text has no section and no token.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ledgerlink.llm.common import arrow_map, slices, texts
from ledgerlink.llm.words import byte_encoder


def line_bounds(text: str) -> np.ndarray:
    """Starts of the lines of a text and its end; a line break belongs to the line that it ends."""
    starts, at = [0], text.find("\n") + 1
    while 0 < at < len(text):
        starts.append(at)
        at = text.find("\n", at) + 1
    return np.array([*starts, len(text)] if text else [0], np.int64)


def attribute(widths: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, int]:
    """Tokens of each section between successive bounds, and how many tokens cross a bound."""
    ends = np.cumsum(widths.astype(np.int64))
    starts = ends - widths
    last = np.searchsorted(bounds, np.maximum(ends - 1, 0), "right") - 1
    first = np.where(widths > 0, np.searchsorted(bounds, starts, "right") - 1, last)
    home = first.copy()
    crossing = np.flatnonzero(first != last)
    for k in crossing:
        sections = np.arange(first[k], last[k] + 1)
        inside = np.minimum(ends[k], bounds[sections + 1]) - np.maximum(starts[k], bounds[sections])
        home[k] = sections[np.argmax(inside)]
    return np.bincount(home, minlength=max(len(bounds) - 1, 0)), len(crossing)


def section_tokens(
    documents: DataFrame, path: str, bounds=line_bounds, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """key, n_tokens, n_sections, n_crossing, section_tokens (an array, in order) of each row.

    `bounds(text)` gives the rising starts of the sections, the first 0, and at last the text's length.
    """
    kind = documents.schema[key].dataType
    rows = documents.select(documents[key].alias("key"), documents[text].cast("string").alias("text"))
    names = ["n_tokens", "n_sections", "n_crossing", "section_tokens"]

    def run(batches):
        encoder = byte_encoder(path)
        for batch in slices(batches, "text"):
            whole = texts(batch)
            made = []
            for value, tokens in zip(whole, encoder.widths(whole), strict=True):
                counts, crossing = attribute(tokens, bounds(value))
                made.append((len(tokens), len(counts), crossing, counts))
            columns = [pa.array([m[k] for m in made], pa.int64()) for k in range(3)]
            columns.append(pa.array([m[3] for m in made], pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays([batch.column("key"), *columns], [key, *names])

    counted = "n_tokens bigint, n_sections bigint, n_crossing bigint, section_tokens array<bigint>"
    return arrow_map(rows, run, f"{key} {kind.simpleString()}, {counted}")
