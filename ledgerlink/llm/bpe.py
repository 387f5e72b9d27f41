"""Byte-level BPE by a queue of merge ranks over a linked list of symbols, and its inverse.

A word's symbols form a doubly linked list.  A heap holds the rank and place of every adjacent pair
that some merge rule joins; the lowest rank, then the leftmost place, is joined first, and entries
whose symbols have changed since are skipped.  A word of n bytes takes O(n log n) steps, so one very
long word is no trouble.  Distinct words of up to 48 characters are remembered, up to a bound.  Decoding
concatenates the vocabulary's strings.

Every row gives one row.  A null text counts as empty: 0 tokens.  Equal rows give equal results.
"""

from __future__ import annotations

import functools
import hashlib
import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ledgerlink.llm.common import arrow_map, at_task_end, slices, texts
from ledgerlink.llm.words import Memory, SpecialTokens, byte_characters


class Codec:
    def __init__(self, path: str) -> None:
        self._special = SpecialTokens(path)
        model = self._special.spec["model"]
        vocabulary = model["vocab"]
        characters = byte_characters()
        self.strings: list[bytes] = [b""] * (1 + max([*vocabulary.values(), *self._special.ids.values()]))
        for token, token_id in vocabulary.items():
            self.strings[token_id] = bytes(characters[c] for c in token)
        for token, token_id in self._special.ids.items():
            self.strings[token_id] = token.encode()
        self._first = [vocabulary[c] for c, _ in sorted(characters.items(), key=lambda x: x[1])]
        self._merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, merge in enumerate(model["merges"]):
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            self._merges[vocabulary[left], vocabulary[right]] = (rank, vocabulary[left + right])
        self._words = Memory(self._encode_word)
        at_task_end(self._words.forget)

    def _encode_word(self, word: str) -> bytes:
        if word in self._special.ids:
            return np.array([self._special.ids[word]], "<u4").tobytes()
        symbols = [self._first[b] for b in word.encode()]
        size, merges = len(symbols), self._merges
        before, after = list(range(-1, size - 1)), list(range(1, size + 1))
        queue = []
        for k in range(size - 1):
            if rule := merges.get((symbols[k], symbols[k + 1])):
                queue.append((rule[0], k, symbols[k], symbols[k + 1]))
        heapq.heapify(queue)
        while queue:
            _, left, a, b = heapq.heappop(queue)
            right = after[left]
            if symbols[left] != a or right >= size or symbols[right] != b:
                continue  # stale: one of the two has been joined to something else
            symbols[left] = merges[a, b][1]
            symbols[right] = -1
            after[left] = following = after[right]
            if following < size:
                before[following] = left
            for k, other in ((before[left], left), (left, following)):
                if k >= 0 and other < size and (rule := merges.get((symbols[k], symbols[other]))):
                    heapq.heappush(queue, (rule[0], k, symbols[k], symbols[other]))
        return np.array([s for s in symbols if s >= 0], "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        return b"".join(map(self._words.__getitem__, self._special.pieces(text)))

    def decode(self, ids: bytes) -> str:
        whole = b"".join(map(self.strings.__getitem__, np.frombuffer(ids, "<u4").tolist()))
        return whole.decode("utf-8", "replace")


@functools.lru_cache(maxsize=4)
def codec(path: str) -> Codec:
    """One codec for each Python worker, kept between tasks."""
    return Codec(path)


def encode(documents: DataFrame, path: str, key: str = "doc_id", text: str = "text", token_ids: bool = True) -> DataFrame:
    """key, n_tokens, ids_sha256, decoded_sha256 of each row and, with `token_ids`, the ids themselves (binary)."""
    kind = documents.schema[key].dataType
    rows = documents.select(documents[key].alias("key"), documents[text].cast("string").alias("text"))
    schema = f"{key} {kind.simpleString()}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    schema += ", ids binary" if token_ids else ""

    def run(batches):
        own = codec(path)
        for batch in slices(batches, "text"):
            ids = [own.encode(t) for t in texts(batch)]
            fields = [
                batch.column("key"),
                pa.array([len(x) // 4 for x in ids], pa.int64()),
                pa.array([hashlib.sha256(x).hexdigest() for x in ids]),
                pa.array([hashlib.sha256(own.decode(x).encode()).hexdigest() for x in ids]),
            ]
            names = [key, "n_tokens", "ids_sha256", "decoded_sha256"]
            if token_ids:
                fields, names = [*fields, pa.array(ids, pa.binary())], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(fields, names)

    return arrow_map(rows, run, schema)


def decode(encoded: DataFrame, path: str, key: str = "doc_id") -> DataFrame:
    """key, text of rows with ids as `encode` returns them; null ids give the empty text."""
    kind = encoded.schema[key].dataType

    def run(batches):
        own = codec(path)
        for batch in slices(batches, "ids"):
            text = [own.decode(x or b"") for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(text, pa.string())], [key, "text"])

    rows = encoded.select(encoded[key].alias("key"), "ids")
    return arrow_map(rows, run, f"{key} {kind.simpleString()}, text string")
