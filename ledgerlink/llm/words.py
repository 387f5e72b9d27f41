"""Splitting text before byte-level merges, and encoding by distinct words with the libraries' models."""

from __future__ import annotations

import functools
import json
import re
import struct

import numpy as np
import regex

# The split pattern of the byte-level vocabulary.  White space is Unicode's property,
# which Python's own \s exceeds by four control characters.
_SPACE = "\t-\r \x85\xa0  -     　"
_PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?[{letter}]+| ?[{number}]+| ?[^{space}{letter}{number}]+"
    r"|[{space}]+(?![^{space}])|[{space}]+"
)
#: The same in the engine's own classes.
_SPLIT = _PATTERN.format(letter=r"\p{L}", number=r"\p{N}", space=r"\s")
_ANY = regex.compile(_PATTERN.format(letter=r"\p{L}", number=r"\p{N}", space=_SPACE))
#: The same classes within Latin-1, where the plain engine is three times as fast.
_LATIN = re.compile(
    _PATTERN.format(letter="A-Za-zªµºÀ-ÖØ-öø-ÿ", number="0-9²³¹¼-¾", space="\t-\r \x85\xa0")
)


def split(text: str) -> list[str]:
    """The pieces within which merges happen; joined they are the text."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return _ANY.findall(text)
    return _LATIN.findall(text)


class SpecialTokens:
    """Added tokens of a tokenizer file: their strings in a text stand for one id."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            self.spec = json.load(file)
        self.ids = {t["content"]: t["id"] for t in self.spec["added_tokens"]}
        longest_first = sorted(self.ids, key=len, reverse=True)
        self._pattern = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if self.ids else None

    def pieces(self, text: str) -> list[str]:
        """Split words of the text, special strings whole."""
        if self._pattern is None or not any(s in text for s in self.ids):
            return split(text)
        return [p for k, part in enumerate(self.parts(text)) for p in ([part] if k % 2 else split(part))]

    def parts(self, text: str) -> list[str]:
        """What lies between special strings, and these, by turns."""
        return self._pattern.split(text)


class Memory(dict):
    """Values of words, made on first use; words of the last `keep` to twice `keep` made or asked for stay.

    The memory has two generations.  When the younger is full, it becomes the older, whose words move
    back when they are asked for; so words in use are never made anew all at once.  Words of more than
    `longest` characters are not kept.
    """

    def __init__(self, make, keep: int = 100_000, longest: int = 48) -> None:
        super().__init__()
        self._make, self._keep, self._longest, self._older = make, keep, longest, {}

    def __missing__(self, word: str):
        made = self._older.get(word)
        if made is None:
            made = self._make(word)
        if len(word) <= self._longest:
            if len(self) >= self._keep:
                self._older = dict(self)
                self.clear()
            self[word] = made
        return made

    def forget(self) -> None:
        self.clear()
        self._older = {}


def byte_characters() -> dict[str, int]:
    """The printable stand-in that byte-level vocabularies write for each byte."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


def _merge_ranks(model: dict) -> tuple[dict[bytes, int], np.ndarray]:
    """Each token's bytes with the place of the merge that makes it, and the ids by these places."""
    characters, vocabulary = byte_characters(), model["vocab"]
    tokens = [c for c, _ in sorted(characters.items(), key=lambda x: x[1])]
    tokens += ["".join(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
    ranks = {bytes(characters[c] for c in token): k for k, token in enumerate(tokens)}
    if len(ranks) < len(tokens):
        raise ValueError("two merges make the same token")
    return ranks, np.array([vocabulary[t] for t in tokens], "<u4")


class ByteEncoder:
    """Whole texts to the ids that the tokenizers library gives for a byte-level BPE file.

    The merges run in tiktoken's engine, which takes a fifth of the library's time.  It joins the bytes
    of a token whatever its two parts are, the library only those of the token's own merge.  These agree
    on all texts if the library makes every token from its bytes: then no other two parts ever stand
    side by side when the token's turn comes.  That is checked when a file is opened.  With `special`
    off, the strings of special tokens are plain text.
    """

    #: Longer texts are split here and merged by the library, as the engine's splitting has a limit.
    LONG = 1 << 18

    def __init__(self, path: str, special: bool = True) -> None:
        from tiktoken import Encoding
        from tokenizers import Tokenizer

        self._special = SpecialTokens(path)
        self._marked = list(self._special.ids) if special else []
        self._library, vocabulary = Tokenizer.from_file(path).model, self._special.spec["model"]["vocab"]
        self._stand_in = {b: c for c, b in byte_characters().items()}
        if any(len(self._library.tokenize(t)) != 1 for t in vocabulary if t not in self._special.ids):
            raise ValueError("a token of this file is not what its bytes merge to")
        ranks, self._ids = _merge_ranks(self._special.spec["model"])
        self._engine = Encoding("merges", pat_str=_SPLIT, mergeable_ranks=ranks, special_tokens={})
        #: Bytes of each id.
        self.lengths = np.zeros(1 + max([*vocabulary.values(), *self._special.ids.values()]), np.int64)
        self.lengths[self._ids] = [len(token) for token in ranks]
        for token, token_id in self._special.ids.items():
            self.lengths[token_id] = len(token.encode())

    def _plain(self, text: str) -> np.ndarray:
        if len(text) <= self.LONG:
            return self._ids[np.array(self._engine.encode_ordinary(text), np.int64)]
        return np.array([t.id for piece in split(text) for t in self._library.tokenize(self._written(piece))], "<u4")

    def _written(self, piece: str) -> str:
        return piece.encode().decode("latin-1").translate(self._stand_in)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text, as uint32."""
        return [self._marked_out(t) if any(s in t for s in self._marked) else self._plain(t) for t in texts]

    def _marked_out(self, text: str) -> np.ndarray:
        parts = self._special.parts(text)
        return np.concatenate([np.array([self._special.ids[p]], "<u4") if k % 2 else self._plain(p) for k, p in enumerate(parts)])

    def widths(self, texts: list[str]) -> list[np.ndarray]:
        """For each text the number of characters that begin in each token."""
        return [self._widths(t, self.lengths[ids]) for t, ids in zip(texts, self.encode(texts), strict=True)]

    def _widths(self, text: str, lengths: np.ndarray) -> np.ndarray:
        if text.isascii():
            return lengths
        begins = (np.frombuffer(text.encode(), np.uint8) & 0xC0) != 0x80
        return np.diff(np.concatenate(([0], np.cumsum(begins)))[np.cumsum(lengths)], prepend=0)


@functools.lru_cache(maxsize=4)
def byte_encoder(path: str, special: bool = True) -> ByteEncoder:
    """One encoder for each Python worker, kept between tasks."""
    return ByteEncoder(path, special)


class PieceEncoder:
    """Whole texts to the ids of a sentencepiece model, and the bytes that these stand for."""

    def __init__(self, path: str) -> None:
        from sentencepiece import SentencePieceProcessor

        self._model = model = SentencePieceProcessor(model_file=path)
        pieces = [model.id_to_piece(k) for k in range(model.get_piece_size())]
        self.strings = [
            bytes([int(p[3:5], 16)]) if model.is_byte(k) else p.replace("\u2581", " ").encode() for k, p in enumerate(pieces)
        ]
        self.lengths = np.array([len(s) for s in self.strings], np.int64)

    def encode(self, texts: list[str]) -> list[list[int] | None]:
        """The ids of each text, or None where they do not stand for a space and the text."""
        string = self.strings.__getitem__
        encoded = self._model.encode(texts, num_threads=1)
        return [
            ids if b"".join(map(string, ids)) == b" " + text.encode() else None
            for text, ids in zip(texts, encoded, strict=True)
        ]


@functools.lru_cache(maxsize=2)
def piece_encoder(path: str) -> PieceEncoder:
    """One encoder for each Python worker, kept between tasks."""
    return PieceEncoder(path)
