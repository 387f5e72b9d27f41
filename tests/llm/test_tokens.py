import hashlib
import json
import random
import zlib
from functools import partial

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ledgerlink.llm import bpe, token_counts, wavelet
from ledgerlink.llm.words import ByteEncoder

from . import cases

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids(library, text):
    return np.array(library.encode(text or "", add_special_tokens=False).ids, "<u4").tobytes()


def odd_texts():
    chance = random.Random(3)
    parts = ["a", " ", "  ", "\n", "\t", "'s", "'LL", "é", "x" * 70, "<|endoftext|>", "<|end", "1", "½", "\x85", "\x1c", "日本",
             "!", "?'", "œ", "🙂", "the", "\xa0", "\u3000", "ª", "²", "\ud7ff", "\U0001f468\u200d\U0001f469"]
    return ["".join(chance.choices(parts, k=chance.randint(0, 25))) for _ in range(1500)]


def test_codec_and_byte_encoder_equal_the_library(library):
    codec, encoder = bpe.Codec(PATH), ByteEncoder(PATH)
    texts = odd_texts()
    for start in range(0, len(texts), 50):
        for text, encoded in zip(texts[start : start + 50], encoder.encode(texts[start : start + 50]), strict=True):
            expected = ids(library, text)
            assert codec.encode(text) == expected == encoded.tobytes()
            assert codec.decode(expected) == library.decode(np.frombuffer(expected, "<u4").tolist(), skip_special_tokens=False)


def test_split_of_every_character(library):
    codec, encoder = bpe.Codec(PATH), ByteEncoder(PATH)
    for start in [*range(0, 0xD800, 64), *range(0xE000, 0x20000, 64)]:
        text = " ".join(f"a{chr(c)} {chr(c)}{chr(c)}1" for c in range(start, start + 64))
        assert codec.encode(text) == ids(library, text) == encoder.encode([text])[0].tobytes(), hex(start)


def test_long_texts_and_other_files(library, tmp_path):
    encoder = ByteEncoder(PATH)
    for size in (encoder.LONG - 1, encoder.LONG + 1):
        for text in ("ab cé", " ", "^", "\n", "1", "x"):
            text = (text * size)[: size - 1] + "y"
            assert encoder.encode([text])[0].tobytes() == ids(library, text)
    for text in (cases.LONG, cases.LONG * 3):
        assert encoder.encode([text])[0].tobytes() == ids(library, text)
    spec = json.loads(library.to_str())
    spec["model"]["vocab"] = {t: k for t, k in spec["model"]["vocab"].items() if len(t) < 3}
    spec["model"]["merges"] = [m for m in spec["model"]["merges"] if len("".join(m)) < 3]
    spec["model"]["vocab"]["xyz"] = 50_000  # nothing makes it
    (tmp_path / "odd.json").write_text(json.dumps(spec))
    with pytest.raises(ValueError):
        ByteEncoder(str(tmp_path / "odd.json"))


@pytest.mark.parametrize("clashing", [False, True])
def test_encode(spark, library, clashing):
    expected = []
    for key, text, *_ in cases.rows():
        raw = ids(library, text)
        expected.append((key, len(raw) // 4, hashlib.sha256(raw).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    cases.same(bpe.encode(cases.documents(spark, clashing=clashing), PATH, token_ids=False), expected)
    back = bpe.decode(bpe.encode(cases.documents(spark), PATH), PATH)
    cases.same(back, [(r[0], r[1] or "") for r in cases.rows()])


def spans(library, text):
    """Character spans with shared characters given to the first token."""
    reached, found = 0, []
    for start, end in library.encode(text, add_special_tokens=False).offsets:
        found.append((max(start, reached), max(end, reached)))
        reached = max(reached, end)
    return found


def plain_sections(library, text):
    bounds = token_counts.line_bounds(text).tolist()
    counts, crossing = [0] * (len(bounds) - 1), 0
    for start, end in spans(library, text):
        inside = [max(0, min(end, e) - max(start, s)) for s, e in zip(bounds, bounds[1:], strict=False)]
        if start == end:
            home = max(k for k, s in enumerate(bounds[:-1]) if s <= max(end - 1, 0))
        else:
            home = inside.index(max(inside))
        counts[home] += 1
        crossing += sum(x > 0 for x in inside) > 1
    return sum(counts), len(counts), crossing, counts


def test_section_tokens(spark, library):
    extra = [t for t in odd_texts()[:300]] + ["\n\n\na\n \n  b", "a\n\n\n\n\n\n\n\nb\n"]
    expected = [(k, *plain_sections(library, t or "")) for k, t, *_ in cases.rows(extra)]
    assert any(e[3] for e in expected)
    cases.same(token_counts.section_tokens(cases.documents(spark, extra, clashing=True), PATH), expected)


def test_wavelet_queries():
    chance = np.random.default_rng(2)
    for size, symbols in ((0, 1), (1, 1), (7, 1), (500, 3), (1000, 256), (777, 40_000), (64, 5_000_000)):
        values = chance.integers(0, symbols, size).astype("<u4")
        matrix, keys, lengths = wavelet.load(wavelet.dump(wavelet.WaveletMatrix.build(values), [3, None], [size, 0]) + b"\n")
        assert keys == [3, None] and lengths.tolist() == [size, 0]
        assert matrix.all().tolist() == values.tolist()
        for at in range(0, size, 17):
            symbol = int(values[at])
            assert matrix.access(at) == symbol
            assert matrix.count(symbol, 5, max(5, at)) == int((values[5:at] == symbol).sum())
            assert matrix.occurrences(symbol) == np.flatnonzero(values == symbol).tolist()
        assert matrix.count(symbols + 1) == 0
        with pytest.raises(IndexError):
            matrix.select(symbols + 1, 0)


def test_wavelet_blocks():
    chance = np.random.default_rng(7)
    values = chance.integers(0, 5, 3 * 8 * wavelet._BLOCK + 77).astype("<u4")
    matrix, *_ = wavelet.load(wavelet.dump(wavelet.WaveletMatrix.build(values), [1], [len(values)]))
    assert (matrix.all() == values).all()
    edges = [0, 1, 7, 8, *(8 * wavelet._BLOCK * k + d for k in (1, 2, 3) for d in (-1, 0, 1)), len(values) - 1, len(values)]
    for symbol in range(6):
        own = np.flatnonzero(values == symbol)
        assert [matrix.count(symbol, 0, e) for e in edges] == [int((own < e).sum()) for e in edges]
        ranks = [0, 1, len(own) // 2, len(own) - 1] if len(own) else []
        assert [matrix.select(symbol, k) for k in ranks] == [int(own[k]) for k in ranks]
    assert [matrix.access(e) for e in edges[:-1]] == [int(values[e]) for e in edges[:-1]]


def test_counts_and_occurrences_over_files(spark, library, tmp_path):
    wavelet.write(cases.documents(spark), str(tmp_path / "shards"), PATH, shard_tokens=5000)
    places = {}
    for key, text, *_ in cases.rows():
        for place, token in enumerate([*library.encode(text or "", add_special_tokens=False).ids, 0]):
            places.setdefault(token, []).append((key, place))
    chosen = sorted(places, key=lambda t: (len(places[t]), t))
    chosen = [*chosen[:5], *chosen[-5:], 49_999_999, 0]
    wanted = {t: len(places.get(t, [])) for t in chosen}
    found = wavelet.token_frequencies(spark, str(tmp_path / "shards"), [*chosen, chosen[0]])
    assert {r.token_id: r.n for r in found.collect()} == wanted and found.count() == len(wanted)
    got = wavelet.token_occurrences(spark, str(tmp_path / "shards"), chosen)
    cases.same(got, [(t, *p) for t in set(chosen) for p in places.get(t, [])])


def test_damaged_shard():
    data = bytearray(wavelet.dump(wavelet.WaveletMatrix.build(np.arange(9, dtype="<u4")), [1], [9]))
    data[-1] ^= 1
    with pytest.raises(ValueError):
        wavelet.load(bytes(data))


@pytest.mark.parametrize("shard_tokens", [40, 1 << 20])
def test_wavelet_round_trip(spark, library, shard_tokens):
    start, expected = 0, []
    order = sorted(cases.rows(), key=lambda r: (r[0] is not None, r[0] or 0))
    frame = cases.documents(spark, clashing=True)
    result = wavelet.round_trip(frame, PATH, shard_tokens=shard_tokens)
    for key, text, *_ in order:
        raw = ids(library, text) + bytes(4)
        expected.append((key, start, len(raw) // 4, zlib.crc32(raw)))
        start += len(raw) // 4
    got = sorted(map(tuple, result.collect()), key=lambda r: r[1])
    # The two rows without id are in order of a hash of their texts.
    assert [g[0] for g in got] == [e[0] for e in expected]
    assert sorted(g[2:] for g in got) == sorted(e[2:] for e in expected)
    assert got[2:] == expected[2:]
    assert [g[1] for g in got] == np.cumsum([0, *(g[2] for g in got[:-1])]).tolist()


def test_empty_tables(spark):
    none = cases.documents(spark).limit(0)
    for make in (bpe.encode, token_counts.section_tokens, partial(wavelet.round_trip)):
        assert make(none, PATH).count() == 0
