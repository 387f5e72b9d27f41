import hashlib
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from ledgerlink.llm import alignment
from ledgerlink.llm.words import ByteEncoder, Memory, PieceEncoder, byte_characters

from . import cases
from .test_tokens import odd_texts

BYTES, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
MORE = ["\u2581 a", "a  b   c ", " ", "   ", "\u2581", "x\u2581y z", "<0x41> <s> </s> <unk>", "tail ", "\n\n a\n", "\x00 a\x01", "e\u0301 \ufb01"]


@pytest.fixture(scope="module")
def models():
    library = Tokenizer.from_file(BYTES)
    library.encode_special_tokens = True
    return library, sentencepiece.SentencePieceProcessor(model_file=PIECES)


def sides(models, text):
    """(id, bytes) of the tokens of both sides, encoded as a whole."""
    library, pieces = models
    characters = byte_characters()
    ids = library.encode(f" {text}", add_special_tokens=False).ids
    a = [(i, bytes(characters[c] for c in library.id_to_token(i))) for i in ids]
    b = []
    for i in pieces.encode(text):
        piece = pieces.id_to_piece(i)
        b.append((i, bytes([int(piece[3:5], 16)]) if pieces.is_byte(i) else piece.replace("\u2581", " ").encode()))
    whole = f" {text}".encode()
    return (a, b) if text and all(b"".join(t for _, t in side) == whole for side in (a, b)) else ([], [])


def spans(side):
    at, found = 0, []
    for token_id, raw in side:
        found.append((token_id, at, at + len(raw)))
        at += len(raw)
    return found


def plain(models, text):
    """Tokens, all overlaps, groups and links, pair by pair."""
    a, b = map(spans, sides(models, text or ""))
    met = [(i, j) for i, x in enumerate(a) for j, y in enumerate(b) if x[1] < y[2] and y[1] < x[2]]
    ends = sorted({x[2] for x in a} & {y[2] for y in b})
    start, groups = 0, []
    for end in ends:
        groups.append("|".join(",".join(str(t[0]) for t in side if start < t[2] <= end) for side in (a, b)))
        start = end
    at_a, at_b = ({t[2]: t[0] for t in side} for side in (a, b))
    links = [(at_a[e], at_b[e]) for e in ends]
    return a, b, met, groups, links


def test_encoders(models):
    first, second = ByteEncoder(BYTES, special=False), PieceEncoder(PIECES)
    texts = [t for t in odd_texts() + MORE + cases.TEXTS if t]
    valid = 0
    for text, a, b in zip(texts, first.encode([f" {t}" for t in texts]), second.encode(texts), strict=True):
        expected_a, expected_b = sides(models, text)
        if expected_a:
            valid += 1
            assert a.tolist() == [i for i, _ in expected_a]
            assert b == [i for i, _ in expected_b]
        else:
            assert b is None
    assert 1000 < valid < len(texts)


def test_memory():
    made = []
    memory = Memory(lambda w: made.append(w) or w.upper(), keep=2, longest=3)
    assert [memory[w] for w in ("a", "b", "a", "c", "a", "long", "long")] == ["A", "B", "A", "C", "A", "LONG", "LONG"]
    assert made == ["a", "b", "c", "long", "long"] and len(memory) == 2


@pytest.mark.parametrize(("pair_rows", "clashing"), [(1 << 20, True), (3, False)])
def test_agreement(spark, models, pair_rows, clashing):
    extra = MORE + odd_texts()[:150] + ["the cat the dog", "the cat"]
    found = {}
    for text in {r[1] for r in cases.rows(extra)}:
        found[text] = quick(models, text) if len(text or "") > 20_000 else plain(models, text)
    counts = Counter(p for r in cases.rows(extra) for p in found[r[1]][4])
    best = Counter()
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    expected = []
    for key, text, *_ in cases.rows(extra):
        a, b, _, groups, links = found[text]
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""
        expected.append((key, len(a), len(b), len(groups), len(links), sum(counts[p] == best[p[1]] for p in links), sum(counts[p] for p in links), digest))
    frame = cases.documents(spark, extra, clashing=clashing)
    result = alignment.agreement(frame, BYTES, PIECES, pair_rows=pair_rows)
    assert result.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    cases.same(result, expected)


def quick(models, text):
    """As `plain`, without the quadratic list of overlaps, walking both sides once."""
    a, b = map(spans, sides(models, text))
    groups, links, i, j = [], [], 0, 0
    while i < len(a):
        first_a, first_b = i, j
        while a[i][2] != b[j][2]:
            i, j = (i + 1, j) if a[i][2] < b[j][2] else (i, j + 1)
        links.append((a[i][0], b[j][0]))
        i, j = i + 1, j + 1
        groups.append("|".join(",".join(str(t[0]) for t in side) for side in (a[first_a:i], b[first_b:j])))
    return a, b, None, groups, links


def test_overlaps(spark, models):
    texts = MORE + odd_texts()[150:250]
    frame = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    for row in alignment.align(frame, BYTES, PIECES, key="id", tokens=True).collect():
        a, b, met, groups, links = plain(models, texts[row.id])
        assert (row.a_ids, row.b_ids) == ([t[0] for t in a], [t[0] for t in b])
        assert list(zip(row.overlaps_a, row.overlaps_b, strict=True)) == met
        assert {(p >> 32, p & 0xFFFFFFFF): n for p, n in zip(row.pairs, row.times, strict=True)} == Counter(links)
        assert (row.n_groups, row.n_links) == (len(groups), len(links))


def test_empty_table(spark):
    assert alignment.agreement(cases.documents(spark).limit(0), BYTES, PIECES).count() == 0
