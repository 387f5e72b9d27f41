"""Near duplicates by word shingles: an exact Jaccard join with PartEnum signatures.

A document's set holds the hashes of its distinct shingles; sets are told apart by a hash of their own
and equal sets are one node.  Sizes are cut into bands.  Two sets in reach of one band with Jaccard of
`SHARE` percent differ in at most k elements.  For the band, the domain is partitioned by hash into
groups, more than k/2 + `spare` of them, and each group into cells.  More than `spare` groups hold one
difference at most, so leaving out each of a group's cells in turn gives a projection that both sets
share: that is a signature.  Projections without elements say nothing and are not used: if either set
has no more than `spare` groups with such a one, a shared signature is left.  A set that has more of
them also gets the signatures of another partition, and after `PARTITIONS` of them one that only says
so; thus no pair is lost.

Signatures are dealt out in packed blocks.  Tasks unite equal ones before that, so a common signature
has one entry a block of documents.  Partitions grow in number with the input's bytes, and a task holds
the signatures of a quarter of one at a time.  Sets that share a signature are compared: all pairs where few share
it, else each with a chosen one; where such a group still falls into several components afterwards, all
pairs between its components, in cells of bounded size.  A sketch of counts by hash gives a lower limit
of the difference and rules out most pairs; the rest are compared by the shingles of whole texts.

Words: A-Z lower-cased, split at white space.  A document of fewer words than a shingle has one shingle
of all; a null or empty one has none, and is linked with nothing.  Every row gives one row.  A row
without id joins others only by a set equal to that of a row with one, and never names a component.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlink.llm.common import arrow_map, at_task_end, fresh, partitions_for, slices, stored
from ledgerlink.llm.components import components

SHINGLE, SHARE = 5, 80
PARTITIONS = 10
#: So many sets with one signature are compared in all pairs; more, at first with a chosen one.
SMALL_GROUP = 8
#: Places of the filter of documents whose texts are compared, a bit each.
FILTER_PLACES = 1 << 22
#: Signatures of each member that tell whether another group reports a pair.
FIRST_SIGNS = 16
#: Rows of either side of a cell of a large group.
CELL_ROWS = 2048
#: Bytes of text whose signatures are united and packed together.
BLOCK_BYTES = 8 << 20
#: Places that a partition's signatures are dealt to; a task holds one place at a time.
PLACES = 4
#: Bytes of the input, as it is stored, for one partition of signatures.
PARTITION_BYTES = 8 << 20
#: Words whose hashes a worker remembers, about 8 MB.
REMEMBERED = 50_000

_SPACES = " \t\n\x0b\x0c\r"
_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_SIGN_BITS = 47
_SIGN = np.uint64((1 << _SIGN_BITS) - 1)


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads them."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        value = self[word] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        return value


@functools.lru_cache(maxsize=1)
def _hashes() -> _Hashes:
    hashes = _Hashes()
    at_task_end(hashes.clear)
    return hashes


def shingle_sets(texts: list[str | None], length: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct hashes of each text's shingles."""
    split = [(t or "").encode().translate(_LOWER).split() for t in texts]
    sizes = np.array([len(s) for s in split], np.int64)
    flat = np.fromiter(map(_hashes().__getitem__, chain.from_iterable(split)), np.uint64, int(sizes.sum()))
    value = np.zeros(max(0, len(flat) - length + 1), np.uint64)
    for k in range(length):
        value = value * _MULTIPLIER + flat[k : k + len(value)]
    value = mix(value)
    sets, at = [], 0
    for size in sizes.tolist():
        if size >= length:
            sets.append(np.unique(value[at : at + size - length + 1]))
        elif size:
            whole = np.array([size], np.uint64)
            for k in range(at, at + size):
                whole = whole * _MULTIPLIER + flat[k]
            sets.append(mix(whole))
        else:
            sets.append(np.zeros(0, np.uint64))
        at += size
    return sets


def node_of(shingles: np.ndarray) -> int:
    """The number of a set, signed so that it fits a bigint."""
    return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True)


def sketch(shingles: np.ndarray) -> bytes:
    """Counts of a set's elements, up to 255, in classes by hash: a power of two of them, about one to two elements."""
    width = min(12, max(6, int(len(shingles) - 1).bit_length() - 1))
    classes = (mix(shingles) >> np.uint64(64 - width)).astype(np.int64)
    return np.minimum(np.bincount(classes, minlength=1 << width), 255).astype(np.uint8).tobytes()


def narrowed(sketches: list[bytes], width: int) -> np.ndarray:
    """Sketches as rows of `width` classes each; classes of wider ones are added up."""
    made = np.empty((len(sketches), width), np.int16)
    lengths = np.array([len(s) for s in sketches])
    for length in np.unique(lengths):
        rows = np.flatnonzero(lengths == length)
        counts = np.frombuffer(b"".join([sketches[r] for r in rows]), np.uint8).reshape(len(rows), width, -1)
        made[rows] = counts.sum(axis=2, dtype=np.int16)
    return made


def may_link(size: np.ndarray, other: np.ndarray, classes: np.ndarray, others: np.ndarray) -> np.ndarray:
    """False where sizes or sketches show that a pair cannot be near enough.

    Sets of a and b elements with Jaccard of SHARE percent differ in (100 - SHARE) / (100 + SHARE) of a + b
    at most, and the differences of their classes' counts add up to no more than that.
    """
    apart = np.abs(classes - others).sum(axis=-1, dtype=np.int64)
    ratio = 100 * np.minimum(size, other) >= SHARE * np.maximum(size, other)
    return ratio & ((100 + SHARE) * apart <= (100 - SHARE) * (size + other))


class Band:
    """Signatures of sets whose size is at most `last`, for pairs whose larger size is in the band."""

    def __init__(self, number: int, last: int) -> None:
        self.number = number
        k = 2 * (100 - SHARE) * last // (100 + SHARE)
        self.spare = 0 if k == 0 else 1 + k // 12
        self.groups = k // 2 + 1 + self.spare if k else 1
        self.cells = 1 if k == 0 else 3 if last <= 40 else 2


@functools.lru_cache(maxsize=1)
def bands() -> tuple[np.ndarray, list[Band]]:
    """First sizes of the bands, and the bands: each ends where a set of Jaccard SHARE to its first can."""
    firsts, made, first = [], [], 1
    while first < 1 << 40:
        last = max(first, first * 100 // SHARE)
        firsts.append(first)
        made.append(Band(len(made), last))
        first = last + 1
    return np.array(firsts), made


def bands_of(size: int) -> list[Band]:
    """Its own band and, as the smaller set of a pair, the next one."""
    firsts, made = bands()
    own = int(np.searchsorted(firsts, size, "right")) - 1
    # No set beyond the next band is near enough: 100 * size < SHARE * its first size.
    return [made[own]] + ([made[own + 1]] if 100 * size >= SHARE * int(firsts[own + 1]) else [])


def signatures(shingles: np.ndarray) -> np.ndarray:
    """The signatures of one set that is not empty."""
    made = []
    for band in bands_of(len(shingles)):
        for partition in range(PARTITIONS):
            salt = np.array([(band.number << 8) + partition + 1], np.uint64)
            dealt = mix(shingles + salt * _MULTIPLIER)
            count = band.groups * band.cells
            cell = ((dealt >> np.uint64(32)) * np.uint64(count) >> np.uint64(32)).astype(np.int64)
            sums = np.zeros(count, np.uint64)
            np.add.at(sums, cell, mix(dealt))
            filled = np.bincount(cell, minlength=count).reshape(band.groups, band.cells)
            sums = sums.reshape(band.groups, band.cells)
            if band.cells > 1:  # without each cell in turn
                sums, filled = sums.sum(axis=1, keepdims=True) - sums, filled.sum(axis=1, keepdims=True) - filled
            names = np.arange(count, dtype=np.uint64).reshape(sums.shape) + (salt << np.uint64(32))
            usable = filled > 0
            made.append(mix(sums + mix(names * _MULTIPLIER))[usable])
            if np.count_nonzero(~usable.all(axis=1)) <= band.spare:
                break
        else:
            made.append(mix(np.array([band.number], np.uint64) * _MULTIPLIER))
    return np.concatenate(made) & _SIGN  # shorter to send; equal by chance only costs a comparison


# --- groups of equal signatures ---------------------------------------------------------------------


def _groups(signs: np.ndarray, nodes: np.ndarray, *flags: np.ndarray) -> tuple:
    """Distinct (signature, node), sorted, with the first place and the size of each signature's run."""
    order = np.lexsort((nodes, signs))
    signs, nodes = signs[order], nodes[order]
    flags = [f[order] for f in flags]
    if len(signs):
        new = np.append(True, (np.diff(signs) != 0) | (np.diff(nodes) != 0))
        flags = [np.logical_or.reduceat(f, np.flatnonzero(new)) for f in flags]
        signs, nodes = signs[new], nodes[new]
    starts = np.flatnonzero(np.append(True, np.diff(signs) != 0)) if len(signs) else np.zeros(0, np.int64)
    return signs, nodes, starts, np.diff(np.append(starts, len(signs))), *flags


def _chosen(signs: np.ndarray, nodes: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The place of one node of each run: the least by one of four orders, which the signature names."""
    order = mix(nodes.view(np.uint64) + (signs & np.uint64(3)) * _MULTIPLIER)
    least = np.minimum.reduceat(order, starts) if len(starts) else order
    found = np.flatnonzero(order == np.repeat(least, sizes))
    return found[np.unique(np.repeat(np.arange(len(starts)), sizes)[found], return_index=True)[1]]


def _pairs(nodes: np.ndarray, starts: np.ndarray, sizes: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs to compare of runs of more than one node: all of small runs, of large ones each with the chosen."""
    left, right = [], []
    for size in range(2, SMALL_GROUP + 1):
        first = starts[sizes == size]
        for a in range(size):
            for b in range(a + 1, size):
                left.append(nodes[first + a])
                right.append(nodes[first + b])
    large = sizes > SMALL_GROUP
    places = np.flatnonzero(np.repeat(large, sizes))
    left.append(np.repeat(nodes[chosen[large]], sizes[large]))
    right.append(nodes[places])
    left, right = np.concatenate(left), np.concatenate(right)
    apart = left != right
    return left[apart], right[apart]


def _distinct_pairs(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    pairs = np.unique(np.stack((np.minimum(left, right), np.maximum(left, right)), axis=1), axis=0)
    return pairs[:, 0], pairs[:, 1]


_BLOCKS = "place int, kind string, first binary, second binary, third binary, fourth binary"
_FOUND = "kind string, a bigint, b bigint, n bigint, sketch binary, sum bigint"


def _packed(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.string(), *[pa.binary()] * 4]
    names = ["place", "kind", "first", "second", "third", "fourth"]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names)


def _runs(places: np.ndarray, count: int, *columns: np.ndarray):
    """The columns' rows by place."""
    order = np.argsort(places, kind="stable")
    columns = [c[order] for c in columns]
    bounds = np.searchsorted(places[order], np.arange(count + 1)).tolist()
    for place, (start, end) in enumerate(zip(bounds, bounds[1:], strict=False)):
        if end > start:
            yield place, [c[start:end] for c in columns]


def _dealt(kind: str, places: np.ndarray, count: int, *columns: np.ndarray) -> list[tuple]:
    """Blocks of the columns' rows, by place."""
    return [(p, kind, *(c.tobytes() for c in own), *[None] * (4 - len(own))) for p, own in _runs(places, count, *columns)]


def _spread(values: np.ndarray, count: int) -> np.ndarray:
    return (mix(values) % np.uint64(count)).astype(np.int64)


def _blocks(batches, count: int) -> Iterator[pa.RecordBatch]:
    """Each block of texts: its documents, and its signatures with local groups united."""
    for batch in slices(batches, "text", BLOCK_BYTES):
        ids, sets = batch.column("key"), []
        for part in slices([batch], "text", 1 << 20):
            sets += shingle_sets(part.column("text").to_pylist())
        nodes = np.array([node_of(s) for s in sets], np.int64)
        sizes = np.array([len(s) for s in sets], np.int64)
        sketches = np.array([sketch(s) for s in sets] + [None], object)[:-1]  # of differing lengths
        known = np.asarray(ids.is_valid())
        keys, sums = np.asarray(ids.fill_null(0), np.int64), np.asarray(batch.column("sum"), np.int64)
        place = _spread(keys.view(np.uint64) + nodes.view(np.uint64), count)
        rows = []
        for kind, own in (("document", known), ("nameless", ~known)):
            for p, (k, n, size, sketched, texts) in _runs(place[own], count, keys[own], nodes[own], sizes[own], sketches[own], sums[own]):
                lengths = np.array([len(x) for x in sketched], np.int64)
                rows.append((p, kind, k.tobytes(), n.tobytes(), np.stack((size, lengths, texts)).tobytes(), b"".join(sketched)))
        _, firsts = np.unique(nodes, return_index=True)
        made = [(signatures(sets[k]), nodes[k]) for k in firsts if sizes[k]]
        del sets
        if made:
            signs = np.concatenate([m[0] for m in made])
            owners = np.repeat(np.array([m[1] for m in made], np.int64), [len(m[0]) for m in made])
            made = None
            rows += _united(signs, owners, count)
        yield _packed(rows)


def _united(signs: np.ndarray, owners: np.ndarray, count: int) -> list[tuple]:
    signs, nodes, starts, runs = _groups(signs, owners)
    chosen = _chosen(signs, nodes, starts, runs)
    several = runs > 1
    rows = []
    # A signature takes 47 bits and one that says whether several local sets have it; its set is named
    # by its place in a short list.
    marked = signs[chosen] | (several.astype(np.uint64) << np.uint64(_SIGN_BITS))
    for place, (marks, own) in _runs((signs[chosen] % np.uint64(count)).astype(np.int64), count, marked, nodes[chosen]):
        names, named = np.unique(own, return_inverse=True)
        short = np.uint16 if len(names) <= 1 << 16 else np.uint32
        parts = (marks.astype(np.uint32), (marks >> np.uint64(32)).astype(np.uint16), named.astype(short), names)
        rows.append((place, "signature", *(p.tobytes() for p in parts)))
    left, right = _distinct_pairs(*_pairs(nodes, starts, runs, chosen))
    rows += _dealt("pair", _spread(left.view(np.uint64) + right.view(np.uint64), count), count, left, right)
    members = np.flatnonzero(np.repeat(several, runs))
    place = _spread(signs[members] + nodes[members].view(np.uint64), count)
    return rows + _dealt("member", place, count, signs[members].view(np.int64), nodes[members])


def _unpacked(first: pa.Buffer, second: pa.Buffer, third: pa.Buffer, fourth: pa.Buffer) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    low, high = np.frombuffer(first, np.uint32), np.frombuffer(second, np.uint16)
    named = np.frombuffer(third, np.uint16 if third.size == 2 * len(low) else np.uint32)
    marks = low.astype(np.uint64) | (high.astype(np.uint64) << np.uint64(32))
    return marks & _SIGN, np.frombuffer(fourth, np.int64)[named], (marks >> np.uint64(_SIGN_BITS)).astype(bool)


def _table(kind: str, a, b: np.ndarray, n: np.ndarray | None = None, sketches: list[bytes] | None = None, sums: np.ndarray | None = None) -> pa.RecordBatch:
    columns = [pa.array([kind] * len(b), pa.string()), pa.array(a, pa.int64()), pa.array(b, pa.int64())]
    columns.append(pa.nulls(len(b), pa.int64()) if n is None else pa.array(n, pa.int64()))
    columns.append(pa.nulls(len(b), pa.binary()) if sketches is None else pa.array(sketches, pa.binary()))
    columns.append(pa.nulls(len(b), pa.int64()) if sums is None else pa.array(sums, pa.int64()))
    return pa.RecordBatch.from_arrays(columns, ["kind", "a", "b", "n", "sketch", "sum"])


def _meet(batches) -> Iterator[pa.RecordBatch]:
    """What the blocks hold together, place by place: documents, pairs to compare and members of open groups.

    Blocks come in order of place, so no more than the signatures of one place are held.
    """
    place, held = None, _Place()
    for batch in batches:
        for row, own in enumerate(batch.column("place").to_pylist()):
            if own != place:
                yield from held.tables()
                place, held = own, _Place()
            kind = batch.column("kind")[row].as_py()
            parts = [x.as_buffer() for x in (batch.column(k)[row] for k in range(2, 6)) if x.is_valid]
            if kind == "signature":
                held.signatures.append(_unpacked(*parts))
                continue
            a, b = (np.frombuffer(x, np.int64).copy() for x in parts[:2])
            if kind == "member":
                yield _table(kind, a, b)
            elif kind == "pair":
                held.pairs.append((a, b))
            else:
                named = a if kind == "document" else pa.nulls(len(a), pa.int64())
                sizes, lengths, sums = np.frombuffer(parts[2], np.int64).reshape(3, -1)
                ends = np.cumsum(lengths).tolist()
                sketches = [parts[3][e - n : e].to_pybytes() for e, n in zip(ends, lengths.tolist(), strict=True)]
                yield _table("document", named, b, sizes, sketches, sums)
    yield from held.tables()


class _Place:
    """Signatures and pairs of one place."""

    def __init__(self) -> None:
        self.signatures: list[tuple] = []
        self.pairs: list[tuple] = []

    def tables(self) -> Iterator[pa.RecordBatch]:
        if self.signatures:
            signs, nodes, several = (np.concatenate(c) for c in zip(*self.signatures, strict=True))
            self.signatures = []
            signs, nodes, starts, runs, several = _groups(signs, nodes, several)
            chosen = _chosen(signs, nodes, starts, runs)
            self.pairs.append(_pairs(nodes, starts, runs, chosen))
            unfinished = (runs > SMALL_GROUP) | ((runs > 1) & np.logical_or.reduceat(several, starts))
            members = np.flatnonzero(np.repeat(unfinished, runs))
            if len(members):
                yield _table("member", signs[members].view(np.int64), nodes[members])
        if self.pairs:
            left, right = _distinct_pairs(*(np.concatenate(c) for c in zip(*self.pairs, strict=True)))
            if len(left):
                yield _table("pair", left, right)


# --- comparing ---------------------------------------------------------------------------------------


def _possible(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs (a, b) that sizes and sketches leave."""
    side = lambda x: nodes.select(F.col("node").alias(x), F.col("n").alias(f"n_{x}"), F.col("sketch").alias(f"sketch_{x}"))
    met = pairs.join(side("a"), "a").join(side("b"), "b")

    def left(batches):
        for batch in batches:
            if batch.num_rows:
                sizes = [np.asarray(batch.column(x), np.int64) for x in ("n_a", "n_b")]
                sketches = [np.array([*batch.column(x).to_pylist(), None], object)[:-1] for x in ("sketch_a", "sketch_b")]
                widths = np.minimum(*(np.array([len(x) for x in side]) for side in sketches))
                keep = np.zeros(batch.num_rows, bool)
                for width in np.unique(widths):
                    own = np.flatnonzero(widths == width)
                    keep[own] = may_link(sizes[0][own], sizes[1][own], *(narrowed(list(side[own]), width) for side in sketches))
                yield batch.select(["a", "b"]).filter(pa.array(keep))

    return arrow_map(met, left, "a bigint, b bigint")


def _node_texts(rows: DataFrame, nodes: DataFrame, wanted: DataFrame) -> DataFrame:
    """node, text of the wanted nodes: the text of the document with the smallest id that has the set.

    A bit for each place of a hashed table of fixed size keeps most other documents out of the shuffle.
    """
    sources = stored(nodes.join(wanted, "node").select("node", "key"), "node-sources")
    places = sources.select(F.pmod(F.xxhash64("key"), F.lit(FILTER_PLACES)).cast("int").alias("place")).distinct().toArrow()
    marks = np.zeros(FILTER_PLACES, bool)
    marks[np.asarray(places.column(0))] = True
    shared = rows.sparkSession.sparkContext.broadcast(np.packbits(marks).tobytes())

    def marked(batches):
        known = np.unpackbits(np.frombuffer(shared.value, np.uint8)).view(bool)
        for batch in batches:
            keep = pa.array(known[np.asarray(batch.column("place"), np.int64)])
            yield batch.drop_columns(["place"]).filter(keep)

    def same(batches):
        # Other rows may have the same id and another text.
        for batch in slices(batches, "text"):
            sets = shingle_sets(batch.column("text").to_pylist())
            hit = [node_of(s) == n for s, n in zip(sets, batch.column("node").to_pylist(), strict=True)]
            yield batch.filter(pa.array(hit, pa.bool_()))

    placed = rows.filter("key is not null").withColumn("place", F.pmod(F.xxhash64("key"), F.lit(FILTER_PLACES)).cast("int"))
    found = arrow_map(placed, marked, "key bigint, text string")
    met = found.join(sources, "key").select("node", "text")
    return stored(arrow_map(met, same, "node bigint, text string").dropDuplicates(["node"]), "node-texts")


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()


def _linked(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """a, b of the pairs that are near enough; a's text is read once for a run of its pairs."""
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    left = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    met = pairs.join(right, "b").join(left, "a").select("a", "b", "text_a", "text_b")

    def near(batches):
        last, known = None, None
        for batch in slices(batches, "text_b", 1 << 20):
            sets = shingle_sets(batch.column("text_b").to_pylist())
            hit = []
            for place, (a, own) in enumerate(zip(batch.column("a").to_pylist(), sets, strict=True)):
                if a != last:
                    last, known = a, shingle_sets([batch.column("text_a")[place].as_py()])[0]
                shared = len(np.intersect1d(known, own, assume_unique=True))
                hit.append(100 * shared >= SHARE * (len(known) + len(own) - shared))
            yield batch.select(["a", "b"]).filter(pa.array(hit, pa.bool_()))

    return arrow_map(met, near, "a bigint, b bigint")


def _open_pairs(found: DataFrame, labels: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs that share an unfinished group's signature, have different labels so far and may be linked.

    A group's members meet in cells of at most CELL_ROWS to a side; only possible pairs leave a cell.
    Pairs share many signatures: of those among both members' FIRST_SIGNS smallest, the smallest reports.
    """
    members = found.filter("kind = 'member'").select(F.col("a").alias("sign"), F.col("b").alias("node")).distinct()
    labelled = members.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    spread = labelled.groupBy("sign").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("size"))
    spread = spread.filter("low != high").select("sign", F.ceil(F.col("size") / CELL_ROWS).cast("int").alias("blocks"))
    own = stored(labelled.join(spread, "sign"), "open-groups")
    firsts = own.groupBy("node").agg(F.slice(F.array_sort(F.collect_list("sign")), 1, FIRST_SIGNS).alias("firsts"))
    own = own.join(nodes.select("node", "n", "sketch").join(firsts, "node"), "node")
    block = own.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    cells = block.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cell = [F.col("sign"), F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high")]
    cells = cells.select(*cell, "node", "label", "n", "sketch", "firsts").repartition("sign", "low", "high")
    met = arrow_map(cells.sortWithinPartitions("sign", "low", "high"), _cells, "a bigint, b bigint")
    return met.distinct()


def _cells(batches) -> Iterator[pa.RecordBatch]:
    """Possible pairs of rows that come sorted by cell."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        names = np.stack([np.asarray(batch.column(k), np.int64) for k in range(3)], axis=1)
        cuts = [0, *(1 + np.flatnonzero((np.diff(names, axis=0) != 0).any(axis=1))).tolist(), batch.num_rows]
        if held and any(held[-1].column(k)[-1].as_py() != names[0, k] for k in range(3)):
            yield _possible_in(held)
            held = []
        for start, end in zip(cuts, cuts[1:], strict=False):
            held.append(batch.slice(start, end - start))
            if end < batch.num_rows:
                yield _possible_in(held)
                held = []
    if held:
        yield _possible_in(held)


def _possible_in(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    nodes, labels, sizes = (np.concatenate([np.asarray(p.column(k), np.int64) for p in parts]) for k in (3, 4, 5))
    sketches = [x for p in parts for x in p.column("sketch").to_pylist()]
    classes = narrowed(sketches, min(map(len, sketches)))
    sign = parts[0].column("sign")[0].as_py()
    firsts = np.full((len(nodes), FIRST_SIGNS), -1)  # those before this group's own
    for row, signs in enumerate(x for p in parts for x in p.column("firsts").to_pylist()):
        before = [x for x in signs if x < sign]
        firsts[row, : len(before)] = before
    left, right = [], []
    # Some rows at a time against all later ones, about 2^21 counts of classes.
    step = max(1, (1 << 21) // (len(nodes) * classes.shape[1]))
    for low in range(0, len(nodes), step):
        one, two = np.nonzero(labels[low : low + step, None] != labels[None, low:])
        one, two = one[one < two] + low, two[one < two] + low
        near = may_link(sizes[one], sizes[two], classes[one], classes[two])
        one, two = one[near], two[near]
        known = firsts[one][:, :, None]
        elsewhere = ((known == firsts[two][:, None, :]) & (known >= 0)).any(axis=(1, 2))
        left.append(nodes[one[~elsewhere]])
        right.append(nodes[two[~elsewhere]])
    left, right = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (left, right))
    columns = [pa.array(np.minimum(left, right)), pa.array(np.maximum(left, right))]
    return pa.RecordBatch.from_arrays(columns, ["a", "b"])


def _labelled(documents: DataFrame, key: str, text: str) -> DataFrame:
    """key, node, n, sum (a hash of the text), label (the smallest node of the component) of each row."""
    rows = documents.select(documents[key].cast("bigint").alias("key"), documents[text].cast("string").alias("text"))
    rows = rows.withColumn("sum", F.xxhash64("text"))
    count = partitions_for(documents, PARTITION_BYTES)
    blocks = arrow_map(rows, lambda b: _blocks(b, PLACES * count), _BLOCKS)
    placed = blocks.repartition(count, "place").sortWithinPartitions("place")
    found = stored(arrow_map(placed, _meet, _FOUND), "signature-groups")
    known = found.filter("kind = 'document'").select(F.col("a").alias("key"), F.col("b").alias("node"), F.col("n"), "sketch", "sum")
    nodes = known.filter("n > 0").groupBy("node").agg(F.min("key").alias("key"), F.first("n").alias("n"), F.first("sketch").alias("sketch"))
    nodes = stored(nodes, "nodes")
    pairs = stored(_possible(found.filter("kind = 'pair'").select("a", "b").distinct(), nodes), "pairs")
    texts = _node_texts(rows, nodes, _ends(pairs))
    links = stored(_linked(pairs, texts), "links")
    labels = components(links)
    more = stored(_open_pairs(found, labels, nodes).join(pairs, ["a", "b"], "left_anti"), "open-pairs")
    if not more.isEmpty():
        unseen = _ends(more).join(texts, "node", "left_anti")
        texts = texts.unionByName(_node_texts(rows, nodes, unseen))
        labels = components(links.unionByName(_linked(more, texts)))
    return known.drop("sketch").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))


def link(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_shingles, component_id (the smallest id that links reach) of each row."""
    labelled = _labelled(documents, key, text)
    names = labelled.filter("n > 0").groupBy("label").agg(F.min("key").alias("component_id"))
    own = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("key"))
    return labelled.join(names, "label", "left").select(F.col("key").alias(key), F.col("n").alias("n_shingles"), own.alias("component_id"))


def keep_first(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each component, the one with the smallest id, with all columns; ties by hash of the text.

    A row is known by its id and the hash of its text, so rows with one id and texts that are not linked
    all stay; of rows alike in both, the one with the least hash of all columns does.  Rows without words are linked with nothing and stay; so do rows without an id.
    """
    name, number = fresh(documents, "first_key"), fresh(documents, "number")
    named = _labelled(documents, key, text).filter("n > 0 and key is not null")
    firsts = named.groupBy("label").agg(F.min(F.struct("key", "sum")).alias("least"))
    firsts = firsts.select(F.col("least.key").alias(name), F.col("least.sum").alias(number))
    value = documents[text].cast("string")
    own = documents.withColumns({name: documents[key].cast("bigint"), number: F.xxhash64(value)})
    linked = documents[key].isNotNull() & (F.translate(F.coalesce(value, F.lit("")), _SPACES, "") != "")
    # Tasks reduce copies of one id and text to one row before the shuffle, the least by a hash of all columns.
    row = F.min_by(F.struct(*documents.columns), F.xxhash64(*documents.columns)).alias("row")
    kept = own.filter(linked).groupBy(name, number).agg(row).join(firsts, [name, number], "left_semi")
    return kept.select("row.*").unionByName(documents.filter(~linked))
