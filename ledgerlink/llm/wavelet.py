"""Token ids in shard files that are wavelet matrices.

Documents are dealt out by ranges of doc_id, so that the files' order is the documents' order.  Each
task encodes its documents in that order, appends an end id to each, and cuts shards of about
`shard_tokens` ids, so memory is bounded by the shard and the longest document.  A shard file holds
the distinct ids of the shard, the documents' ids and lengths, and the bit-planes of a wavelet matrix
over positions in the sorted distinct ids, in compressed blocks, with the ones before each block.  Any file
alone answers access, rank, select, counting and occurrences from these samples and the blocks it touches;
`token_frequencies` and `token_occurrences` ask all files.

Order: ascending doc_id (null first), then the text's hash; equal rows are interchangeable and each
gets its own place.  A null text counts as empty and is just the end id.  An empty table writes no file.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlink.llm.common import arrow_map, slices, stored, texts
from ledgerlink.llm.words import byte_encoder
from ledgerlink.sources.store import shared_folder

_HEAD = struct.Struct("<4sQIIIIIII")
_MARK = b"WVM2"
_BLOCK = 1 << 13  # bytes of a plane that are compressed together, with the ones before them in the directory


class _Planes:
    """The bit-planes of a file: compressed blocks, unpacked when first needed, with sampled ranks."""

    def __init__(self, levels: int, width: int, directory: np.ndarray, packed: bytes) -> None:
        self._levels, self._width = levels, width
        self._blocks = -(-width // _BLOCK)
        sizes, self._before = directory[0].astype(np.int64), directory[1].reshape(levels, self._blocks)
        self._starts = np.concatenate(([0], np.cumsum(sizes)))
        self.directory, self.packed, self._open = directory, packed, {}

    def block(self, level: int, number: int) -> np.ndarray:
        at = level * self._blocks + number
        if at not in self._open:
            raw = self.packed[self._starts[at] : self._starts[at + 1]]
            self._open[at] = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8)
        return self._open[at]

    def ones(self, level: int, at: int) -> int:
        """Ones before position `at` of the plane, from one sampled rank and one block."""
        byte, rest = divmod(at, 8)
        number = min(byte // _BLOCK, self._blocks - 1)
        if number < 0:
            return 0
        inside, block = byte - number * _BLOCK, self.block(level, number)
        found = int(self._before[level, number]) + int(np.bitwise_count(block[:inside]).sum(dtype=np.int64))
        return found + (int(block[inside]) >> (8 - rest)).bit_count() if rest else found

    def find(self, level: int, k: int, one: int) -> int:
        """The position of the plane's bit number k, from 0, that is `one`."""
        before = self._before[level].astype(np.int64)
        counts = before if one else 8 * _BLOCK * np.arange(self._blocks) - before
        number = int(np.searchsorted(counts, k, "right")) - 1
        bits = np.unpackbits(self.block(level, number))
        return 8 * _BLOCK * number + int(np.flatnonzero(bits == one)[k - int(counts[number])])

    def whole(self) -> list[np.ndarray]:
        unpack = zstandard.ZstdDecompressor().decompress
        starts = self._starts.tolist()
        raw = [unpack(self.packed[a:b]) for a, b in zip(starts, starts[1:], strict=False)]
        each = self._blocks
        return [np.frombuffer(b"".join(raw[k * each : (k + 1) * each]), np.uint8) for k in range(self._levels)]

    @staticmethod
    def pack(planes: list[np.ndarray]) -> tuple[np.ndarray, bytes]:
        """The directory (sizes; ones before each block) and the compressed blocks."""
        pack, sizes, before, made = zstandard.ZstdCompressor(level=1).compress, [], [], []
        for plane in planes:
            ones = 0
            for start in range(0, len(plane), _BLOCK):
                block = plane[start : start + _BLOCK]
                made.append(pack(block.tobytes()))
                sizes.append(len(made[-1]))
                before.append(ones)
                ones += int(np.bitwise_count(block).sum(dtype=np.int64))
        return np.array([sizes, before], "<u4").reshape(2, -1), b"".join(made)


class WaveletMatrix:
    """A sequence of ids as bit-planes, most significant bit first, each plane stably sorted by the ones above."""

    def __init__(self, symbols: np.ndarray, zeros: list[int], planes: _Planes, size: int) -> None:
        self.symbols, self.zeros, self.size = symbols, zeros, size
        self._planes = planes

    @classmethod
    def build(cls, ids: np.ndarray) -> WaveletMatrix:
        symbols, codes = _dense(ids)
        zeros, planes = [], []
        for level in reversed(range(_levels(len(symbols)))):
            bits = ((codes >> codes.dtype.type(level)) & codes.dtype.type(1)).astype(bool)
            planes.append(np.packbits(bits))
            low = np.compress(~bits, codes)
            zeros.append(len(low))
            codes = np.concatenate((low, np.compress(bits, codes)))
        directory, packed = _Planes.pack(planes)
        return cls(symbols, zeros, _Planes(len(planes), -(-len(ids) // 8), directory, packed), len(ids))

    def access(self, at: int) -> int:
        code = 0
        for level, zeros in enumerate(self.zeros):
            ones = self._planes.ones(level, at)
            bit = self._planes.ones(level, at + 1) - ones
            at = zeros + ones if bit else at - ones
            code = code << 1 | bit
        return int(self.symbols[code])

    def _code(self, symbol: int) -> int | None:
        k = int(np.searchsorted(self.symbols, symbol))
        return k if k < len(self.symbols) and self.symbols[k] == symbol else None

    def _interval(self, code: int, start: int, end: int) -> tuple[int, int]:
        for level, zeros in enumerate(self.zeros):
            a, b = self._planes.ones(level, start), self._planes.ones(level, end)
            one = code >> (len(self.zeros) - 1 - level) & 1
            start, end = (zeros + a, zeros + b) if one else (start - a, end - b)
        return start, end

    def count(self, symbol: int, start: int = 0, end: int | None = None) -> int:
        """Occurrences of the symbol in positions start to end."""
        code = self._code(symbol)
        if code is None:
            return 0
        a, b = self._interval(code, start, self.size if end is None else end)
        return b - a

    def select(self, symbol: int, k: int) -> int:
        """The position of the symbol's occurrence number k, from 0."""
        code = self._code(symbol)
        first, last = (0, 0) if code is None else self._interval(code, 0, self.size)
        if not 0 <= k < last - first:
            raise IndexError(k)
        at = first + k
        for level in reversed(range(len(self.zeros))):
            one = code >> (len(self.zeros) - 1 - level) & 1
            at = self._planes.find(level, at - self.zeros[level] if one else at, one)
        return at

    def occurrences(self, symbol: int) -> list[int]:
        return [self.select(symbol, k) for k in range(self.count(symbol))]

    def all(self) -> np.ndarray:
        """The whole sequence: the planes' stable sorts undone from the last to the first."""
        levels = len(self.zeros)
        codes, planes = np.zeros(self.size, _code_type(levels)), self._planes.whole()
        for level in reversed(range(levels)):
            bits, zeros = np.unpackbits(planes[level], count=self.size).view(bool), self.zeros[level]
            above = np.empty_like(codes)
            above[~bits] = codes[:zeros]
            above[bits] = codes[zeros:] | codes.dtype.type(1 << (levels - 1 - level))
            codes = above
        return self.symbols.take(codes)


def _levels(symbols: int) -> int:
    return max(1, (symbols - 1).bit_length())


def _code_type(levels: int) -> type:
    return np.uint16 if levels <= 16 else np.uint32


def _dense(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct ids, and each id's place among them."""
    if not len(ids):
        return np.zeros(1, "<u4"), np.zeros(0, np.uint16)
    if int(ids.max()) >= 1 << 22:
        symbols, codes = np.unique(ids, return_inverse=True)
    else:
        present = np.bincount(ids) > 0
        symbols = np.flatnonzero(present)
        codes = (np.cumsum(present) - 1).astype(np.uint32).take(ids)
    return symbols.astype("<u4"), codes.astype(_code_type(_levels(len(symbols))))


def dump(matrix: WaveletMatrix, keys: list[int | None], lengths: list[int]) -> bytes:
    """One shard file: a head, then the parts, compressed; the planes in blocks that unpack one by one."""
    pack = zstandard.ZstdCompressor(level=1).compress
    missing = np.array([k is None for k in keys], bool)
    parts = [
        pack(matrix.symbols.tobytes()),
        pack(np.array(matrix.zeros, "<u8").tobytes()),
        pack(np.array([k or 0 for k in keys], "<i8").tobytes() + np.packbits(missing).tobytes()),
        pack(np.array(lengths, "<u4").tobytes()),
        pack(matrix._planes.directory.tobytes()),
        matrix._planes.packed,
    ]
    body = b"".join(struct.pack("<Q", len(p)) + p for p in parts)
    head = _HEAD.pack(_MARK, matrix.size, len(matrix.zeros), len(matrix.symbols), len(keys), zlib.crc32(body), 0, 0, 0)
    return head + body


def load(data: bytes) -> tuple[WaveletMatrix, list[int | None], np.ndarray]:
    """The matrix, the documents' keys and their lengths in ids; bytes after the last part are ignored."""
    mark, size, levels, _, documents, check, *_ = _HEAD.unpack_from(data)
    if mark != _MARK:
        raise ValueError("not a shard file")
    at, parts, unpack = _HEAD.size, [], zstandard.ZstdDecompressor().decompress
    for _ in range(6):
        (length,) = struct.unpack_from("<Q", data, at)
        parts.append(data[at + 8 : at + 8 + length])
        at += 8 + length
    if zlib.crc32(data[_HEAD.size : at]) != check:
        raise ValueError("damaged shard file")
    symbols, zeros, named, lengths, directory = map(unpack, parts[:5])
    missing = np.unpackbits(np.frombuffer(named[8 * documents :], np.uint8), count=documents).astype(bool)
    keys = [None if m else k for k, m in zip(np.frombuffer(named[: 8 * documents], "<i8").tolist(), missing, strict=True)]
    planes = _Planes(levels, -(-size // 8), np.frombuffer(directory, "<u4").reshape(2, -1), parts[5])
    matrix = WaveletMatrix(np.frombuffer(symbols, "<u4"), np.frombuffer(zeros, "<u8").tolist(), planes, size)
    return matrix, keys, np.frombuffer(lengths, "<u4")


def _shards(batches, path: str, end_id: int, shard_tokens: int) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    encoder, part = byte_encoder(path), TaskContext.get().partitionId()
    end = np.array([end_id], "<u4")
    keys, lengths, ids, filled, made = [], [], [], 0, 0

    def shard():
        matrix = WaveletMatrix.build(np.concatenate(ids))
        data = dump(matrix, keys, lengths)
        return pa.RecordBatch.from_arrays([pa.array([f"{part:08d}-{made:08d}"]), pa.array([data], pa.binary())], ["shard", "data"])

    for batch in slices(batches, "text"):
        for key, encoded in zip(batch.column("key").to_pylist(), encoder.encode(texts(batch)), strict=True):
            if filled and filled + len(encoded) + 1 > shard_tokens:
                yield shard()
                keys, lengths, ids, filled, made = [], [], [], 0, made + 1
            keys.append(key)
            ids += [encoded, end]
            filled += len(encoded) + 1
            lengths.append(len(encoded) + 1)
    if filled:
        yield shard()


def write(
    documents: DataFrame, folder: str, path: str, end_id: int = 0,
    key: str = "doc_id", text: str = "text", shard_tokens: int = 1 << 20,
) -> None:
    """Encode the documents and write the shard files below `folder`, one folder and file a shard."""
    rows = documents.select(documents[key].cast("bigint").alias("key"), documents[text].cast("string").alias("text"))
    ordered = rows.withColumn("tie", F.xxhash64("text"))
    ordered = ordered.repartitionByRange("key", "tie").sortWithinPartitions("key", "tie").drop("tie")
    shards = arrow_map(ordered, lambda b: _shards(b, path, end_id, shard_tokens), "shard string, data binary")
    # Spark's text writer puts a string's bytes out as they are; the line break after them is outside the format.
    shards.select("shard", F.col("data").cast("string").alias("value")).write.partitionBy("shard").text(folder)


def _files(spark: SparkSession, folder: str) -> DataFrame:
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    return files.select(F.regexp_extract("path", "shard=([0-9-]+)", 1).alias("shard"), "content").filter("shard != ''")


def read_documents(spark: SparkSession, folder: str, token_ids: bool = False, key: str = "doc_id") -> DataFrame:
    """key, start, n_tokens, ids_crc32 and, with `token_ids`, the ids (binary) of each document in the files.

    start counts the ids of all documents before it: within the shard, in earlier shards of the same
    range, and in earlier ranges, of which there is one row each.
    """

    def run(batches):
        for batch in batches:
            for shard, content in zip(batch.column("shard").to_pylist(), batch.column("content"), strict=True):
                matrix, keys, lengths = load(content.as_py())
                raw = matrix.all().astype("<u4").tobytes()
                ends = np.cumsum(lengths, dtype=np.int64)
                spans = [raw[4 * (e - n) : 4 * e] for e, n in zip(ends.tolist(), lengths.tolist(), strict=True)]
                columns = [
                    pa.array([shard] * len(keys)), pa.array(keys, pa.int64()), pa.array(ends - lengths, pa.int64()),
                    pa.array(lengths, pa.int64()), pa.array([zlib.crc32(s) for s in spans], pa.int64()),
                ]
                names = ["shard", "key", "within", "n_tokens", "ids_crc32"]
                if token_ids:
                    columns, names = [*columns, pa.array(spans, pa.binary())], [*names, "ids"]
                yield pa.RecordBatch.from_arrays(columns, names)

    schema = "shard string, key bigint, within bigint, n_tokens bigint, ids_crc32 bigint"
    ids = ["ids"] if token_ids else []
    found = stored(arrow_map(_files(spark, folder), run, schema + (", ids binary" if ids else "")), "wavelet-documents")
    shards = found.groupBy("shard").agg(F.sum("n_tokens").alias("size")).withColumn("part", F.substring("shard", 1, 8))
    ranges = shards.groupBy("part").agg(F.sum("size").alias("size"))
    parts = ranges.select("part", F.coalesce(F.sum("size").over(Window.orderBy("part").rowsBetween(*_BEFORE)), F.lit(0)).alias("base"))
    inside = F.coalesce(F.sum("size").over(Window.partitionBy("part").orderBy("shard").rowsBetween(*_BEFORE)), F.lit(0))
    starts = shards.withColumn("inside", inside).join(parts, "part").select("shard", (F.col("base") + F.col("inside")).alias("base"))
    placed = found.join(starts, "shard")
    return placed.select(F.col("key").alias(key), (F.col("base") + F.col("within")).alias("start"), "n_tokens", "ids_crc32", *ids)


_BEFORE = (Window.unboundedPreceding, -1)


def token_occurrences(spark: SparkSession, folder: str, token_ids: list[int], key: str = "doc_id") -> DataFrame:
    """token_id, key, place (from 0 in the document) of each occurrence of the given ids in the shard files.

    Answered by select on each file, which unpacks only the blocks that the occurrences touch.  Repeated ids
    count once; documents alike in key each give their own rows.
    """
    wanted = sorted(set(token_ids))

    def run(batches):
        for batch in batches:
            for content in batch.column("content"):
                matrix, keys, lengths = load(content.as_py())
                ends = np.cumsum(lengths, dtype=np.int64)
                for token in wanted:
                    at = np.array(matrix.occurrences(token), np.int64)
                    owner = np.searchsorted(ends, at, "right")
                    place = at - (ends - lengths)[owner]
                    own = pa.array([keys[k] for k in owner.tolist()], pa.int64())
                    yield pa.RecordBatch.from_arrays([pa.array([token] * len(at), pa.int64()), own, pa.array(place)], ["token_id", "key", "place"])

    return arrow_map(_files(spark, folder), run, "token_id bigint, key bigint, place bigint").withColumnRenamed("key", key)


def token_frequencies(spark: SparkSession, folder: str, token_ids: list[int]) -> DataFrame:
    """token_id, n: how often each of the given ids stands in the shard files, by rank on each file, added up."""
    wanted = sorted(set(token_ids))

    def run(batches):
        for batch in batches:
            for content in batch.column("content"):
                matrix, _, _ = load(content.as_py())
                counts = [matrix.count(token) for token in wanted]
                yield pa.RecordBatch.from_arrays([pa.array(wanted, pa.int64()), pa.array(counts, pa.int64())], ["token_id", "n"])

    found = arrow_map(_files(spark, folder), run, "token_id bigint, n bigint").groupBy("token_id").agg(F.sum("n").alias("n"))
    every = spark.createDataFrame([(t,) for t in wanted], "token_id bigint")
    return every.join(found, "token_id", "left").fillna(0, "n")


def round_trip(documents: DataFrame, path: str, end_id: int = 0, **names) -> DataFrame:
    """Write the documents below the session's shared folder and read them back."""
    spark = documents.sparkSession
    folder = f"{shared_folder(spark)}/wavelet-{uuid.uuid4().hex}"
    write(documents, folder, path, end_id, **names)
    return read_documents(spark, folder)
