"""A uniform shuffle of all rows into shards of exact sizes, by DataFrame and SQL functions only.

How many rows go from each partition to each shard is drawn first: a matrix whose rows add up to the
partitions' counts, whose columns add up to the shards' sizes, and which has the law that a uniform
permutation of all rows would give it.  Halving the partitions again and again, each half's share of
every shard is a hypergeometric draw given the shares before it, so all nodes of a level are drawn
side by side.  Then each partition permutes its rows and deals them out by its row of the matrix,
rows are exchanged, and each shard permutes what it got.  Every permutation of the rows over all
places is equally likely, up to the quality of the random numbers.

The second permutation sorts by (shard, random key) over the whole table, so a shard of any size is
spread over tasks; a row's slot is its place in its task's run plus the counts of the runs before.

Shard sizes differ by one at most; lower numbers get the extra rows.  Equal rows, rows of equal texts
and rows without key are rows like any other.  An empty table gives no rows.  Columns of any names
stay; where the rows already have a `shard` or `slot`, the new one gets an underscore after its name.
Equal seeds give equal results on equal partitions of the input, in equal order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlink.llm.common import fresh, stored

#: `monotonically_increasing_id` keeps the partition above these bits and the row's place below.
_PLACE_BITS = 33
#: Levels of the tree of partitions drawn in one task; its nodes are then spread.
_TOP_LEVELS = 7


def _let(name: str, value: str, body: str) -> str:
    """`body` with the value under a name, computed once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def hypergeometric(total: str, good: str, draws: str, uniform: str) -> str:
    """SQL: how many of `draws` rows, taken from `total` without putting back, are among the `good` ones.

    By inversion: the probabilities from a lower to an upper value follow from each other by ratios,
    and the first value whose running sum passes `uniform` of the whole sum is taken.  What lies
    further than twelve deviations and 40 from the mean, less than a double can tell from 0, is left out.
    """
    mean = f"(cast({draws} as double) * {good} / greatest({total}, 1))"
    spread = f"sqrt({mean} * ({total} - {good}) / greatest({total}, 1) * ({total} - {draws}) / greatest({total} - 1, 1))"
    low = f"greatest(0L, {draws} + {good} - {total}, cast(floor({mean} - 12 * {spread}) as bigint) - 40L)"
    high = f"least({draws}, {good}, cast(ceil({mean} + 12 * {spread}) as bigint) + 40L)"
    ratio = (
        f"cast({good} - k as double) * cast({draws} - k as double)"
        f" / (cast(k + 1 as double) * cast({total} - {good} - {draws} + k + 1 as double))"
    )
    whole = (
        "aggregate(sequence(r.low, r.high), named_struct('p', 1D, 's', 0D),"
        f" (x, k) -> named_struct('p', x.p * {ratio}, 's', x.s + x.p), x -> x.s)"
    )
    found = (
        "aggregate(sequence(r.low, r.high), named_struct('p', 1D, 's', 0D, 'v', r.low),"
        f" (x, k) -> named_struct('p', x.p * {ratio}, 's', x.s + x.p, 'v', if(x.s + x.p <= goal, k + 1, x.v)),"
        " x -> least(x.v, r.high))"
    )
    searched = _let("goal", f"{uniform} * {whole}", found)
    return _let("r", f"named_struct('low', {low}, 'high', {high})", f"if(r.low >= r.high, r.low, {searched})")


def uniform(seed: int, *names: str) -> str:
    """SQL: a number from 0 up to 1, fixed by the seed and the named values."""
    return f"(shiftrightunsigned(xxhash64({', '.join([f'{seed}L', *names])}), 11) * {2.0**-53!r}D)"


def _left_share(seed: int) -> str:
    """SQL: of the rows that a node owes to each shard (`owed`), those from its left half, of `n_left` rows."""
    drawn = hypergeometric("t.total", "owed[i]", "t.n", uniform(seed, "first", "size(counts)", "i"))
    step = _let("drawn", drawn, "named_struct('total', t.total - owed[i], 'n', t.n - drawn, 'left', concat(t.left, array(drawn)))")
    start = "named_struct('total', n_all, 'n', n_left, 'left', cast(array() as array<bigint>))"
    return f"aggregate(sequence(0, size(owed) - 1), {start}, (t, i) -> {step}, t -> t.left)"


def _sum(array: str) -> str:
    return f"aggregate({array}, 0L, (a, b) -> a + b)"


def communication_matrix(counts: DataFrame, n_parts: int, sizes: Column, seed: int) -> DataFrame:
    """part, owed: how many of the partition's rows each shard gets.

    `counts` has part (from 0) and n; `sizes` is an array of shard sizes that add up to the sum of n.
    """
    listed = F.transform(F.array_sort(F.collect_list(F.struct("part", "n"))), lambda x: x["n"])
    nodes = counts.agg(listed.alias("counts")).select(F.lit(0).cast("bigint").alias("first"), "counts", sizes.alias("owed"))
    levels = max(0, (n_parts - 1).bit_length())
    for level in range(levels):
        if level == _TOP_LEVELS:
            nodes = nodes.repartition("first")
        half = 1 << (levels - level - 1)
        halves = nodes.select(
            "first", "counts", "owed", F.slice("counts", 1, half).alias("left"),
            F.expr(f"if(size(counts) > {half}, slice(counts, {half + 1}, {half}), cast(array() as array<bigint>))").alias("right"),
        )
        summed = halves.select("*", F.expr(_sum("counts")).alias("n_all"), F.expr(_sum("left")).alias("n_left"))
        drawn = summed.withColumn("share", F.expr(_left_share(seed)))
        left = F.struct("first", F.col("left").alias("counts"), F.col("share").alias("owed"))
        rest = F.zip_with("owed", "share", lambda a, b: a - b)
        right = F.struct((F.col("first") + half).alias("first"), F.col("right").alias("counts"), rest.alias("owed"))
        nodes = drawn.select(F.explode(F.array(left, right)).alias("node")).select("node.*").filter("size(counts) > 0")
    return nodes.select(F.col("first").alias("part"), "owed")


def _numbered(frame: DataFrame, name: str) -> DataFrame:
    """The rows with their task and their place in it, fixed in a stored table."""
    at = F.monotonically_increasing_id()
    numbered = stored(frame.withColumn("at", at), name)
    place = F.col("at").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    return numbered.select("*", F.shiftright("at", _PLACE_BITS).alias("part"), place.alias("place")).drop("at")


def shuffle(rows: DataFrame, shards: int, seed: int = 0) -> DataFrame:
    """The rows with shard (int) and slot (bigint, gapless from 0 in each shard).

    Two tables stay in the shared folder, `sharding-local-*` and `sharding-shards-*`.
    """
    if shards < 1:
        raise ValueError("need one shard at least")
    shard, slot = fresh(rows, "shard"), fresh(rows, "slot")
    packed = rows.select(F.struct(*(rows[c] for c in rows.columns)).alias("row"), F.rand(seed).alias("own"), F.rand(seed + 1).alias("key"))
    local = _numbered(packed.sortWithinPartitions("own").drop("own"), "sharding-local")

    counted = local.groupBy("part").agg(F.count("*").alias("n"))
    n_parts, n_rows = counted.agg(F.coalesce(F.max("part") + 1, F.lit(0)), F.coalesce(F.sum("n"), F.lit(0))).first()
    # Partitions without rows count too, so that a partition's number is its place in the list.
    every = rows.sparkSession.range(n_parts).select(F.col("id").alias("part")).join(counted, "part", "left").na.fill(0)
    base, extra = divmod(n_rows, shards)
    sizes = F.expr(f"transform(sequence(0, {shards - 1}), s -> {base}L + if(s < {extra}, 1L, 0L))")
    matrix = communication_matrix(every, n_parts, sizes, seed)
    ends = "transform(owed, (x, i) -> aggregate(slice(owed, 1, i + 1), 0L, (a, b) -> a + b))"
    matrix = stored(matrix.select("part", F.expr(ends).alias("ends")), "sharding-matrix")

    dealt = local.join(matrix, "part").select("row", "key", F.expr("size(filter(ends, e -> e <= place))").alias("shard"))
    permuted = dealt.repartitionByRange("shard", "key").sortWithinPartitions("shard", "key").drop("key")
    permuted = _numbered(permuted, "sharding-shards")
    runs = permuted.groupBy("shard", "part").agg(F.min("place").alias("first"), F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("shard", "part", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("base"))
    placed = permuted.join(runs, ["shard", "part"])
    return placed.select("row.*", F.col("shard").alias(shard), (F.col("base") + F.col("place")).alias(slot))


def document_shards(documents: DataFrame, shards: int, seed: int = 0, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, size, text_crc32, law, shard, slot, grown_shard of each row; the texts are not moved.

    A null text has no bytes.  The law is `rows`: counts differ by one at most; so there is no grown shard.
    """
    whole = F.coalesce(documents[text].cast("string"), F.lit("")).cast("binary")
    digests = documents.select(
        documents[key].alias(key), (F.octet_length(whole) + F.lit(8)).cast("bigint").alias("size"), F.crc32(whole).alias("text_crc32")
    )
    return shuffle(digests, shards, seed).select(
        key, "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def write_shards(rows: DataFrame, shards: int, folder: str, seed: int = 0) -> None:
    """The shuffled rows as Parquet below `folder`, one folder a shard, rows of a file in order of slot.

    A shard is written by as many tasks as the exchange by (shard, slot) gives it, so files are bounded.
    """
    shuffled = shuffle(rows, shards, seed)
    *_, shard, slot = shuffled.columns
    shuffled.repartitionByRange(shard, slot).sortWithinPartitions(shard, slot).write.partitionBy(shard).parquet(folder)
