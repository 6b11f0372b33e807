"""Minimum-cost-flow resharding, by the law ``bytes``: shards of near equal size, reached by moving the fewest bytes.

Rows lie in the shards of a store, a folder of Parquet files partitioned by __shard (`store` writes a first one, by a hash of
the text, so that equal texts lie together). Each old shard is cut to blocks by hash, and blocks above a share of the
total to parts by a second hash, so that the driver sees only a bounded number of sizes (`BLOCKS_AT_MOST`, and half as many
parts, of under 100 bytes each). A minimum-cost flow from the sizes of stored shards to new capacities, at no cost where
old and new number agree and a byte's cost elsewhere, says how much each shard sends where; laid end to end, the parts of
an old shard are cut at these amounts. A part on a cut is dealt row by row, by the row's middle. Equal texts are
neighbours, so that only cuts part them. `resharded` writes the shards that gain or lose a row, in ranges of their slots,
each row as it streams by (so that no key has to be unique), and gives the places as the written files have them; `plan`
only plans.

Null texts count 16 bytes and the checksum of no bytes; repeated rows are rows of their own; an empty table gives no
rows. Columns other than doc_id and text are ignored by the plan and kept in what is written; one called __shard would be
taken for the shard that the row lies in.
"""

from __future__ import annotations

from bisect import bisect_right
from collections import defaultdict
from itertools import accumulate

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from .workspace import Workspace, documents, partitions, shuffles_freed

OLD_SHARDS, SHARDS = 32, 40
#: Blocks in all, at least and at most, and the bytes of a block in between.
BLOCKS, BLOCKS_AT_MOST, BLOCK_BYTES = 4096, 1 << 18, 1 << 30
#: Bytes of a range that one task writes.
RANGE_BYTES = 1 << 27

_PART = ("old_shard", "block", "part")
_ORDER = ("h", "doc_id", "size")


def fewest_moves(supply: list[int], capacity: list[int]) -> dict[tuple[int, int], int]:
    """Amounts (old, new) of a minimum-cost flow by successive shortest paths; as much is asked for as there is.

    An amount costs nothing if old and new number agree, else 1 a byte.
    """
    if sum(supply) != sum(capacity):
        raise ValueError("capacities must sum to the sizes")
    n, m = len(supply), len(capacity)
    source, sink = n + m, n + m + 1
    to: list[int] = []
    left: list[int] = []
    cost: list[int] = []
    out: list[list[int]] = [[] for _ in range(n + m + 2)]

    def arc(a: int, b: int, most: int, price: int) -> None:
        for x, y, c, p in ((a, b, most, price), (b, a, 0, -price)):
            out[x].append(len(to))
            to.append(y)
            left.append(c)
            cost.append(p)

    for i, x in enumerate(supply):
        arc(source, i, x, 0)
        for j in range(m):
            arc(i, n + j, x, int(i != j))
    for j, x in enumerate(capacity):
        arc(n + j, sink, x, 0)
    while True:
        # Bellman-Ford with a queue; the graph has under a hundred nodes
        far, by = [None] * (n + m + 2), [-1] * (n + m + 2)
        far[source], queue = 0, [source]
        while queue:
            after = []
            for a in queue:
                for e in out[a]:
                    if left[e] and (far[to[e]] is None or far[a] + cost[e] < far[to[e]]):
                        far[to[e]], by[to[e]] = far[a] + cost[e], e
                        after.append(to[e])
            queue = list(dict.fromkeys(after))
        if far[sink] is None:
            break
        path, at = [], sink
        while at != source:
            path.append(by[at])
            at = to[by[at] ^ 1]
        much = min(left[e] for e in path)
        for e in path:
            left[e] -= much
            left[e ^ 1] += much
    moves = {}
    for i in range(n):
        for e in out[i]:
            if not e & 1 and n <= to[e] < n + m and left[e ^ 1]:
                moves[i, to[e] - n] = left[e ^ 1]
    return moves


def _text() -> Column:
    return F.coalesce(F.col("text").cast("string"), F.lit(""))


def by_text(shards: int) -> Column:
    """A shard by a hash of the text."""
    return F.pmod(F.xxhash64(_text()), F.lit(shards)).cast("int")


def _numbers(lies_in: Column) -> list[Column]:
    """(doc_id, size, text_crc32, h, old_shard) of a row."""
    text = _text()
    return [F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("h"), lies_in.cast("int").alias("old_shard")]


def store(docs: DataFrame, folder: str, shards: int = OLD_SHARDS) -> DataFrame:
    """Writes docs to a store by a hash of the text, in ranges of a shard, and returns it as stored."""
    spark = docs.sparkSession
    total = docs.agg(F.coalesce(F.sum(F.octet_length(_text())), F.lit(0)).alias("n")).first().n
    rows = docs.withColumn("__shard", by_text(shards)).repartitionByRange(max(partitions(spark), total // RANGE_BYTES), "__shard", F.xxhash64(_text()), "doc_id")
    with shuffles_freed(spark):
        rows.write.mode("overwrite").option("compression", "zstd").partitionBy("__shard").parquet(folder)
    return stored(docs.sparkSession, folder, docs.schema)


def stored(spark: SparkSession, folder: str, schema: StructType) -> DataFrame:
    """A store's rows, with __shard."""
    return spark.read.schema(StructType([*schema.fields, StructField("__shard", IntegerType())])).parquet(folder)


def _block(each: int) -> Column:
    return F.pmod(F.shiftright("h", 12), F.lit(each)).cast("int")


def _in_parts(rows: DataFrame, each: int, big: DataFrame) -> DataFrame:
    """Adds block and part."""
    cut = F.coalesce("cut", F.lit(1))
    rows = rows.withColumn("block", _block(each)).join(F.broadcast(big), ["old_shard", "block"], "left")
    return rows.withColumn("part", F.when(cut > 1, F.pmod(F.xxhash64("doc_id", "size"), cut)).otherwise(F.lit(0)).cast("int")).drop("cut")


def _middle() -> Column:
    """Of a row, in bytes from the start of its part."""
    return F.sum("size").over(Window.partitionBy(*_PART).orderBy(*_ORDER).rowsBetween(Window.unboundedPreceding, 0)) - F.col("size") / 2


def _target() -> Column:
    return F.col("targets")[F.size(F.filter("ends", lambda e: e <= F.col("middle")))]


def _dealt(docs: DataFrame, lies_in: Column, old_shards: int, shards: int, work: Workspace) -> tuple[DataFrame, DataFrame, DataFrame, int, int]:
    """Rows without their texts with shard and rank in their part; cuts of parts; cut blocks; blocks a shard; bytes."""
    spark = docs.sparkSession
    rows = work.save(docs.select(*_numbers(lies_in)), "rows")
    total = rows.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("n")).first().n
    blocks = min(max(BLOCKS, total // BLOCK_BYTES), BLOCKS_AT_MOST)
    each = max(1, blocks // old_shards)
    # a block above twice its even share is cut; there are at most as many parts as blocks and half as many again
    share = max(1, 2 * total // blocks)
    big = rows.groupBy("old_shard", _block(each).alias("block")).agg(F.ceil(F.sum("size") / F.lit(share)).alias("cut")).where("cut > 1")
    big = spark.createDataFrame(big.collect(), "old_shard int, block int, cut long")
    in_part = Window.partitionBy(*_PART).orderBy(*_ORDER)
    parted = work.save(_in_parts(rows, each, big).select("*", F.row_number().over(in_part).alias("rank"), _middle().alias("middle")).drop("h"), "parted")
    work.drop("rows")

    sizes = sorted(map(tuple, parted.groupBy(*_PART).agg(F.sum("size").alias("n")).collect()))
    supply = [0] * old_shards
    for old, _, _, n in sizes:
        supply[old] += n
    moves = fewest_moves(supply, [total // shards + (k < total % shards) for k in range(shards)])
    laid = {}
    for old in range(old_shards):
        targets = [(j, n) for (i, j), n in sorted(moves.items(), key=lambda x: (x[0][0], x[0][0] != x[0][1], x[0][1])) if i == old]
        laid[old] = ([j for j, _ in targets], list(accumulate(n for _, n in targets)))
    # each part with its cuts inside; most have none
    at, cuts = defaultdict(int), []
    for old, block, part, n in sizes:
        targets, ends = laid[old]
        first, last = bisect_right(ends, at[old]), min(bisect_right(ends, at[old] + n - 1), len(ends) - 1)
        cuts.append((old, block, part, targets[first : last + 1], [float(e - at[old]) for e in ends[first:last]]))
        at[old] += n
    cuts = spark.createDataFrame(cuts, "old_shard int, block int, part int, targets array<int>, ends array<double>")
    return parted.join(F.broadcast(cuts), list(_PART)).withColumn("shard", _target()).drop("targets", "ends", "middle"), cuts, big, each, total


def _placed(dealt: DataFrame) -> DataFrame:
    """(doc_id, size, text_crc32, old_shard, shard, slot) by the order of parts in a shard and of ranks in a part."""
    pieces = dealt.groupBy("shard", *_PART).agg(F.min("rank").alias("first"), F.count("*").alias("n")).collect()
    base, before = [], defaultdict(int)
    for r in sorted(pieces):
        base.append((r.shard, r.old_shard, r.block, r.part, before[r.shard] - r.first))
        before[r.shard] += r.n
    bases = dealt.sparkSession.createDataFrame(base, "shard int, old_shard int, block int, part int, base long")
    return dealt.join(F.broadcast(bases), ["shard", *_PART]).select("doc_id", "size", "text_crc32", "old_shard", "shard", (F.col("base") + F.col("rank")).alias("slot"))


def _lies_in(docs: DataFrame, old_shards: int) -> Column:
    """The shard of a stored row; of others the one that `store` would put them in."""
    return F.col("__shard") if "__shard" in docs.columns else by_text(old_shards)


def plan(docs: DataFrame, old_shards: int = OLD_SHARDS, shards: int = SHARDS) -> DataFrame:
    """(doc_id, size, text_crc32, old_shard, shard, slot)."""
    return _placed(_dealt(docs, _lies_in(docs, old_shards), old_shards, shards, Workspace(docs.sparkSession, "resharding"))[0])


def _affected(planned: DataFrame) -> DataFrame:
    """Shards that gain or lose a row."""
    return planned.where("old_shard != shard").select(F.explode(F.array("old_shard", "shard")).alias("shard")).distinct()


def resharded(docs: DataFrame, folder: str | None = None, old_shards: int = OLD_SHARDS, shards: int = SHARDS) -> DataFrame:
    """Reshards a store, or docs once they are stored: writes the affected shards to the folder, or one of its own; gives
    what `plan` gives.

    The rows of written shards are numbered as read back from there; the others stay where they are.
    """
    spark = docs.sparkSession
    work = Workspace(spark, "resharding")
    folder = folder or f"{work.path}/shards"
    if "__shard" not in docs.columns:
        docs = store(docs, f"{work.path}/old", old_shards)
    plain = [c for c in docs.columns if c != "__shard"]
    lies_in = F.col("__shard")
    dealt, cuts, big, each, total = _dealt(docs, lies_in, old_shards, shards, work)
    affected = sorted(r.shard for r in _affected(dealt).collect())
    held = docs.select(F.struct(*[F.col(f"`{c}`") for c in plain]).alias("row"), *_numbers(lies_in))
    rows = _in_parts(held, each, big).join(F.broadcast(cuts), list(_PART))
    uncut = rows.where(F.size("targets") == 1).withColumn("shard", F.col("targets")[0])
    cut = rows.where(F.size("targets") > 1).withColumn("middle", _middle()).withColumn("shard", _target()).drop("middle")
    going = uncut.unionByName(cut).where(F.col("shard").isin(affected))
    going = going.repartitionByRange(max(partitions(spark), total // RANGE_BYTES), "shard", *_PART, *_ORDER).sortWithinPartitions("shard", *_PART, *_ORDER)
    going = going.select("row.*", F.col("old_shard").alias("__old"), F.col("shard").alias("__shard"))
    with shuffles_freed(spark):
        going.write.mode("overwrite").option("compression", "zstd").partitionBy("__shard").parquet(folder)

    back = spark.read.schema(StructType([*docs.select(*[F.col(f"`{c}`") for c in plain]).schema.fields, StructField("__old", IntegerType()), StructField("__shard", IntegerType())])).parquet(folder)
    back = _in_parts(back.select(*_numbers(F.col("__old")), F.col("__shard").alias("shard")), each, big)
    back = back.withColumn("rank", F.row_number().over(Window.partitionBy("shard", *_PART).orderBy(*_ORDER))).drop("h")
    return _placed(work.save(back.unionByName(dealt.where(~F.col("shard").isin(affected))), "placed"))


def rewrite(docs: DataFrame, planned: DataFrame, folder: str) -> DataFrame:
    """Writes the shards that gain or lose a row, partitioned by shard, and returns (shard, n_rows) of those written.

    Rows of one doc_id, size and checksum are counted off on both sides, so that each goes to one place.
    """
    key = ("doc_id", "size", "text_crc32")
    nth = F.row_number().over(Window.partitionBy(*(f"__{c}" for c in key)).orderBy(F.lit(0)))
    ours = docs.select(F.struct("*").alias("row"), *(c.alias(f"__{n}") for n, c in zip(key, _numbers(F.lit(0))))).withColumn("__nth", nth)
    where = planned.select(*(F.col(c).alias(f"__{c}") for c in (*key, "shard", "slot"))).withColumn("__nth", nth)
    where = where.join(F.broadcast(_affected(planned).withColumnRenamed("shard", "__shard")), "__shard")
    on = [ours[c].eqNullSafe(where[c]) for c in (*(f"__{c}" for c in key), "__nth")]
    rows = ours.join(where, on).select("row.*", "__shard", "__slot")
    rows.repartition("__shard", F.floor(F.col("__slot") / 100_000)).sortWithinPartitions("__shard", "__slot").write.mode("overwrite").partitionBy("__shard").parquet(folder)
    return docs.sparkSession.read.parquet(folder).groupBy(F.col("__shard").alias("shard")).agg(F.count("*").alias("n_rows"))


def op9_resharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resharded(documents(spark, sf_dir)).select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "old_shard")
