"""Best-fit packing with certified counts.

Pieces are dealt to partitions by a hash of their place in a written table, so that equal ones part, and packed by
best-fit decreasing. Dual-feasible functions give a lower bound for each partition's number of bins; where it is met, the
packing is certified and stays. Partitions with a gap set the pieces of their emptiest bins free; those of MERGED
partitions meet in one and are packed again, kept if that takes fewer bins, and so on until no gap or one partition is
left.

A document is its ids and END_ID; longer ones than CAPACITY are cut so that all pieces but the first are full. Null counts
as empty (one piece: the end id); repeated rows are documents of their own; an empty table gives no rows. Other columns
are ignored by the query and kept by `packed`.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.batches import groups
from .tokens import BYTE_BPE, encoder
from .workspace import Workspace, documents

CAPACITY, END_ID = 1024, 2
PARTITION, MERGED, FREED = 40_000, 16, 48
PIECE_COLUMNS = "doc_id long, piece int, start long, length long, ids_crc32 long"


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, int]:
    """Bin of each item and the number of bins; a bit for each residual that some open bin has finds the best at once."""
    bins = np.zeros(len(lengths), np.int64)
    open_by: list[list[int]] = [[] for _ in range(capacity + 1)]
    there, used = 0, 0
    order = np.argsort(-lengths, kind="stable")
    for k, n in zip(order.tolist(), lengths[order].tolist()):
        fits = there >> n
        if fits:
            room = n + (fits & -fits).bit_length() - 1
            b = open_by[room].pop()
            if not open_by[room]:
                there &= ~(1 << room)
            room -= n
        else:
            b, room, used = used, capacity - n, used + 1
        bins[k] = b
        if room:
            open_by[room].append(b)
            there |= 1 << room
    return bins, used


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """The best of two families of dual-feasible functions and their compositions."""
    count = np.bincount(lengths, minlength=capacity + 1)
    size = np.arange(capacity + 1)
    best = -(-int((count * size).sum()) // capacity)
    for cut in sorted({0, *np.unique(np.r_[1 : 33, 40 : capacity // 2 + 1 : 8, capacity // 2, capacity // 3]).tolist()}):
        # items above capacity - cut fill a bin, those below cut count nothing
        value = np.where(size > capacity - cut, capacity, np.where(size < cut, 0, size)) if cut else size
        best = max(best, -(-int((count * value).sum()) // capacity))
        for k in range(1, 9):
            whole = (k + 1) * value % capacity == 0
            # times capacity * k, to stay in whole numbers
            stepped = np.where(whole, value * k, (k + 1) * value // capacity * capacity)
            best = max(best, -(-int((count * stepped).sum()) // (capacity * k)))
    return best


def document_pieces(docs: DataFrame, vocabulary: str = BYTE_BPE, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False, kept: int | None = None) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) and, if asked for, ids (array of int); a worker keeps the ids of kept words."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = np.array([end_id], "<u2").tobytes()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some, out, held = batch.slice(at, 256), [], []
                for key, raw in zip(some.column(0).to_pylist(), encoder(vocabulary, kept=kept).encode(some.column(1).to_pylist())):
                    ids = np.frombuffer(raw + end, "<u2").astype("<u4")
                    first = (len(ids) - 1) % capacity + 1
                    wide = ids.tobytes()
                    for k, start in enumerate([0, *range(first, len(ids), capacity)]):
                        stop = first if not k else start + capacity
                        out.append((key, k, start, stop - start, zlib.crc32(wide[4 * start : 4 * stop])))
                        if with_ids:
                            held.append(ids[start:stop])
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
                columns = [pa.array(c, t) for c, t in zip(zip(*out), kinds)]
                if with_ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum([len(x) for x in held])], pa.int32()), pa.array(np.concatenate(held).astype(np.int32))))
                yield pa.RecordBatch.from_arrays(columns, [*names, *["ids"] * with_ids])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(rows, PIECE_COLUMNS + (", ids array<int>" if with_ids else ""))


def _repack(table: pa.Table, capacity: int, level: int, last: bool) -> pa.Table:
    """A partition packed: sequence_id and offset of each piece, and whether it is set free for the next level."""
    lengths = table.column("length").to_numpy()
    bins, used = best_fit_decreasing(lengths, capacity)
    if level:
        old, before = np.unique(table.column("sequence_id").to_numpy(), return_inverse=True)
        if len(old) <= used:
            bins, used = before.reshape(-1), len(old)
    gap = used - lower_bound(lengths, capacity)
    order = np.lexsort((np.arange(len(bins)), bins))
    ends = np.cumsum(lengths[order])
    full = np.bincount(bins, lengths, used).astype(np.int64)
    offset = np.empty(len(bins), np.int64)
    offset[order] = ends - lengths[order] - np.repeat(np.cumsum(full) - full, np.bincount(bins, minlength=used))
    free = np.zeros(used, bool)
    if gap > 0 and not last:
        free[np.argsort(full, kind="stable")[: max(FREED, 4 * gap)]] = True
    part = table.column("part")[0].as_py()
    made = {"sequence_id": (level << 56) | (part << 32) | bins, "offset": offset, "free": free[bins]}
    for name, value in made.items():
        table = table.set_column(table.column_names.index(name), name, pa.array(value))
    return table


def pack(pieces: DataFrame, work: Workspace, capacity: int = CAPACITY, spread: Column | None = None) -> DataFrame:
    """pieces, which have a column length of 1 to capacity, with sequence_id and offset.

    They are dealt by the hash spread, or by that of all their columns; then equal rows would all meet.
    """
    from pyspark.sql.types import BooleanType, LongType, StructField, StructType

    names = pieces.columns
    parts = max(1, -(-pieces.count() // PARTITION))
    every = [F.col(f"`{c}`") for c in names if c != "ids"]
    spread = F.xxhash64(*every) if spread is None else spread
    rows = pieces.select(F.pmod(spread, F.lit(parts)).cast("long").alias("part"), *[F.col(f"`{c}`") for c in names], F.lit(0).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset"), F.lit(False).alias("free"))
    schema = StructType([StructField("part", LongType()), *pieces.schema.fields, StructField("sequence_id", LongType()), StructField("offset", LongType()), StructField("free", BooleanType())])
    level, settled = 0, []
    while True:

        def repacked(batches: Iterator[pa.RecordBatch], level: int = level, last: bool = parts == 1) -> Iterator[pa.RecordBatch]:
            for table in groups(batches, 1):
                yield from _repack(table, capacity, level, last).to_batches(max_chunksize=10_000)

        order = [c for c in ("doc_id", "piece", "ids_crc32") if c in names]
        now = work.save(rows.repartition("part").sortWithinPartitions("part", *order).mapInArrow(repacked, schema), f"packed-{level}")
        settled.append(now.where("NOT free"))
        if parts == 1 or now.where("free").isEmpty():
            break
        # partitions whose pieces weren't certified meet
        rows, parts, level = now.where("free").withColumn("part", F.floor(F.col("part") / MERGED).cast("long")), -(-parts // MERGED), level + 1
    out = settled[0]
    for df in settled[1:]:
        out = out.unionByName(df)
    return out.drop("part", "free")


def packed(docs: DataFrame, vocabulary: str = BYTE_BPE, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False, kept: int | None = None) -> DataFrame:
    """Pieces of all documents with their places, and their ids if asked for. kept bounds what a worker keeps of words."""
    work = Workspace(docs.sparkSession, "packing")
    pieces = work.save(document_pieces(docs, vocabulary, capacity, end_id, with_ids, kept), "pieces")
    # a written row's place parts equal rows too, and is the same whenever a task runs again
    return pack(pieces, work, capacity, F.xxhash64("_metadata.file_path", "_metadata.row_index"))


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(documents(spark, sf_dir))
