"""Token ids as canonical length-limited Huffman code in files with blocks and bit-offset checkpoints.

1. Texts are encoded once, dealt to buckets of ascending doc_id and kept as 16-bit ids (`tokenize`).
2. Global counts of ids give code lengths by package-merge, so no code exceeds the table's width (`code_lengths`).
3. Each slice of a bucket becomes files (`write_files`); a block of BLOCK ids decodes on its own, and every STEP ids the
   bit offset is noted, so that a decoder follows all checkpoints of a block side by side with one table (`decode_block`).
4. The files are read back with Spark's binary reader (`read_files`). They stay if the caller names a folder.

Ids are those of the tokenizers library as it is loaded; the string of an added token is that token.

Null or empty texts hold the end id alone; rows without a doc_id come first; repeated rows are documents of their own;
an empty table makes no file. Other columns are ignored.
"""

from __future__ import annotations

import io
import json
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .order import bucket_bounds
from .tokens import WORD_BPE, encoder
from .workspace import Workspace, documents, partitions

MAGIC, BLOCK, STEP, FILE_IDS = b"SWHUFF1\n", 1 << 16, 128, 8 << 20
END_ID = 1


def code_lengths(counts: np.ndarray, limit: int) -> np.ndarray:
    """Optimal lengths of at most limit bits for the symbols with a count, by package-merge; 0 for the others."""
    lengths = np.zeros(len(counts), np.uint8)
    order = np.flatnonzero(counts)
    order = order[np.argsort(counts[order], kind="stable")]
    n = len(order)
    if n > 1 << limit:
        raise ValueError("more symbols than codes")
    if n < 2:
        lengths[order] = 1
        return lengths
    weights = counts[order].astype(np.int64)
    merged, leaf = weights, [np.ones(n, bool)]
    for _ in range(limit - 1):
        pairs = merged[: len(merged) // 2 * 2].reshape(-1, 2).sum(1)
        both = np.concatenate([weights, pairs])
        at = np.argsort(both, kind="stable")
        merged = both[at]
        leaf.append(at < n)
    take = 2 * n - 2
    for flags in reversed(leaf):
        leaves = int(flags[:take].sum())
        lengths[order[:leaves]] += 1
        take = 2 * (take - leaves)
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes in order of length, then symbol."""
    codes = np.zeros(len(lengths), np.uint32)
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    if len(order):
        long = lengths[order].astype(np.int64)
        top = int(long[-1])
        starts = np.concatenate([[0], np.cumsum(np.left_shift(1, top - long))[:-1]])
        codes[order] = starts >> (top - long)
    return codes


def decode_table(lengths: np.ndarray) -> tuple[int, np.ndarray, np.ndarray]:
    """Width, and for each value of so many bits the symbol and the length of its code."""
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    width = int(lengths.max(initial=1))
    spread = np.left_shift(1, width - lengths[order].astype(np.int64))
    symbols, long = np.zeros(1 << width, np.uint16), np.ones(1 << width, np.uint8)
    symbols[: spread.sum()] = np.repeat(order, spread)
    long[: spread.sum()] = np.repeat(lengths[order], spread)
    return width, symbols, long


def encode_block(ids: np.ndarray, lengths: np.ndarray, codes: np.ndarray) -> tuple[bytes, np.ndarray, int]:
    """Payload of 32-bit big-endian words, bit offsets of each STEP-th id, and the bits in all."""
    long = lengths[ids].astype(np.int64)
    ends = np.cumsum(long)
    at = ends - long
    bits = int(ends[-1]) if len(ids) else 0
    words = (bits + 31) // 32 + 2
    value = codes[ids].astype(np.uint64) << (64 - long - (at & 31)).astype(np.uint64)
    first = at >> 5
    # the codes in a word share no bit, so that their sum below 2**32 is exact in double precision
    out = np.bincount(first, (value >> np.uint64(32)).astype(np.float64), words)
    out += np.bincount(first + 1, (value & np.uint64(0xFFFFFFFF)).astype(np.float64), words)
    return out.astype(">u4").tobytes(), at[::STEP].astype("<u4"), bits


def decode_block(payload: bytes, offsets: np.ndarray, n: int, table: tuple[int, np.ndarray, np.ndarray]) -> np.ndarray:
    """All checkpoints advance together, an id each at a time."""
    width, symbols, long = table
    words = np.frombuffer(payload, ">u4").astype(np.uint64)
    pairs = (words[:-1] << np.uint64(32)) | words[1:]
    at = offsets.astype(np.int64)
    out = np.zeros((STEP, len(at)), np.uint16)
    last = len(pairs) - 1
    for k in range(min(STEP, n)):
        word = np.minimum(at >> 5, last)
        seen = ((pairs[word] << (at & 31).astype(np.uint64)) >> np.uint64(64 - width)).astype(np.int64)
        out[k] = symbols[seen]
        at += long[seen]
    return out.T.reshape(-1)[:n]


def pack_file(doc_ids: list, sizes: np.ndarray, ids: np.ndarray, lengths: np.ndarray, codes: np.ndarray, place: list) -> bytes:
    """A whole file: magic, length of the head, head (JSON), then sections: documents, code lengths, blocks, payload."""
    blocks, payload, steps = [], io.BytesIO(), []
    for start in range(0, len(ids), BLOCK):
        data, offsets, bits = encode_block(part := ids[start : start + BLOCK], lengths, codes)
        blocks.append((payload.tell(), len(data), len(part), bits))
        payload.write(data)
        steps.append(offsets)
    sections = {
        "docs": np.array([0 if x is None else x for x in doc_ids], "<i8").tobytes(),
        "null": np.packbits(np.array([x is None for x in doc_ids], bool)).tobytes(),
        "sizes": sizes.astype("<u4").tobytes(),
        "lengths": zlib.compress(lengths.tobytes()),
        "blocks": np.array(blocks, "<u8").tobytes(),
        "steps": b"".join(x.tobytes() for x in steps),
        "payload": payload.getvalue(),
    }
    head = json.dumps({"place": place, "n_docs": len(doc_ids), "n_ids": len(ids), "step": STEP, "sections": {k: len(v) for k, v in sections.items()}}).encode()
    return b"".join([MAGIC, struct.pack("<I", len(head)), head, *sections.values()])


def unpack_file(data: bytes) -> tuple[dict, list, np.ndarray, np.ndarray]:
    """Head, doc_ids, sizes and ids of a whole file."""
    if data[: len(MAGIC)] != MAGIC:
        raise ValueError("not a file of token ids")
    (size,) = struct.unpack_from("<I", data, len(MAGIC))
    at = len(MAGIC) + 4 + size
    head, parts = json.loads(data[len(MAGIC) + 4 : at]), {}
    for k, v in head["sections"].items():
        parts[k] = data[at : at + v]
        at += v
    table = decode_table(np.frombuffer(zlib.decompress(parts["lengths"]), np.uint8))
    steps, out, used = np.frombuffer(parts["steps"], "<u4"), [], 0
    for start, long, n, _ in np.frombuffer(parts["blocks"], "<u8").reshape(-1, 4).astype(np.int64).tolist():
        some = -(-n // STEP)
        out.append(decode_block(parts["payload"][start : start + long], steps[used : used + some], n, table))
        used += some
    ids = np.concatenate(out) if out else np.empty(0, np.uint16)
    docs = np.frombuffer(parts["docs"], "<i8").tolist()
    null = np.unpackbits(np.frombuffer(parts["null"], np.uint8))[: len(docs)]
    return head, [None if x else y for x, y in zip(null, docs)], np.frombuffer(parts["sizes"], "<u4").astype(np.int64), ids


def tokenize(docs: DataFrame, vocabulary: str = WORD_BPE, end_id: int = END_ID) -> DataFrame:
    """(doc_id, bucket, n, ids): 16-bit ids with end_id, compressed; buckets ascend by doc_id and are sorted in themselves."""
    spark = docs.sparkSession
    bounds = bucket_bounds(docs, "doc_id", partitions(spark))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        squeeze, end = zstandard.ZstdCompressor(level=1), np.array([end_id], "<u2").tobytes()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                ids = [x + end for x in encoder(vocabulary).encode(some.column(1).to_pylist())]
                keys = some.column(0).to_pylist()
                bucket = [0 if x is None else int(np.searchsorted(bounds, x, "right")) for x in keys]
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(bucket, pa.int32()), pa.array([len(x) // 2 for x in ids], pa.int64()), pa.array([squeeze.compress(x) for x in ids], pa.binary())], ["doc_id", "bucket", "n", "ids"])

    made = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").alias("text")).mapInArrow(rows, "doc_id long, bucket int, n long, ids binary")
    return made.repartitionById(len(bounds) + 1, F.col("bucket")).sortWithinPartitions("bucket", F.col("doc_id").asc_nulls_first(), "n", "ids")


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list, list[np.ndarray]]]:
    """Runs of rows of one bucket, of FILE_IDS ids or a little more."""
    import zstandard

    squeeze, keys, held, many, bucket = zstandard.ZstdDecompressor(), [], [], 0, None
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            some = batch.slice(at, 256)
            for key, b, n, ids in zip(*(some.column(x).to_pylist() for x in ("doc_id", "bucket", "n", "ids"))):
                if held and (b != bucket or many >= FILE_IDS):
                    yield bucket, keys, held
                    keys, held, many = [], [], 0
                bucket, many = b, many + n
                keys.append(key)
                held.append(np.frombuffer(squeeze.decompress(ids, max_output_size=2 * n), "<u2"))
    if held:
        yield bucket, keys, held


def count_ids(tokens: DataFrame) -> np.ndarray:
    """Counts over all documents; a task sums its own before they are shuffled. As long as the vocabulary at most."""

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << 16, np.int64)
        for _, _, held in _slices(batches):
            total += np.bincount(np.concatenate(held), minlength=1 << 16)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(total[some], pa.int64())], ["id", "n"])

    out = np.zeros(1 << 16, np.int64)
    for r in tokens.mapInArrow(counts, "id int, n long").groupBy("id").agg(F.sum("n").alias("n")).collect():
        out[r.id] = r.n
    return out[: int(out.nonzero()[0].max(initial=0)) + 1]


def write_files(tokens: DataFrame, lengths: np.ndarray, folder: str) -> DataFrame:
    """Writes the files and returns (file, bucket, first, last, n_docs, n_ids); a repeated task writes the same files again.

    first and last are the doc_ids of a file's ends. The name tells equal files apart by task and number, which stay as
    they are when a task runs again.
    """
    codes, long = canonical_codes(lengths), lengths

    def files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs
        from pyspark import TaskContext

        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        task = TaskContext.get().partitionId()
        for nth, (bucket, keys, held) in enumerate(_slices(batches)):
            ids = np.concatenate(held)
            first, last = (-(1 << 63) if x is None else x for x in (keys[0], keys[-1]))
            data = pack_file(keys, np.array([len(x) for x in held]), ids, long, codes, [bucket, first, zlib.crc32(ids.tobytes()), len(ids)])
            name = f"{bucket:08d}-{first + (1 << 63):020d}-{task:06d}-{nth:06d}-{zlib.crc32(data):08x}.swt"
            held_back = f"{root}/.{name}.{uuid.uuid4().hex}.part"  # attempts of one task don't share a stream
            with store.open_output_stream(held_back) as out:
                out.write(data)
            store.move(held_back, f"{root}/{name}")
            yield pa.RecordBatch.from_pylist([{"file": name, "bucket": bucket, "first": first, "last": last, "n_docs": len(keys), "n_ids": len(ids)}], pa.schema([("file", pa.string()), ("bucket", pa.int32()), ("first", pa.int64()), ("last", pa.int64()), ("n_docs", pa.int64()), ("n_ids", pa.int64())]))

    return tokens.mapInArrow(files, "file string, bucket int, first long, last long, n_docs long, n_ids long")


def read_files(spark: SparkSession, folder: str) -> DataFrame:
    """(bucket, file, ordinal, doc_id, n_tokens, before, ids_crc32) decoded from the files; before: ids of earlier documents in the file."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                head, docs, sizes, ids = unpack_file(data.as_py())
                ends = np.cumsum(sizes)
                wide = ids.astype("<u4").tobytes()
                crc = [zlib.crc32(wide[4 * (e - n) : 4 * e]) for e, n in zip(ends.tolist(), sizes.tolist())]
                k = len(docs)
                yield pa.RecordBatch.from_arrays([pa.array([head["place"][0]] * k, pa.int32()), pa.array([path.rsplit("/", 1)[-1]] * k), pa.array(docs, pa.int64()), pa.array(sizes), pa.array(ends - sizes), pa.array(crc, pa.int64())], ["bucket", "file", "doc_id", "n_tokens", "before", "ids_crc32"])

    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.swt").load(folder).select("path", "content")
    return found.mapInArrow(rows, "bucket int, file string, doc_id long, n_tokens long, before long, ids_crc32 long")


def token_output(docs: DataFrame, vocabulary: str = WORD_BPE, end_id: int = END_ID, folder: str | None = None) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, file), read from the files that it writes.

    The files stay in folder (a URI that all executors reach), which should have no others; without one they are kept
    until the driver's process ends.
    """
    spark = docs.sparkSession
    work = Workspace(spark, "token-output")
    tokens = work.save(tokenize(docs, vocabulary, end_id), "ids")
    counts = count_ids(tokens)
    limit = max(16, int(np.count_nonzero(counts)).bit_length() + 2)
    folder = folder or f"{work.path}/files"
    index = work.save(write_files(tokens, code_lengths(counts, limit), folder), "index")
    work.drop("ids")
    # one sum for each bucket, which are as many as the shuffle's partitions
    total, base = 0, []
    for r in index.groupBy("bucket").agg(F.sum("n_ids").alias("n")).orderBy("bucket").collect():
        base.append((r.bucket, total))
        total += r.n
    bases = spark.createDataFrame(base, "bucket int, base long")
    from pyspark.sql import Window

    within = Window.partitionBy("bucket").orderBy("first", "last", "file").rowsBetween(Window.unboundedPreceding, -1)
    starts = index.join(F.broadcast(bases), "bucket").select("file", (F.col("base") + F.coalesce(F.sum("n_ids").over(within), F.lit(0))).alias("base"))
    if not base:
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long, file string")
    found = read_files(spark, folder)
    return found.join(starts, "file").select("doc_id", (F.col("base") + F.col("before")).alias("start"), "n_tokens", "ids_crc32", "file")


def op1_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_output(documents(spark, sf_dir))
