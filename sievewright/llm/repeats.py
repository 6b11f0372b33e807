"""Bytes of repeated strings, by a distributed merge of sorted suffixes that knows their common prefixes.

A string of LENGTH bytes is looked at through its anchor: the first of the least hashes of its GRAM-byte pieces. Equal
strings have equal anchors, so that only suffixes that start at an anchor are sorted, and of these only such whose piece
occurs more than once; neighbouring strings share an anchor and form a run. No repeat is lost by this.

1. `anchors`: (piece hash, document, place of the run). Pieces that occur once are dropped.
2. `suffix_runs`: each task sorts its suffixes, from the anchor to the end of the run's last string, and sends them
   front-coded: the length of the prefix shared with the suffix before, and the rest. The part left of the anchor goes
   along. Buckets are ranges of suffixes, between splitters from a sample (`splitters`), which matter for balance alone.
3. `LoserTree` merges the runs of a bucket; suffixes are only compared from where their common prefix with the last
   output ends, and each comes out with the length of the prefix that it shares with the one before.
4. `repeated_strings` reads repeats off these lengths: strings that begin d bytes left of their anchors are equal if the
   suffixes share LENGTH - d bytes, the least of the lengths between them, and the left parts the last d, which their
   order from right to left tells in the same way. Bytes decide, not hashes.
5. A piece that occurs above GROUP times would be a group too large for a task. Each string of such runs is a suffix of
   its own (a run of one string that begins at its anchor), in buckets that may end anywhere; equal ones are one record for
   each sorted run, and prefixes of LENGTH bytes tell the repeats as before.

The key of a document is its doc_id and a hash of its text, so that repeated rows repeat each other and rows that share an
id don't mix. Null texts count as empty; texts below LENGTH bytes keep all; an empty table gives no rows. Other
columns are ignored.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.skew import joined_to_groups
from .caches import claim
from .workspace import Workspace, documents, partitions

#: GROUP suffixes of 300 bytes, and ALONE strings, are some 50 MB each in a worker.
LENGTH, GRAM, GROUP = 200, 100, 100_000
CHUNK, BATCH, FLUSH, ALONE = 1 << 18, 4096, 25_000, 100_000
#: Suffixes of a bucket, about, and of the sample that splits them.
BUCKET, SAMPLE = 200_000, 20_000
_SPAN = LENGTH - GRAM + 1
_BASE = 0x9E3779B97F4A7C15
_powers: list[tuple[np.ndarray, np.ndarray]] = []


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2**64."""
    if not _powers or len(_powers[0][0]) < n:
        size = max(n, CHUNK + (CHUNK >> 2))
        made = []
        for x in (_BASE, pow(_BASE, -1, 1 << 64)):
            row = np.full(size, x, np.uint64)
            row[0] = 1
            made.append(np.cumprod(row, dtype=np.uint64))
        _powers[:] = [(made[0], made[1])]
    return _powers[0]


def hash_sums(x: np.ndarray) -> np.ndarray:
    claim("powers", _powers.clear)
    sums = np.zeros(len(x) + 1, np.uint64)
    np.cumsum((x.astype(np.uint64) + np.uint64(1)) * _tables(len(x) + 1)[0][: len(x)], out=sums[1:])
    return sums


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def text_anchors(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(piece hash, text, place of the anchor, first and last string of its run), places within each text."""
    x = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(sizes)
    if len(x) < LENGTH:
        return (np.empty(0, np.uint64), *[np.empty(0, np.int64)] * 4)
    sums, n = hash_sums(x), len(x) - GRAM + 1
    pieces = _mixed((sums[GRAM:] - sums[:n]) * _tables(len(sums))[1][:n])
    bits = np.uint64((1 << int(len(x)).bit_length()) - 1)
    low = (pieces & ~bits) | np.arange(len(pieces), dtype=np.uint64)
    span = 1
    while 2 * span <= _SPAN:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    low = np.minimum(low[: len(low) - (_SPAN - span)], low[_SPAN - span :])
    inside = np.zeros(len(low) + 1, np.int8)
    big = sizes >= LENGTH
    np.add.at(inside, (ends - sizes)[big], 1)
    np.add.at(inside, (ends - LENGTH + 1)[big], -1)
    at = np.flatnonzero(np.cumsum(inside[:-1]) > 0)
    if not len(at):
        return (np.empty(0, np.uint64), *[np.empty(0, np.int64)] * 4)
    anchor = (low[at] & bits).astype(np.int64)
    owner = np.searchsorted(ends, at, "right")
    new = np.flatnonzero(np.r_[True, (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1])])
    last = np.r_[new[1:], len(at)] - 1
    text = owner[new]
    base = (ends - sizes)[text]
    return pieces[anchor[new]], text, anchor[new] - base, at[new] - base, at[last] - base


def packed_place(anchor: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    return (anchor << 16) | ((anchor - first) << 8) | (last - first)


def unpacked_place(place: int) -> tuple[int, int, int]:
    """Anchor, first and last string."""
    anchor = place >> 16
    first = anchor - ((place >> 8) & 255)
    return anchor, first, first + (place & 255)


def common_prefix(a: bytes, b: bytes, known: int = 0) -> int:
    """Length of the common prefix, of which known bytes aren't looked at."""
    n = min(len(a), len(b))
    if a[known:n] == b[known:n]:
        return n
    low, high = known, n
    while high - low > 1:
        mid = (low + high) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid
    return low


def front_coded(records: list[tuple[bytes, bytes, int, int, int]]) -> bytes:
    """A sorted run of (suffix, left part, doc_id, text hash, first string) in a compressed blob."""
    import zstandard

    shared, rest, before = [], [], b""
    for suffix, *_ in records:
        n = common_prefix(before, suffix)
        shared.append(n)
        rest.append(suffix[n:])
        before = suffix
    lefts = [r[1] for r in records]
    numbers = np.array([r[2:] for r in records], "<i8")
    head = np.array([len(records)], "<u4")
    sizes = [np.array(v, "<u2") for v in (shared, [len(r) for r in rest], [len(x) for x in lefts])]
    return zstandard.ZstdCompressor(level=1).compress(b"".join([head.tobytes(), *[s.tobytes() for s in sizes], numbers.tobytes(), *rest, *lefts]))


def decoded(blob: bytes) -> Iterator[tuple[int, bytes, tuple[bytes, int, int, int]]]:
    """(shared prefix, suffix, (left part, doc_id, text hash, first string)) of a run, in order."""
    import zstandard

    data = zstandard.ZstdDecompressor().decompress(blob)
    n = int(np.frombuffer(data, "<u4", 1)[0])
    shared, rest, left = np.frombuffer(data, "<u2", 3 * n, 4).reshape(3, n).tolist()
    numbers = np.frombuffer(data, "<i8", 3 * n, 4 + 6 * n).reshape(n, 3).tolist()
    at = 4 + 6 * n + 24 * n
    other, before = at + sum(rest), b""
    for k in range(n):
        before = before[: shared[k]] + data[at : at + rest[k]]
        at += rest[k]
        yield shared[k], before, (data[other : other + left[k]], *numbers[k])
        other += left[k]


class LoserTree:
    """Merges sorted runs; each entry holds the length of its common prefix with the last output."""

    def __init__(self, runs: Iterable[Iterator[tuple[int, bytes, tuple]]]):
        self.runs = list(runs)
        self.k = 1 << max(0, (len(self.runs) - 1).bit_length())
        self.now: list[bytes | None] = [None] * self.k
        self.load: list[tuple | None] = [None] * self.k
        self.shared = [0] * self.k
        for i in range(len(self.runs)):
            self._advance(i)
            self.shared[i] = 0
        self.losers = [0] * self.k
        level = list(range(self.k))
        node = self.k
        while len(level) > 1:
            node //= 2
            played = [self._play(a, b) for a, b in zip(level[::2], level[1::2])]
            self.losers[node : node + len(played)] = [b for _, b in played]
            level = [a for a, _ in played]
        self.winner = level[0]

    def _advance(self, i: int) -> None:
        self.shared[i], self.now[i], self.load[i] = next(self.runs[i], (0, None, None))

    def _play(self, a: int, b: int) -> tuple[int, int]:
        """Winner and loser. The one that shares more with the last output comes first; else only what is beyond counts."""
        x, y = self.now[a], self.now[b]
        if y is None:
            return a, b
        if x is None:
            return b, a
        p, q = self.shared[a], self.shared[b]
        if p != q:
            return (a, b) if p > q else (b, a)
        n = common_prefix(x, y, p)
        if n == len(x) or (n < len(y) and x[n] < y[n]):
            self.shared[b] = n
            return a, b
        self.shared[a] = n
        return b, a

    def __iter__(self) -> Iterator[tuple[int, bytes, tuple]]:
        """(prefix shared with the output before, suffix, what came along)."""
        while self.runs and self.now[self.winner] is not None:
            i = self.winner
            yield self.shared[i], self.now[i], self.load[i]
            self._advance(i)
            node = (self.k + i) // 2
            while node:
                i, self.losers[node] = self._play(i, self.losers[node])
                node //= 2
            self.winner = i


Member = tuple[bytes, tuple[bytes, int, int, int]]


def repeated_strings(members: list[Member], shared: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(doc_id, text hash, start, end) of the bytes that repeated strings cover.

    members are whole groups, each of one piece, in merged order; shared has the prefix of each with the one before, below
    GRAM where a group begins.
    """
    n, ahead = len(members), np.array(shared)
    group = np.cumsum(ahead < GRAM)
    keys = [g.to_bytes(4, "big") + load[0][::-1] for g, (_, load) in zip(group.tolist(), members)]
    order = sorted(range(n), key=keys.__getitem__)
    behind = np.array([-1, *(common_prefix(keys[a], keys[b]) - 4 for a, b in zip(order, order[1:]))])
    left = np.array([len(x) - 4 for x in keys])
    least = LENGTH - np.array([len(suffix) for suffix, _ in members])
    found, back = np.zeros((n, _SPAN), bool), np.empty(n, np.int64)
    for d in range(_SPAN):
        some = np.flatnonzero((least <= d) & (left >= d))
        if len(some) < 2:
            continue
        back[order] = np.cumsum(behind < d)
        kind = np.cumsum(ahead < LENGTH - d)[some] * (n + 1) + back[some]
        by = np.argsort(kind)
        same = np.diff(kind[by]) == 0
        found[some[by[1:][same]], d] = True
        found[some[by[:-1][same]], d] = True
    edges = np.diff(found.astype(np.int8), axis=1, prepend=0, append=0)
    who, near = np.nonzero(edges == 1)
    far = np.nonzero(edges == -1)[1] - 1
    numbers = np.array([load[1:] for _, load in members], np.int64).reshape(-1, 3)[who]
    anchor = numbers[:, 2] + left[who]
    return numbers[:, 0], numbers[:, 1], anchor - far, anchor - near + LENGTH


def stretches(strings: list[tuple[int, int, int]]) -> tuple[np.ndarray, ...]:
    """(doc_id, text hash, start, end) of what strings (doc_id, text hash, start) cover."""
    a = np.array(strings, np.int64).reshape(-1, 3)
    a = a[np.lexsort((a[:, 2], a[:, 1], a[:, 0]))]
    new = np.flatnonzero(np.r_[True, (np.diff(a[:, :2], axis=0) != 0).any(1) | (np.diff(a[:, 2]) > LENGTH)][: len(a)])
    last = np.r_[new[1:], len(a)][: len(new)] - 1
    return a[new, 0], a[new, 1], a[new, 2], a[last, 2] + LENGTH


NO_ID = -(1 << 63)


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"), F.xxhash64(text).alias("h"), text.alias("text"))


def _byte_chunks(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, list[bytes]]]:
    """Rows of a batch by about CHUNK bytes of text: the first row's number, and the texts."""
    start, some, size = 0, [], 0
    for k, t in enumerate(batch.column(column).to_pylist()):
        some.append(t.encode("utf-8", "surrogatepass"))
        size += len(some[-1])
        if size >= CHUNK:
            yield start, some
            start, some, size = k + 1, [], 0
    if some:
        yield start, some


def anchors(keyed: DataFrame) -> DataFrame:
    """(piece, doc, h, place) of every run."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, h = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for start, texts in _byte_chunks(batch, 2):
                piece, text, anchor, first, last = text_anchors(texts)
                yield pa.RecordBatch.from_arrays([pa.array(piece.view(np.int64)), pa.array(doc[start + text]), pa.array(h[start + text]), pa.array(packed_place(anchor, first, last))], ["piece", "doc", "h", "place"])

    return keyed.mapInArrow(rows, "piece long, doc long, h long, place long")


def _suffix(data: bytes, place: int) -> tuple[bytes, bytes, int]:
    """Suffix of a run, what is left of its anchor, and the first string."""
    anchor, first, last = unpacked_place(place)
    return data[anchor : last + LENGTH], data[first:anchor], first


def splitters(keyed: DataFrame, kept: DataFrame, buckets: int) -> tuple[list[bytes], list[bytes]]:
    """Where buckets of suffixes end, and those of single strings, from a sample of about SAMPLE runs of each."""
    sums = kept.agg(*[F.coalesce(F.sum(F.size(c)), F.lit(0)).alias(c) for c in ("places", "alone")]).first()

    def picked(column: str) -> Column:
        one_in = F.lit(max(1, sums[column] // SAMPLE))
        return F.filter(column, lambda p: F.pmod(F.xxhash64(F.col("doc"), F.col("h"), p), one_in) == 0).alias(column)

    some = kept.select("doc", "h", picked("places"), picked("alone")).where("size(places) + size(alone) > 0")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, places, alone in zip(*(c.to_pylist() for c in batch.columns)):
                data = text.encode("utf-8", "surrogatepass")
                out += [(False, _suffix(data, p)[0][:GRAM]) for p in places]
                out += [(True, data[s : s + LENGTH]) for p in alone for s in unpacked_place(p)[1:]]
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], t) for k, t in enumerate((pa.bool_(), pa.binary()))], ["alone", "prefix"])

    found = keyed.join(F.broadcast(some), ["doc", "h"]).select("text", "places", "alone").mapInArrow(rows, "alone boolean, prefix binary").collect()
    out = []
    for kind in (False, True):
        sample = sorted(bytes(r.prefix) for r in found if r.alone == kind)
        out.append(sorted({sample[len(sample) * k // buckets] for k in range(1, buckets)} if sample else ()))
    return out[0], out[1]


def suffix_runs(chosen: DataFrame, ends: list[bytes], ends_alone: list[bytes]) -> DataFrame:
    """(bucket, run, doc, h, start, end) from rows of doc, h, text, places and places whose strings stand alone.

    A row is a front-coded run of a bucket, or a stretch that repeats within a run. Buckets of single strings come after
    the others.
    """
    names = ["bucket", "run", "doc", "h", "start", "end"]

    def coded(records: list[tuple], bounds: list[bytes], base: int) -> pa.RecordBatch:
        cuts = [0, *(bisect_left(records, (x,)) for x in bounds), len(records)]
        some = [(base + k, front_coded(records[a:b])) for k, (a, b) in enumerate(zip(cuts, cuts[1:])) if a < b]
        return pa.RecordBatch.from_arrays([pa.array([k for k, _ in some], pa.int32()), pa.array([x for _, x in some], pa.binary()), *[pa.nulls(len(some), pa.int64())] * 4], names)

    def suffixes(held: list[tuple]) -> Iterator[pa.RecordBatch]:
        held.sort()
        yield coded(held, ends, 0)

    def strings(held: list[tuple]) -> Iterator[pa.RecordBatch]:
        """Of equal strings one is sent, with a mark if they are told here."""
        held.sort()
        sent, told, k = [], [], 0
        while k < len(held):
            first = k
            while k < len(held) and held[k][0] == held[first][0]:
                k += 1
            string, _, *place = held[first]
            sent.append((string, b"told" if k - first > 1 else b"", *place))
            if k - first > 1:
                told += [r[2:] for r in held[first:k]]
        yield coded(sent, ends_alone, len(ends) + 1)
        places = stretches(told)
        n = len(places[0])
        yield pa.RecordBatch.from_arrays([pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary()), *map(pa.array, places)], names)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        lone: list[tuple] = []
        for batch in batches:
            for doc, h, text, places, alone in zip(*(c.to_pylist() for c in batch.columns)):
                data = text.encode("utf-8", "surrogatepass")
                for place in {*places}:
                    suffix, before, first = _suffix(data, place)
                    held.append((suffix, before, doc, h, first))
                    if len(held) >= FLUSH:
                        yield from suffixes(held)
                        held = []
                for place in {*alone}:
                    _, first, last = unpacked_place(place)
                    lone += [(data[s : s + LENGTH], b"", doc, h, s) for s in range(first, last + 1)]
                    if len(lone) >= ALONE:
                        yield from strings(lone)
                        lone = []
        if held:
            yield from suffixes(held)
        if lone:
            yield from strings(lone)

    return chosen.mapInArrow(rows, "bucket int, run binary, doc long, h long, start long, end long")


def merged(runs: DataFrame, ends: list[bytes], ends_alone: list[bytes]) -> DataFrame:
    """(doc, h, start, end) of repeated stretches, from the front-coded runs."""
    grouped = len(ends) + 1

    def of_groups(blobs: list[bytes]) -> Iterator[tuple[np.ndarray, ...]]:
        members: list[Member] = []
        shared: list[int] = []
        begin = 0
        for n, suffix, load in LoserTree(map(decoded, blobs)):
            if n < GRAM:
                if len(members) - begin == 1:  # a group of one has no repeat
                    members.pop()
                    shared.pop()
                if len(members) >= BATCH:
                    yield repeated_strings(members, shared)
                    members, shared = [], []
                begin = len(members)
            members.append((suffix, load))
            shared.append(n)
        if len(members) - begin == 1:
            members.pop()
            shared.pop()
        if members:
            yield repeated_strings(members, shared)

    def of_strings(blobs: list[bytes]) -> Iterator[tuple[np.ndarray, ...]]:
        found: list[tuple[int, int, int]] = []
        before: tuple | None = None
        for n, _, (mark, *place) in LoserTree(map(decoded, blobs)):
            if n >= LENGTH:
                found += [tuple(x) for told, x in (before, (mark, place)) if not told]
                mark = b"told"
            before = (mark, place)
            if len(found) >= ALONE:
                yield stretches(found)
                found = []
        if found:
            yield stretches(found)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blobs = defaultdict(list)
        for batch in batches:
            for bucket, run in zip(*(c.to_pylist() for c in batch.columns)):
                blobs[bucket].append(run)
        for bucket in sorted(blobs):
            for columns in (of_groups if bucket < grouped else of_strings)(blobs.pop(bucket)):
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["doc", "h", "start", "end"])

    dealt = runs.where("run IS NOT NULL").select("bucket", "run").repartitionById(grouped + len(ends_alone) + 1, F.col("bucket"))
    return dealt.mapInArrow(rows, "doc long, h long, start long, end long")


def repeated_stretches(docs: DataFrame, work: Workspace, group: int = GROUP) -> DataFrame:
    """(doc, h, spans): for each document with repeats, its stretches (start, end), which may overlap."""
    spark = docs.sparkSession
    keyed = _keyed(docs)
    found = work.save(anchors(keyed.where(F.octet_length("text") >= LENGTH)), "anchors")
    often = work.save(found.groupBy("piece").agg(F.count("*").alias("many")).where("many > 1"), "often")
    # rows that repeat an id and a text have the same places, which are kept once
    of = lambda yes: F.collect_set(F.when(yes, F.col("place")))
    kept = joined_to_groups(found, often, "piece").groupBy("doc", "h").agg(of(F.col("many") <= group).alias("places"), of(F.col("many") > group).alias("alone"))
    kept = work.save(kept, "kept")
    work.drop("anchors", "often")
    many = kept.agg(F.coalesce(F.sum(F.size("places") + F.size("alone")), F.lit(0))).first()[0]
    ends, ends_alone = splitters(keyed, kept, max(partitions(spark, 2), many // BUCKET))
    runs = work.save(suffix_runs(keyed.join(kept, ["doc", "h"]).select("doc", "h", "text", "places", "alone"), ends, ends_alone), "runs")
    work.drop("kept")
    told = runs.where("start IS NOT NULL").select("doc", "h", "start", "end")
    spans = merged(runs, ends, ends_alone).unionByName(told).groupBy("doc", "h").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    spans = work.save(spans, "spans")
    work.drop("runs")
    return spans


def without(data: bytes, spans: list[tuple[int, int]]) -> tuple[bytes, int]:
    """What is left, and the number of maximal removed stretches."""
    out, at, many = [], -1, 0
    for start, end in sorted(spans):
        if start > at:
            out.append(data[max(at, 0) : start])
            many += 1
        at = max(at, end)
    out.append(data[max(at, 0) :])
    return b"".join(out), many


def repeats_removed(docs: DataFrame, group: int = GROUP, with_kept: bool = False) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) and, if asked for, kept (the bytes that are left)."""
    spark = docs.sparkSession
    spans = repeated_stretches(docs, Workspace(spark, "repeats"), group)
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc, text, found in zip(*(c.to_pylist() for c in batch.columns)):
                data = text.encode("utf-8", "surrogatepass")
                kept, many = without(data, [(s["start"], s["end"]) for s in found]) if found else (data, 0)
                out.append((None if doc == NO_ID else doc, len(data), len(data) - len(kept), many, hashlib.sha256(kept).hexdigest(), kept))
            columns = [pa.array(c, t) for c, t in zip(zip(*out) if out else [()] * 6, [pa.int64()] * 4 + [pa.string(), pa.binary()])]
            yield pa.RecordBatch.from_arrays(columns[: 6 if with_kept else 5], [*names, *["kept"] * with_kept])

    joined = _keyed(docs).join(spans, ["doc", "h"], "left").select("doc", "text", "spans")
    return joined.mapInArrow(rows, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", kept binary" if with_kept else ""))


def op5_repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats_removed(documents(spark, sf_dir))
