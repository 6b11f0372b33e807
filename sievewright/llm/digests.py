"""Improbable-feature digests of texts, compared by their Bloom filters.

Every window of WIDTH bytes has an entropy, kept in whole numbers; how rare its value is among all windows of all
documents ranks it (`entropy_counts`, one count for each of 1001 values). Of each run of RUN windows the first of the
least rank is noted, and a window noted by COMMON runs or more is a feature: an improbable one. Windows of almost no
entropy are never features. Distinct features go to filters of BITS bits, HASHES bits each and FEATURES features a
filter, chained in order of the text. Likeness of two filters is the share of common bits above what chance gives, of the
most that there can be; the shorter chain looks for its best partners in the longer, and they count by their bits.

Texts of fewer than LONG code points have all their windows of GRAM bytes as features besides, longer ones those with no
improbable window within GAP bytes; these grams fill filters of their own after the others. So texts of any two lengths
share a kind of features wherever they share a stretch. A text below GRAM bytes is a feature itself. Only the empty text has
none. Null
counts as empty, whose digest has no feature: two such are alike (1.0), and unlike all others (0.0). With one row, the
next document is the row itself; equal doc_ids follow each other by text; null doc_ids come last; an empty table gives
no rows. Other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .order import bucket_bounds, bucket_of
from .workspace import documents, partitions

WIDTH, RUN, COMMON, WEAK = 64, 64, 16, 100
BITS, HASHES, FEATURES = 2048, 5, 160
GRAM, CHUNK = 8, 1 << 18
#: Code points below which all grams count, and how far from a window, in bytes, they do in longer texts.
LONG, GAP = 1024, 512

_c = np.arange(WIDTH + 1)
_weight = np.rint(_c * np.log2(np.maximum(_c, 1)) * (1 << 20)).astype(np.int64)
#: What one more of a byte that is there c times adds to the sum of c log2 c.
_GAIN = np.diff(_weight, append=_weight[-1])
_FACTORS = np.random.default_rng(10).integers(0, 1 << 62, WIDTH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def window_entropies(x: np.ndarray) -> np.ndarray:
    """For each byte the entropy, in thousandths of the most, of the window that it ends; exact from byte WIDTH - 1 on."""
    n = len(x)
    before, after = np.zeros(n, np.uint8), np.zeros(n, np.uint8)
    for k in range(1, min(WIDTH, n)):
        same = (x[k:] == x[:-k]).view(np.uint8)
        before[k:] += same
        after[:-k] += same
    change = _GAIN[before]
    change[WIDTH:] -= _GAIN[after[:-WIDTH]]
    total = np.cumsum(change)
    most = WIDTH * int(np.log2(WIDTH)) << 20
    return ((most - total) * 1000 // most).astype(np.int16)


def _chunks(texts: list[bytes]) -> Iterator[list[int]]:
    """Runs of texts of about CHUNK bytes."""
    some, size = [], 0
    for k, t in enumerate(texts):
        some.append(k)
        size += len(t)
        if size >= CHUNK:
            yield some
            some, size = [], 0
    if some:
        yield some


def entropy_counts(docs: DataFrame) -> np.ndarray:
    """How many windows of all documents have each of the 1001 entropies."""

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1001, np.int64)
        for batch in batches:
            texts = [(t or "").encode("utf-8", "surrogatepass") for t in batch.column(0).to_pylist()]
            for some in _chunks(texts):
                x = np.frombuffer(b"".join(texts[k] for k in some), np.uint8)
                if not len(x):
                    continue
                ends = np.cumsum([len(texts[k]) for k in some])
                inside = np.ones(len(x), bool)
                for start, end in zip(np.r_[0, ends[:-1]].tolist(), ends.tolist()):
                    inside[start : min(end, start + WIDTH - 1)] = False
                total += np.bincount(window_entropies(x)[inside], minlength=1001)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(1001), pa.int32()), pa.array(total)], ["entropy", "n"])

    out = np.zeros(1001, np.int64)
    for r in docs.select(F.col("text").cast("string")).mapInArrow(counts, "entropy int, n long").groupBy("entropy").agg(F.sum("n").alias("n")).collect():
        out[r.entropy] = r.n
    return out


def ranks(counts: np.ndarray) -> np.ndarray:
    """Rank of each entropy: the rarest first; too low ones above all."""
    out = np.empty(1001, np.int64)
    out[np.lexsort((np.arange(1001), counts))] = np.arange(1001)
    out[: WEAK + 1] = 2000
    return out


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def _hashed(x: np.ndarray, ends: np.ndarray, width: int) -> np.ndarray:
    out = np.zeros(len(ends), np.uint64)
    for k in range(width):
        out += (x[ends - k].astype(np.uint64) + np.uint64(1)) * _FACTORS[k]
    return _mixed(out)


def _distinct(h: np.ndarray) -> np.ndarray:
    return h[np.sort(np.unique(h, return_index=True)[1])] if len(h) > 1 else h


def features(texts: list[str], rank: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """64-bit features of each text: improbable windows and grams, each kind in order, each once."""
    data = [t.encode("utf-8", "surrogatepass") for t in texts]
    none = np.empty(0, np.uint64)
    out = [(none, none)] * len(texts)
    long = []
    for k, b in enumerate(data):
        if len(b) >= GRAM:
            long.append(k)
        elif b:
            out[k] = none, np.array([int.from_bytes(hashlib.blake2b(b, digest_size=8).digest(), "little")], np.uint64)
    for some in _chunks([data[k] for k in long]):
        some = [long[k] for k in some]
        x = np.frombuffer(b"".join(data[k] for k in some), np.uint8)
        ends = np.cumsum([len(data[k]) for k in some])
        starts = ends - [len(data[k]) for k in some]
        key = (rank[window_entropies(x)] << 32) | np.arange(len(x))
        for s, e in zip(starts.tolist(), ends.tolist()):
            key[s : min(e, s + WIDTH - 1)] = 1 << 62
        span = 1
        while span < RUN:
            key[:-span] = np.minimum(key[:-span], key[span:])
            span *= 2
        owner = np.zeros(len(x), bool)
        for s, e in zip(starts.tolist(), ends.tolist()):
            owner[s + WIDTH - 1 : max(s + WIDTH - 1, e - RUN + 1)] = True
        low = key[owner & (key < (2000 << 32))] & 0xFFFFFFFF
        noted = np.bincount(low, minlength=len(x))
        at = np.flatnonzero(noted >= COMMON)
        hashes = _hashed(x, at, WIDTH)
        cuts = np.searchsorted(at, ends)
        for k, s, e, a, b in zip(some, starts.tolist(), ends.tolist(), np.r_[0, cuts[:-1]].tolist(), cuts.tolist()):
            lone = np.ones(e - s, bool)
            lone[: GRAM - 1] = False
            if len(texts[k]) >= LONG:
                for w in (at[a:b] - s).tolist():
                    lone[max(0, w - GAP) : w + GAP + 1] = False
            out[k] = _distinct(hashes[a:b]), _distinct(_hashed(x, np.flatnonzero(lone) + s, GRAM))
    return out


def filters(h: np.ndarray) -> np.ndarray:
    """A row of BITS bits for each FEATURES features."""
    n = -(-len(h) // FEATURES)
    bits = np.zeros(n * BITS, bool)
    base = np.arange(len(h)) // FEATURES * BITS
    for k in range(HASHES):
        bits[base + ((h >> np.uint64(11 * k)) & np.uint64(BITS - 1)).astype(np.int64)] = True
    return bits.reshape(n, BITS)


def chain(made: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The filters of a text's windows, then those of its grams."""
    return np.concatenate([filters(h) for h in made])


def fingerprint(bits: np.ndarray) -> str:
    return base64.b64encode(np.packbits(bits, axis=1).tobytes()).decode()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """0 to 1, symmetric."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    if len(a) > len(b):
        a, b = b, a
    a, b = a.astype(np.float32), b.astype(np.float32)
    both, x, y = (a @ b.T).astype(np.float64), a.sum(1, dtype=np.float64)[:, None], b.sum(1, dtype=np.float64)[None, :]
    chance, most = x * y / BITS, np.minimum(x, y)
    score = np.clip((both - chance) / np.maximum(most - chance, 1e-9), 0.0, 1.0)
    mine, theirs = float((score.max(1) * x[:, 0]).sum() / x.sum()), float((score.max(0) * y[0]).sum() / y.sum())
    return mine if len(a) < len(b) else (mine + theirs) / 2


def edited(text: str, following: str) -> str:
    cut = len(text) // 3
    return text[: len(text) - cut] + following[:cut]


def beside_next(docs: DataFrame) -> DataFrame:
    """(doc_id, text, guest) in partitions of descending doc_id; a guest ends each partition: the first row of the next.

    The last partition's guest is the first row of all. Only these rows are sent twice.
    """
    spark = docs.sparkSession
    bounds = bucket_bounds(docs, "doc_id", partitions(spark))
    rows = bucket_of(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")), "doc_id", bounds)
    tops = sorted((r.bucket, r.top) for r in rows.groupBy("bucket").agg(F.max("doc_id").alias("top")).collect())  # as many as partitions
    going = [(b, top, tops[(k + 1) % len(tops)][0]) for k, (b, top) in enumerate(tops)]
    going = spark.createDataFrame(going, "of int, top long, goes int")
    own = F.struct(F.col("bucket").alias("to"), F.lit(False).alias("guest"))
    guest = F.struct(F.col("goes").alias("to"), F.lit(True).alias("guest"))
    sent = rows.join(F.broadcast(going), F.col("bucket") == F.col("of")).select("doc_id", "text", F.explode(F.when(F.col("doc_id").eqNullSafe(F.col("top")), F.array(own, guest)).otherwise(F.array(own))).alias("at"))
    dealt = sent.select("doc_id", "text", F.col("at.to").alias("bucket"), F.col("at.guest").alias("guest")).repartitionById(len(bounds) + 1, F.col("bucket"))
    return dealt.sortWithinPartitions("guest", F.col("doc_id").desc_nulls_last(), "text").select("doc_id", "text", "guest")


def digests(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next)."""
    rank = ranks(entropy_counts(docs))

    def done(ids: list, texts: list[str]) -> pa.RecordBatch:
        """texts has the one after the last besides."""
        changed = [edited(t, u) for t, u in zip(texts, texts[1:])]
        made = [chain(h) for h in features([*texts, *changed], rank)]
        own, new = made[: len(texts)], made[len(texts) :]
        return pa.RecordBatch.from_pydict({
            "doc_id": pa.array(ids, pa.int64()), "n_chars": pa.array([len(t) for t in texts[:-1]], pa.int64()),
            "edited_sha256": [hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in changed],
            "fingerprint": [fingerprint(b) for b in own[:-1]], "edited_fingerprint": [fingerprint(b) for b in new],
            "near_edited": [likeness(a, b) for a, b in zip(own, new)], "near_next": [likeness(a, b) for a, b in zip(own, own[1:])],
        })

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, size = [], [], 0
        for batch in batches:
            for key, text, guest in zip(*(c.to_pylist() for c in batch.columns)):
                if len(texts) > len(ids):  # the end is a guest already
                    continue
                if guest:
                    texts.append(text)
                    continue
                if size > CHUNK:
                    yield done(ids, [*texts, text])
                    ids, texts, size = [], [], 0
                ids.append(key)
                texts.append(text)
                size += len(text)
        if ids:
            yield done(ids, texts)

    return beside_next(docs).mapInArrow(rows, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")


def op10_document_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(documents(spark, sf_dir))
