"""Quality by compression: two zstandard dictionaries and a calibrated difference of sizes.

One dictionary is trained on texts labelled 1, one on texts labelled 0. A text is compressed with each, in pieces of PIECE
bytes so that the dictionaries count along its whole length. The score is a logistic function of the normalised
difference of the two sizes, (size with bad - size with good) / the larger, and of the better compressed share of the
text; it is fitted on labelled texts that the dictionaries haven't seen, weighted to the classes' numbers.

Training takes at most SAMPLE texts of a class for the dictionaries and as many for the fit, in order of a hash of
doc_id, none above LONGEST bytes; scores cover every document. doc_ids whose crc32 mod 3 is 1 are held out. Null counts as
empty and both get the score of a text of no difference; missing labels give a constant score; a label for an unknown
doc_id is ignored, two labels count twice; an empty table gives no rows. Only the text is an input of the score.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .caches import claim
from .workspace import Workspace, documents, ship

SAMPLE, LONGEST, PIECE, DICTIONARY, LEVEL = 900, 1 << 16, 2048, 110_000, 3
_compressors: dict[bytes, tuple] = {}


def dictionary(texts: list[bytes], size: int = DICTIONARY) -> bytes:
    """A trained dictionary; with too few texts to train, their own bytes serve as one."""
    import zstandard

    try:
        return zstandard.train_dictionary(size, texts, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b"".join(texts)[:size] or b"\0" * 8


def compressors(good: bytes, bad: bytes) -> tuple:
    """Of both dictionaries, made once in a worker; asked for by batch, as its key is a digest of all their bytes."""
    import zstandard

    claim("compressors", _compressors.clear)
    if (key := b"".join(hashlib.blake2b(x).digest() for x in (good, bad))) not in _compressors:
        made = []
        for data in (good, bad):
            d = zstandard.ZstdCompressionDict(data)
            d.precompute_compress(level=LEVEL)
            made.append(zstandard.ZstdCompressor(dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False))
        _compressors[key] = tuple(made)
    return _compressors[key]


def features(text: str | None, pair: tuple) -> tuple[float, float]:
    """Normalised difference of the compressed sizes, and the share that the good dictionary leaves."""
    data = (text or "").encode("utf-8", "surrogatepass")
    if not data:
        return 0.0, 0.0
    with_good, with_bad = pair
    a = b = 0
    for at in range(0, len(data), PIECE):
        piece = data[at : at + PIECE]
        a += len(with_good.compress(piece))
        b += len(with_bad.compress(piece))
    return (b - a) / max(a, b), a / (len(data) + 20)


def fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-3, rounds: int = 40) -> np.ndarray:
    """Logistic regression by Newton's method with halved steps where one is too long."""
    x = np.c_[np.ones(len(x)), x]
    weight = weight / weight.sum()

    def loss(w: np.ndarray) -> float:
        z = x @ w
        return float((weight * (np.logaddexp(0, z) - y * z)).sum() + ridge / 1000 * (w[1:] ** 2).sum())

    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -500, 500)))
        pull = np.r_[0.0, np.full(len(w) - 1, ridge / 500)]
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(pull + 1e-12), x.T @ (weight * (y - p)) - pull * w)
        size = 1.0
        while size > 1e-4 and loss(w + size * step) > loss(w):
            size /= 2
        w = w + size * step
        if np.abs(size * step).max() < 1e-9:
            break
    return w


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame) -> tuple[bytes, bytes, np.ndarray]:
    """Dictionaries and weights from the labelled rows that aren't held out."""
    work = Workspace(docs.sparkSession, "quality")
    named = labels.where(F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id"))).select("doc_id", "quality")
    sizes = docs.select("doc_id", F.octet_length(F.col("text").cast("string")).alias("size")).where("size > 0")
    rows = work.save(sizes.join(named, "doc_id").withColumn("h", F.xxhash64("doc_id")), "labelled")
    many = {r.quality: r.n for r in rows.groupBy("quality").agg(F.count("*").alias("n")).collect()}
    # which rows to take is settled on numbers alone; then so many texts at most are fetched
    short = rows.where(F.col("size") <= LONGEST).groupBy("doc_id", "quality", "h").agg(F.lit(1))
    chosen = [r for label in (1, 0) for r in short.where(F.col("quality") == label).orderBy("h", "doc_id").select("h", "doc_id", "quality").limit(2 * SAMPLE).collect()]
    ids = docs.sparkSession.createDataFrame(sorted({(r.doc_id,) for r in chosen}), "doc_id long")
    found = docs.join(F.broadcast(ids), "doc_id").where(F.octet_length(F.col("text").cast("string")).between(1, LONGEST)).groupBy("doc_id").agg(F.min(F.col("text").cast("string")).alias("text"))
    by_id = {r.doc_id: r.text.encode("utf-8", "surrogatepass") for r in found.collect()}
    work.drop("labelled")
    made, rest = {}, {}
    for label in (1, 0):
        texts = [by_id[r.doc_id] for r in chosen if r.quality == label and r.doc_id in by_id]
        cut = min(SAMPLE, (len(texts) + 1) // 2)
        made[label], rest[label] = dictionary(texts[:cut]), texts[cut:]
    if not all(rest.values()):
        share = (many.get(1, 0) + 1) / (sum(many.values()) + 2)
        return made[1], made[0], np.array([np.log(share / (1 - share)), 0.0, 0.0])
    pair = compressors(made[1], made[0])
    x = np.array([features(t.decode("utf-8", "surrogatepass"), pair) for label in (1, 0) for t in rest[label]])
    y = np.repeat([1.0, 0.0], [len(rest[1]), len(rest[0])])
    return made[1], made[0], fit(x, y, np.where(y == 1, many[1] / len(rest[1]), many[0] / len(rest[0])))


def scored(docs: DataFrame, model: tuple[bytes, bytes, np.ndarray], column: str = "score") -> DataFrame:
    """docs with the score in a further column; it takes the place of one of that name in any case."""
    good, bad, w = model
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() != column.lower()])
    names = docs.columns
    at = names.index("text")
    schema = pa.float64()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pair = compressors(good, bad)
            x = np.array([features(t, pair) for t in batch.column(at).to_pylist()]).reshape(-1, 2)
            score = 1 / (1 + np.exp(-np.clip(w[0] + x @ w[1:], -500, 500)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score, schema)], [*names, column])

    from pyspark.sql.types import DoubleType, StructType

    return docs.mapInArrow(rows, StructType([*docs.schema.fields]).add(column, DoubleType()))


def accepted(docs: DataFrame, labels: DataFrame, least: float = 0.5) -> DataFrame:
    """The rows of docs that the classifier doesn't reject."""
    name = "__quality_score"
    return scored(docs, train(docs, labels), name).where(F.col(name) >= least).drop(name)


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    docs = documents(spark, sf_dir).select("doc_id", F.col("text").cast("string").alias("text"))
    out = scored(docs, train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
