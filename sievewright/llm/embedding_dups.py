"""Near-duplicate embeddings: int8 tile products with error bounds, then full precision.

Vectors of a label are dealt to tiles of about TILE by hash; each pair of tiles is a unit of work. With a unit vector
x = s q + e (q in int8), the product of two differs from s s' q.q' by at most b = d + d' + d d' for d = |e|. A unit gets q, s
and d only (`rough_pairs`): a pair whose rounded product is at least the threshold plus b is a link, one below the threshold
less b is none. Rows of a unit with a pair in between meet there again in double precision, and only such pairs are
computed (`sure_pairs`). Integer products stay exact in single precision for EXACT components at a time. A unit returns
sums of links, a spanning forest and the rows to look at again, never its pairs. Equal vectors of a label are one class, so
a large group of copies costs one row.

Without an id, a label, or with a vector that is null, empty, zero or holds null or non-finite components, a row links
with nothing; vectors of different length don't link; repeated ids are rows of their own that share an id; an empty
table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.batches import groups, local_roots
from ..operators.graph import components
from ..operators.skew import joined_to_groups
from .workspace import Workspace, ship

THRESHOLD, TILE, EXACT = 0.93, 4096, 1000
#: Pairs of label and length whose table is broadcast, at most; more of them meet their rows by a shuffle.
SMALL = 10_000


def unit_rows(x: np.ndarray) -> np.ndarray:
    """Rows of length 1; the largest component is divided out first, so that no square over- or underflows."""
    x = x / np.abs(x).max(1)[:, None]
    return x / np.linalg.norm(x, axis=1)[:, None]


def quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 rows (as floats), scales and norms of what is lost, from unit rows."""
    scale = np.abs(x).max(1) / 127
    q = np.rint(x / scale[:, None])
    return q.astype(np.float32), scale, np.linalg.norm(x - q * scale[:, None], axis=1)


Rough = tuple[np.ndarray, np.ndarray, np.ndarray]


def rough_pairs(x: Rough, y: Rough | None, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(first, second, whether in doubt) of pairs that the bounds don't rule out; within x (first below second) if y is None."""
    (qx, sx, dx), (qy, sy, dy) = x, x if y is None else y
    fx, fy = qx.astype(np.float32), qy.astype(np.float32)
    for at in range(0, len(qx), 256):
        rows = slice(at, at + 256)
        product = sum((fx[rows, k : k + EXACT] @ fy[:, k : k + EXACT].T).astype(np.float64) for k in range(0, fx.shape[1], EXACT))
        product *= sx[rows, None] * sy[None, :]
        bound = dx[rows, None] + dy[None, :] + dx[rows, None] * dy[None, :] + 1e-9
        a, b = np.nonzero(product + bound >= threshold)
        doubt = product[a, b] - bound[a, b] < threshold
        a += at
        if y is None:
            a, b, doubt = (v[a < b] for v in (a, b, doubt))
        yield a, b, doubt


def sure_pairs(x: np.ndarray, y: np.ndarray, a: np.ndarray, b: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Of index pairs into unit rows x and y, those with a cosine of at least threshold."""
    keep = [np.einsum("ij,ij->i", x[a[k : k + 65_536]], y[b[k : k + 65_536]]) >= threshold for k in range(0, len(a), 65_536)]
    keep = np.concatenate([np.empty(0, bool), *keep])
    return a[keep], b[keep]


_FOUND = "rep long, links long, root long, unit long, i int, j int, tile int"


def _unit(table: pa.Table, threshold: float) -> dict[str, list]:
    """Of one pair of tiles: links of each class, counted in vectors, the forest, and classes with a pair in doubt.

    With vectors, pairs in doubt alone are looked at.
    """
    first = table.column("tile").to_numpy() == table.column("i").to_numpy()
    n = len(first)
    order = np.lexsort((table.column("rep").to_numpy(), ~first))
    ids, many, tile = (table.column(c).to_numpy()[order] for c in ("rep", "many", "tile"))
    q = np.frombuffer(b"".join(table.column("q").to_pylist()), np.int8).reshape(n, -1)[order]
    s, d = (table.column(c).to_numpy()[order] for c in ("s", "d"))
    unit, i, j = (table.column(c)[0].as_py() for c in ("unit", "i", "j"))
    k = n if i == j else int(first.sum())
    rough = (q[:k], s[:k], d[:k])
    x = None
    if "vector" in table.column_names:
        x = unit_rows(table.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(n, -1)[order])
    links, again, left, right = np.zeros(n, np.int64), np.zeros(n, bool), [], []
    if i == j or 0 < k < n:
        off = 0 if i == j else k
        for a, b, doubt in rough_pairs(rough, None if i == j else (q[k:], s[k:], d[k:]), threshold):
            if x is not None:
                a, b = sure_pairs(x, x[off:], a[doubt], b[doubt], threshold)
            else:
                again[a[doubt]] = again[b[doubt] + off] = True
                a, b = a[~doubt], b[~doubt]
            b = b + off
            links += np.bincount(a, many[b], n).astype(np.int64) + np.bincount(b, many[a], n).astype(np.int64)
            # a block's links are cut to a forest at once, so that no more than rows are held
            root = local_roots(n, a, b)
            some = np.flatnonzero(root != np.arange(n))
            left.append(some)
            right.append(root[some])
    rank = np.argsort(np.argsort(ids, kind="stable"), kind="stable")
    back = np.argsort(ids, kind="stable")
    a, b = (np.concatenate([np.empty(0, np.int64), *v]) for v in (left, right))
    root = ids[back[local_roots(n, rank[a], rank[b])[rank]]]
    some, m = links > 0, int(again.sum())
    told = [(ids[some], links[some], root[some], [None] * 4), (ids[again], [None] * m, [None] * m, (np.full(m, unit), np.full(m, i), np.full(m, j), tile[again]))]
    out: dict[str, list] = {c.split()[0]: [] for c in _FOUND.split(", ")}
    for who, many_links, to, place in told:
        size = len(who)
        for name, value in zip(out, (who, many_links, to, *place)):
            out[name] += [None] * size if value is None else np.asarray(value, object).tolist()
    return out


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, tile: int = TILE) -> DataFrame:
    """(vec_id, n_links, component_id, kept) from rows of vec_id, embedding and label."""
    spark = vectors.sparkSession
    work = Workspace(spark, "embedding-dups")
    part = F.col("vector")
    usable = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & part.isNotNull() & (F.size(part) > 0) & F.forall(part, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))) & F.exists(part, lambda v: v != 0)
    rows = vectors.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("vector")).withColumn("ok", F.coalesce(usable, F.lit(False)))
    good = rows.where("ok")
    classes = work.save(good.groupBy("label", "vector").agg(F.min("vec_id").alias("rep"), F.count("*").alias("many")).withColumn("vh", F.xxhash64("vector")), "classes")
    dim = F.size("vector").alias("dim")
    # unit: the least id of the label and length stands for both
    sizes = work.save(classes.groupBy("label", dim).agg(F.count("*").alias("in_all"), F.ceil(F.count("*") / F.lit(tile)).cast("int").alias("tiles"), F.min("rep").alias("unit")), "sizes")
    sizes = sizes.select(F.struct("label", "dim").alias("of"), "in_all", "tiles", "unit")

    def rounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("vector")
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            sizes, ends = np.diff(lists.offsets.to_numpy()), np.cumsum(np.diff(lists.offsets.to_numpy()))
            q, s, d = [b""] * len(sizes), np.zeros(len(sizes)), np.zeros(len(sizes))
            for n in np.unique(sizes).tolist():
                at = np.flatnonzero(sizes == n)
                made, s[at], d[at] = quantise(unit_rows(flat[(ends[at] - n)[:, None] + np.arange(n)]))
                for k, row in zip(at.tolist(), made):
                    q[k] = row.astype(np.int8).tobytes()
            yield pa.RecordBatch.from_arrays([batch.column("label"), batch.column("rep"), batch.column("many"), batch.column("vh"), pa.array(sizes, pa.int32()), pa.array(q, pa.binary()), pa.array(s), pa.array(d)], ["label", "rep", "many", "vh", "dim", "q", "s", "d"])

    label = classes.schema["label"].dataType.simpleString()
    small = work.save(classes.mapInArrow(rounded, f"label {label}, rep long, many long, vh long, dim int, q binary, s double, d double"), "rounded")
    tiled = joined_to_groups(small.withColumn("of", F.struct("label", "dim")), sizes, "of", "in_all").withColumn("tile", F.pmod(F.xxhash64("rep"), F.col("tiles")).cast("int"))
    units = tiled.select("unit", "tile", "rep", "many", "q", "s", "d", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("other"))
    units = units.select("unit", F.least("tile", "other").alias("i"), F.greatest("tile", "other").alias("j"), "tile", "rep", "many", "q", "s", "d")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = {"long": pa.int64(), "int": pa.int32()}
        for table in groups(batches, 3):
            yield pa.RecordBatch.from_pydict(_unit(table, threshold), pa.schema([(c.split()[0], types[c.split()[1]]) for c in _FOUND.split(", ")]))

    def dealt(df: DataFrame) -> DataFrame:
        return df.repartition("unit", "i", "j").sortWithinPartitions("unit", "i", "j").mapInArrow(run, _FOUND)

    found = work.save(dealt(units), "found")
    # where ids repeat, classes share a rep; a class that isn't in doubt itself then comes along, and has no pair in doubt
    doubt = found.where("unit IS NOT NULL").select("unit", "i", "j", "tile", "rep").distinct()
    whole = small.join(classes.select("label", "rep", "vh", "vector"), ["label", "rep", "vh"]).join(F.broadcast(sizes.select("of", "unit")) if sizes.count() <= SMALL else sizes.select("of", "unit"), F.col("of") == F.struct("label", "dim"))
    again = work.save(dealt(doubt.join(whole.select("unit", "rep", "many", "q", "s", "d", "vector"), ["unit", "rep"]).select("unit", "i", "j", "tile", "rep", "many", "q", "s", "d", "vector")), "again")
    found = found.where("links IS NOT NULL").unionByName(again.where("links IS NOT NULL"))
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    linked = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")), work)
    classed = classes.join(links, "rep", "left").join(linked, classes["rep"] == linked["id"], "left").select("label", "vector", (F.coalesce("links", F.lit(0)) + F.col("many") - 1).alias("n"), F.coalesce("component", "rep").alias("c"))
    done = good.join(classed, ["label", "vector"]).select("vec_id", F.col("n").alias("n_links"), F.col("c").alias("component_id"))
    rest = rows.where("NOT ok").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return done.unionByName(rest).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op3_embedding_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
