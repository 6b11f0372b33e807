"""Near-duplicates by embeddings: pairs, clusters within a policy, their representatives and what stays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import stripped
from .batches import groups, local_roots
from .graph import components
from .skew import joined_to_groups
from .workspace import Workspace

TILE = 1024


class VectorError(ValueError):
    pass


def check_vectors(vectors: DataFrame, key: str = "id") -> None:
    """Raises if a vector is missing, of another length, not finite or zero, or if an id comes twice."""
    v = F.col("vector")
    bad = v.isNull() | F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) | ~F.exists(v, lambda x: x != 0)
    seen = vectors.agg(F.count("*").alias("n"), F.count_distinct(key).alias("ids"), F.count_if(F.coalesce(bad, F.lit(True))).alias("bad"), F.min(F.size("vector")).alias("least"), F.max(F.size("vector")).alias("most")).first()
    if seen.n and (seen.bad or seen.least != seen.most or seen.ids != seen.n):
        raise VectorError(f"{seen.bad} unusable vectors, lengths {seen.least} to {seen.most}, {seen.n - seen.ids} repeated ids")


Tile = tuple[np.ndarray, np.ndarray, list]
_PACKED = "unit long, tile int, ids binary, policies array<string>, vectors binary"


def _products(x: Tile, y: Tile | None, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(row of x, row of y, cosine) of similar rows of two tiles, or of one (each pair once, the lesser id first)."""
    (ids, left, _), (others, right, _) = x, y or x
    for at in range(0, len(left), 256):
        product = left[at : at + 256] @ right.T
        a, b = np.nonzero(product >= threshold)
        s = product[a, b]
        a += at
        if y is None:
            keep = ids[a] < others[b]
            a, b, s = a[keep], b[keep], s[keep]
        yield a, b, s


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each tile of a stream sorted by (unit, tile), with its unit vectors end to end."""
    for table in groups(batches, 2):
        ids = table.column("id").to_numpy()
        x = table.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(ids), -1)
        x = x / np.linalg.norm(x, axis=1)[:, None]
        place = [pa.array([table.column(c)[0].as_py()], t) for c, t in (("unit", pa.int64()), ("tile", pa.int32()))]
        held = [pa.array([ids.astype(np.int64).tobytes()], pa.binary()), pa.array([table.column("policy").to_pylist()], pa.list_(pa.string())), pa.array([x.tobytes()], pa.binary())]
        yield pa.RecordBatch.from_arrays([*place, *held], ["unit", "tile", "ids", "policies", "vectors"])


def _tile_pairs(vectors: DataFrame, work: Workspace, meet: bool) -> DataFrame:
    """A row for each tile of (id, policy, vector, unit, tiles) and, if they meet, for each two tiles of a unit.

    Tiles are written once, a row each, and partitions of them are read against each other where they lie: a cartesian
    product shuffles nothing, so that no more than the rows themselves is shuffled or written, however many tiles there are.
    """
    dealt = vectors.select("unit", F.pmod(F.xxhash64("id"), F.col("tiles")).cast("int").alias("tile"), "id", "policy", "vector")
    tiles = work.save(dealt.repartition("unit", "tile").sortWithinPartitions("unit", "tile").mapInArrow(_packed, _PACKED), "tiles")
    held = ("ids", "policies", "vectors")
    lone = tiles.select(*held, *[F.lit(None).cast(tiles.schema[c].dataType).alias(f"{c}2") for c in held])
    if not meet:
        return lone
    others = tiles.select(F.col("unit").alias("unit2"), F.col("tile").alias("tile2"), *[F.col(c).alias(f"{c}2") for c in held])
    both = tiles.join(others.hint("shuffle_replicate_nl"), (F.col("unit") == F.col("unit2")) & (F.col("tile") < F.col("tile2")))
    return lone.unionByName(both.select(*lone.columns))


def _read_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Tile, Tile | None]]:
    """The tiles of each row of `_tile_pairs`; the second is none where a tile is alone."""
    for batch in batches:
        for k in range(batch.num_rows):
            ids, policies, vectors, *second = (c[k] for c in batch.columns)
            yield _tile(ids, policies, vectors), _tile(second[0], second[1], second[2]) if second[0].is_valid else None


def _tile(ids: pa.Scalar, policies: pa.Scalar, vectors: pa.Scalar) -> Tile:
    ids = np.frombuffer(ids.as_buffer(), np.int64)
    return ids, np.frombuffer(vectors.as_buffer(), np.float64).reshape(len(ids), -1), policies.as_py()


def _plain(vectors: DataFrame) -> DataFrame:
    return vectors.select(F.col("id").cast("long"), "policy", F.col("vector").cast("array<double>").alias("vector"))


def similar_pairs(vectors: DataFrame, threshold: float, tile: int = TILE, across: bool = False) -> DataFrame:
    """(a, b, policy_a, policy_b, similarity), a below b, of all vectors with a cosine of threshold or more.

    Rows of (id long, policy string, vector) are dealt to tiles of about tile rows; a task multiplies two tiles at a time.
    So the exact join costs products of whole matrices, and a worker holds two tiles however many rows there are. With
    across, only pairs of different policies leave a task.
    """
    tiles = max(1, -(-vectors.count() // tile))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x, y in _read_pairs(batches):
            left, right = x[0], (y or x)[0]
            policy, policy2 = np.array(x[2], object), np.array((y or x)[2], object)
            for a, b, s in _products(x, y, threshold):
                if across:
                    a, b, s = (v[policy[a] != policy2[b]] for v in (a, b, s))
                turn = left[a] > right[b]
                ends = [(np.where(turn, right[b], left[a])), np.where(turn, left[a], right[b])]
                named = [np.where(turn, policy2[b], policy[a]), np.where(turn, policy[a], policy2[b])]
                yield pa.RecordBatch.from_arrays([*map(pa.array, ends), *(pa.array(v, pa.string()) for v in named), pa.array(s)], ["a", "b", "policy_a", "policy_b", "similarity"])

    dealt = _plain(vectors).withColumns({"unit": F.lit(0).cast("long"), "tiles": F.lit(tiles)})
    return _tile_pairs(dealt, Workspace(vectors.sparkSession, "pairs"), tiles > 1).mapInArrow(rows, "a long, b long, policy_a string, policy_b string, similarity double")


def cross_policy(pairs: DataFrame) -> DataFrame:
    """Pairs of different policies, which are told but never merged."""
    return pairs.where("policy_a != policy_b").select("a", "b", F.array_sort(F.array("policy_a", "policy_b")).alias("policies"), "similarity")


def clusters(pairs: DataFrame, work: Workspace) -> DataFrame:
    """(id, cluster) of records linked within their policy; cluster is the least id. Single records are left out."""
    return components(pairs.where("policy_a = policy_b").select("a", "b"), work).withColumnRenamed("component", "cluster")


#: Links that a task of `policy_clusters` holds before it cuts them to a forest.
LINKS = 1 << 20


def _forest(links: list[np.ndarray]) -> np.ndarray:
    """Links (2, n) between ids, cut to as many as span what they join."""
    ends = np.concatenate([np.empty((2, 0), np.int64), *links], 1)
    ids, place = np.unique(ends, return_inverse=True)
    root = local_roots(len(ids), *place.reshape(2, -1))
    some = np.flatnonzero(root != np.arange(len(ids)))
    return np.stack([ids[some], ids[root[some]]])


def policy_clusters(vectors: DataFrame, threshold: float, work: Workspace, tile: int = TILE) -> DataFrame:
    """`clusters` from the vectors: tiles are of one policy, and a task sends the links that span what it found, not its pairs."""
    plain = _plain(vectors).where("policy IS NOT NULL")
    # the least id of a policy stands for it
    sizes = work.save(plain.groupBy("policy").agg(F.count("*").alias("many"), F.min("id").alias("unit")), "policies")
    most = sizes.agg(F.coalesce(F.max("many"), F.lit(0))).first()[0]
    dealt = joined_to_groups(plain, sizes, "policy").withColumn("tiles", F.ceil(F.col("many") / F.lit(tile)).cast("int"))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        told = lambda links: pa.RecordBatch.from_arrays([pa.array(links[0]), pa.array(links[1])], ["a", "b"])
        for x, y in _read_pairs(batches):
            left, right = x[0], (y or x)[0]
            off = 0 if y is None else len(left)
            ids = left if y is None else np.concatenate([left, right])
            found = [np.empty((2, 0), np.int64)]
            for a, b, _ in _products(x, y, threshold):
                root = local_roots(len(ids), a, b + off)
                some = np.flatnonzero(root != np.arange(len(ids)))
                found.append(np.stack([some, root[some]]))
            held.append(ids[np.concatenate(found, 1)])
            n += held[-1].shape[1]
            if n >= LINKS:
                held = [_forest(held)]
                n = held[0].shape[1]
                if n >= LINKS // 2:
                    yield told(held[0])
                    held, n = [], 0
        yield told(_forest(held))

    return components(_tile_pairs(dealt, work, most > tile).mapInArrow(rows, "a long, b long"), work).withColumnRenamed("component", "cluster")


def _rank() -> Column:
    """The best score wins (none is the lowest), then the shortest prompt, then the least id."""
    return F.struct((-F.coalesce(F.col("score").cast("double"), F.lit(-float("inf")))).alias("s"), F.length(stripped(F.col("prompt"))).alias("n"), F.col("id"))


def duplicates(members: DataFrame) -> DataFrame:
    """(cluster, id, representative_id) of rows (id, cluster, prompt, score) that aren't their cluster's representative."""
    best = members.groupBy("cluster").agg(F.min_by("id", _rank()).alias("representative_id"), F.count("*").alias("many"))
    return joined_to_groups(members.select("cluster", "id"), best, "cluster").where("id != representative_id").select("cluster", "id", "representative_id")


def representatives(gone: DataFrame) -> DataFrame:
    """For a report: representative_id and duplicate_ids of each cluster, from what `duplicates` gives."""
    return gone.groupBy("cluster", "representative_id").agg(F.array_sort(F.collect_list("id")).alias("duplicate_ids"))


def retained(records: DataFrame, gone: DataFrame) -> DataFrame:
    """Records that aren't the duplicate of a representative."""
    return records.join(gone.select("id"), "id", "left_anti")


def first_of_each(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Exact duplicates by id: the first in order stays."""
    return rows.withColumn("__n", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where("__n = 1").drop("__n")
