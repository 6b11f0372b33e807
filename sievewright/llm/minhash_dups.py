r"""Near-duplicate documents by SetSketch registers.

A document's set holds its distinct shingles of WIDTH words (`[^\x20\x09-\x0D]+` after lower-casing A-Z), as 64-bit
hashes; with fewer words the sequence as one.

1. Equal sets are one class. Each gets M registers, floor(1 - log_B(A x)) of the least x of an exponential hash, cut to
   16 bits: registers of unions are maxima, and equal registers say how similar sets are (`sketch`).
2. Classes that agree on ROWS registers of a band meet in a bucket. Buckets with the same members count once. From the
   numbers of greater, less and equal registers and the known set sizes, the likelihood of a similarity of THRESHOLD is
   held against the best one (`plausible`).
3. Families, the components of what is plausible, are verified on full sets.

Both a bucket and a family are gone through in the same way, so that neither all pairs nor a text for each tile are sent:
every member is compared with one of them, the pivot, in chunks (`_pivot_units`). Only members that this leaves open meet
all others, in tiles of the open ones by tiles of all (`_open_units`); of a family, sketches meet first, and texts follow for the
rows of a tile that have a plausible partner in another component. What comes out are links that span what is connected,
and their components are the result. A group's facts reach its rows without a hot key (`joined_to_groups`).

With 24 bands of 5 registers a pair at a similarity of 0.85 is missed by the bands with a chance of 7.7e-7, and by
the least number of equal registers that the likelihood test asks for, 76 of 120, with 1.4e-9; the test itself is six
standard deviations wide.
Documents without words or text have 0 shingles and link with nothing; repeated rows are in one class; a null doc_id
links with nothing; an empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.batches import groups, local_roots
from ..operators.graph import components
from ..operators.skew import joined_to_groups
from .caches import claim
from .workspace import Workspace, documents

WIDTH, PERCENT = 5, 85
#: A fine base: unlike sets agree on a register with a chance of about 0.0025, on a band with 1e-13.
BANDS, ROWS, BASE, RATE = 24, 5, 1.01, 20.0
M = BANDS * ROWS
#: Members of a chunk that meets its pivot; members of a tile, of sketches and of texts; bytes of text in a chunk or tile; half
#: the width of the likelihood test, and the equal registers that it asks for.
PIVOTED, TILE, TEXT_TILE, TEXT_BYTES, WIDE, EQUAL = 64, 512, 256, 4 << 20, 18.0, 76

_draw = np.random.default_rng(85)
_A = _draw.integers(0, 1 << 31, M, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_B = _draw.integers(0, 1 << 31, M, dtype=np.uint32) * np.uint32(2) + np.uint32(1)


class _Words(dict):
    """64-bit hashes of words; forgets all when large."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) > 200_000:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h


_words = _Words()


def shingles(text: str | None, width: int = WIDTH) -> np.ndarray:
    """The document's set, ascending."""
    claim("words", _words.clear)
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(_words.__getitem__, words), np.uint64, n)
    w = min(n, width)
    out = np.full(n - w + 1, w, np.uint64)
    for k in range(w):
        out = (out ^ (out >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + h[k : n - w + 1 + k]
    out ^= out >> np.uint64(32)
    out *= np.uint64(0xD6E8FEB86659FD93)
    out ^= out >> np.uint64(32)
    return np.unique(out)


def sketch(items: np.ndarray) -> np.ndarray:
    """Registers of a set of 64-bit hashes."""
    least = np.full(M, 0xFFFFFFFF, np.uint32)
    low, high = items.astype(np.uint32), (items >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(items), 1024):
        part = np.multiply.outer(_A, low[at : at + 1024])
        part += np.multiply.outer(_B, high[at : at + 1024])
        np.minimum(least, part.min(1), out=least)
    x = -np.log1p(-(least.astype(np.float64) + 0.5) / 4294967296.0) / RATE
    return np.clip(np.floor(1 - np.log(x) / np.log(BASE)), 0, 65_535).astype(np.uint16)


def _chance(x: np.ndarray) -> np.ndarray:
    """Of a register of the one set above that of the other; x is what it has alone, as a share of both sets' sizes."""
    return -np.log1p(-x * (BASE - 1) / BASE) / np.log(BASE)


def plausible(rx: np.ndarray, nx: np.ndarray, ry: np.ndarray, ny: np.ndarray, percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs whose registers and sizes don't rule out a similarity of percent."""
    least, out = percent / 100, []
    grid = np.linspace(0.0, least, 35)
    for i in range(len(rx)):
        ok = np.flatnonzero((np.minimum(nx[i], ny) * 100 >= percent * np.maximum(nx[i], ny)))
        if not len(ok):
            continue
        equal = (ry[ok] == rx[i]).sum(1)
        near = equal >= EQUAL - M * (PERCENT / 100 - least)
        ok, equal = ok[near], equal[near]
        if not len(ok):
            continue
        above = (rx[i] > ry[ok]).sum(1)
        below = M - equal - above
        u = nx[i] / (nx[i] + ny[ok])
        # sizes n and m and similarity J: what the first has alone is (n - m J) / (1 + J) of n + m, by shares
        share = lambda j: (np.clip((u[:, None] - (1 - u)[:, None] * j) / 1, 1e-9, None), np.clip(((1 - u)[:, None] - u[:, None] * j) / 1, 1e-9, None))
        def chance(j: np.ndarray) -> np.ndarray:
            p, q = (np.clip(_chance(s), 1e-9, 0.999) for s in share(j[None, :]))
            return above[:, None] * np.log(p) + below[:, None] * np.log(q) + equal[:, None] * np.log(np.clip(1 - p - q, 1e-9, None))

        score = chance(grid)
        out.append((np.full(len(ok), i), ok, score.max(1) - score[:, -1] <= WIDE))
    if not out:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    a, b, keep = (np.concatenate(x) for x in zip(*out))
    return a[keep], b[keep]


def _similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    both = int((b[np.minimum(at, len(b) - 1)] == a).sum())
    return 100 * both >= percent * (len(a) + len(b) - both)


def verified(sets: list[np.ndarray], a: np.ndarray, b: np.ndarray, percent: int = PERCENT, linked: np.ndarray | None = None) -> tuple[list[int], list[int]]:
    """Of candidate pairs, links on full sets that span all that links connect: pairs that are connected aren't compared.

    Those marked as linked are connected already.
    """
    root = list(range(len(sets)))
    if linked is not None and linked.any():
        first = int(np.flatnonzero(linked)[0])
        root = [first if x else k for k, x in enumerate(linked.tolist())]

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    left, right = [], []
    for i, j in zip(a.tolist(), b.tolist()):
        x, y = find(i), find(j)
        if x != y and _similar(sets[i], sets[j], percent):
            root[max(x, y)] = min(x, y)
            left.append(i)
            right.append(j)
    return left, right


def _registers(column: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, M)


def _numpy(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy()


def _open_pairs(table: pa.Table, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Plausible pairs of an open row and another that it isn't linked with, by their rows in the table."""
    registers, n, ids, linked = _registers(table.column("sketch")), _numpy(table, "n"), _numpy(table, "rep"), _numpy(table, "linked")
    own = _numpy(table, "side") == 0
    one, two = np.flatnonzero(own), np.flatnonzero(~own)
    if not len(one) or not len(two):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    a, b = plausible(registers[one], n[one], registers[two], n[two], percent)
    a, b = one[a], two[b]
    other = (ids[a] != ids[b]) & ~(linked[a] & linked[b])
    return a[other], b[other]


def _forest(ids: np.ndarray, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    """Links (a, b) of ids that span what pairs of rows connect; an id may have several rows."""
    names, at = np.unique(ids, return_inverse=True)
    root = local_roots(len(names), at[a], at[b])
    some = root != np.arange(len(names))
    return pa.RecordBatch.from_arrays([pa.array(names[some], pa.int64()), pa.array(names[root[some]], pa.int64())], ["a", "b"])


def _digest(items: np.ndarray) -> bytes:
    return hashlib.blake2b(items.tobytes(), digest_size=16).digest()


def _pivot_units(members: DataFrame, facts: DataFrame, key: str) -> DataFrame:
    """members with chunk and lead: the pivot, which leads, is in every chunk of its group, any other member in one."""
    rows = joined_to_groups(members, facts.select(key, "many", "pivot", "chunks"), key).withColumn("lead", F.col("rep") == F.col("pivot"))
    own = F.array(F.pmod(F.xxhash64("rep"), F.col("chunks")).cast("int"))
    return rows.withColumn("chunk", F.explode(F.when(F.col("lead"), F.sequence(F.lit(0), F.col("chunks") - 1)).otherwise(own))).drop("many", "chunks")


def _open_units(members: DataFrame, facts: DataFrame, tried: DataFrame, key: str, work: Workspace, name: str) -> DataFrame | None:
    """Units (key, i, j) of open members (side 0) by all members (side 1), with linked: whether the pivot is linked with them.

    tried has a row for each member that was held against its pivot. None if nothing is open.
    """
    open_rows = tried.where("NOT ok").select(key, "rep").distinct()
    counted = work.save(open_rows.groupBy(key).agg(F.count("*").alias("opens")).join(facts.where("many > 2"), key), f"{name}-open")
    if counted.isEmpty():
        return None
    # tiles of open ones as large as those of all
    counted = counted.withColumn("i_tiles", F.ceil(F.col("opens") * F.col("tiles") / F.col("many")).cast("int"))
    rows = joined_to_groups(members, counted.select(key, "many", "tiles", "i_tiles"), key)
    rows = work.save(rows.join(open_rows.withColumn("open", F.lit(True)), [key, "rep"], "left").withColumn("linked", F.col("open").isNull()).drop("open", "many"), f"{name}-rows")
    tile = lambda of: F.pmod(F.xxhash64("rep"), F.col(of)).cast("int")
    ones = rows.where("NOT linked").select("*", F.lit(0).alias("side"), tile("i_tiles").alias("i"), F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("j"))
    alls = rows.select("*", F.lit(1).alias("side"), F.explode(F.sequence(F.lit(0), F.col("i_tiles") - 1)).alias("i"), tile("tiles").alias("j"))
    return ones.unionByName(alls).drop("tiles", "i_tiles")


def _dealt(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.repartition(*keys).sortWithinPartitions(*keys)


def sketches(docs: DataFrame) -> DataFrame:
    """(doc_id, n, digest, n_bytes, sketch)."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                items = shingles(text)
                out.append((key, len(items), _digest(items), len(text or ""), sketch(items).tobytes()) if len(items) else (key, 0, None, 0, None))
            ids, n, digest, size, made = zip(*out) if out else ((),) * 5
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(n, pa.int64()), pa.array(digest, pa.binary()), pa.array(size, pa.int64()), pa.array(made, pa.binary())], ["doc_id", "n", "digest", "n_bytes", "sketch"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(rows, "doc_id long, n long, digest binary, n_bytes long, sketch binary")


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept)."""
    spark = docs.sparkSession
    work = Workspace(spark, "minhash-dups")
    made = work.save(sketches(docs), "sketches")
    classes = made.where("n > 0 AND doc_id IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("sketch").alias("sketch"), F.max("n_bytes").alias("n_bytes"))
    # one doc_id may stand for several texts; then they share its classes' links
    classes = work.save(classes, "classes")

    def banded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shift, mark = np.arange(ROWS, dtype=np.uint64) * np.uint64(12), np.arange(BANDS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                some = batch.slice(at, 4096)
                keys = (_registers(some.column(1)).reshape(-1, BANDS, ROWS).astype(np.uint64) << shift).sum(2, dtype=np.uint64) + mark
                yield pa.RecordBatch.from_arrays([pa.array(keys.reshape(-1).view(np.int64)), pa.array(np.repeat(some.column(0).to_numpy(), BANDS))], ["key", "rep"])

    bands = work.save(classes.select("rep", "sketch").mapInArrow(banded, "key long, rep long"), "bands")
    buckets = bands.groupBy("key").agg(F.count("*").alias("many"), F.min("rep").alias("pivot"), F.bit_xor(F.xxhash64("rep")).alias("x"), F.sum(F.xxhash64("rep") % 1_000_003).alias("y")).where("many > 1")
    parts = lambda of, many, size=F.lit(0): F.greatest(F.ceil(many / of), F.ceil(size / F.lit(TEXT_BYTES))).cast("int")
    # a group has some 32 tiles before they are as large as they may be
    tile = lambda of, many: F.least(F.lit(of), F.greatest(F.lit(64), F.ceil(many / 32)))
    buckets = buckets.groupBy("many", "pivot", "x", "y").agg(F.min("key").alias("key"))
    buckets = work.save(buckets.select("key", "many", "pivot", parts(F.lit(PIVOTED), F.col("many")).alias("chunks"), parts(tile(TILE, F.col("many")), F.col("many")).alias("tiles")), "buckets")
    members = work.save(joined_to_groups(bands, buckets.select("key", "many"), "key").drop("many").join(classes.select("rep", "n", "sketch"), "rep"), "members")
    work.drop("bands")

    def rough(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in groups(batches, 2):
            lead = _numpy(table, "lead")
            rest, registers, n, ids = np.flatnonzero(~lead), _registers(table.column("sketch")), _numpy(table, "n"), _numpy(table, "rep")
            ok = np.zeros(len(rest), bool)
            if lead.any() and len(rest):
                ok[plausible(registers[lead], n[lead], registers[rest], n[rest], percent)[1]] = True
            yield pa.RecordBatch.from_arrays([pa.array(_numpy(table, "key")[rest]), pa.array(ids[rest]), pa.array(_numpy(table, "pivot")[rest]), pa.array(ok)], ["key", "rep", "pivot", "ok"])

    tried = work.save(_dealt(_pivot_units(members, buckets, "key").select("key", "chunk", "lead", "rep", "pivot", "n", "sketch"), "key", "chunk").mapInArrow(rough, "key long, rep long, pivot long, ok boolean"), "tried")
    forest = tried.where("ok").select(F.col("rep").alias("a"), F.col("pivot").alias("b"))

    def rough_rest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in groups(batches, 3):
            yield _forest(_numpy(table, "rep"), *_open_pairs(table, percent))

    units = _open_units(members, buckets, tried, "key", work, "bucket")
    if units is not None:
        forest = forest.unionByName(_dealt(units.select("key", "i", "j", "side", "linked", "rep", "n", "sketch"), "key", "i", "j").mapInArrow(rough_rest, "a long, b long"))
    families = components(work.save(forest, "forest"), work, "families").withColumnRenamed("component", "family")
    work.drop("members", "tried", "buckets")
    held = work.save(families.join(classes, families["id"] == classes["rep"]).select("family", "rep", "n", "sketch", "digest", "n_bytes"), "families")
    sizes = [parts(of, F.count("*"), F.sum("n_bytes")).alias(name) for of, name in ((F.lit(PIVOTED), "chunks"), (tile(TEXT_TILE, F.count("*")), "tiles"))]
    # the family's least id is one of its members
    facts = work.save(held.groupBy("family").agg(F.count("*").alias("many"), F.col("family").alias("pivot"), *sizes), "facts")
    texts = docs.select(F.col("doc_id").cast("long").alias("rep"), F.col("text").cast("string").alias("text"))

    def full_sets(table: pa.Table) -> tuple[pa.Table, list[np.ndarray]]:
        """Without rows that share an id with another text, which aren't of the class."""
        sets = [shingles(x) for x in table.column("text").to_pylist()]
        right = np.array([_digest(x) == y for x, y in zip(sets, table.column("digest").to_pylist())], bool)
        return table.filter(pa.array(right)), [x for x, ok in zip(sets, right) if ok]

    def checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in groups(batches, 2):
            table, sets = full_sets(table)
            lead = _numpy(table, "lead")
            pivots = [sets[k] for k in np.flatnonzero(lead)]
            rest = np.flatnonzero(~lead)
            ok = [any(_similar(p, sets[k], percent) for p in pivots) for k in rest]
            yield pa.RecordBatch.from_arrays([pa.array(_numpy(table, "family")[rest]), pa.array(_numpy(table, "rep")[rest]), pa.array(ok, pa.bool_())], ["family", "rep", "ok"])

    units = _pivot_units(held.select("family", "rep", "digest"), facts, "family").select("family", "chunk", "lead", "rep", "digest")
    tried = work.save(_dealt(units.join(texts, "rep").select("family", "chunk", "lead", "rep", "digest", "text"), "family", "chunk").mapInArrow(checked, "family long, rep long, ok boolean"), "checked")
    proven = tried.where("ok").select(F.col("rep").alias("a"), F.col("family").alias("b"))

    def rough_partners(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in groups(batches, 3):
            yield from table.take(pa.array(np.unique(np.concatenate(_open_pairs(table, percent))))).to_batches()

    def checked_rest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in groups(batches, 3):
            table, sets = full_sets(table)
            a, b = verified(sets, *_open_pairs(table, percent), percent, _numpy(table, "linked"))
            ids = _numpy(table, "rep")
            yield pa.RecordBatch.from_arrays([pa.array(ids[a], pa.int64()), pa.array(ids[b], pa.int64())], ["a", "b"])

    units = _open_units(held, facts, tried, "family", work, "family")
    if units is not None:
        names = ["family", "i", "j", "side", "linked", "rep", "n", "sketch", "digest"]
        schema = "family long, i int, j int, side int, linked boolean, rep long, n long, sketch binary, digest binary"
        partners = _dealt(units.select(*names), "family", "i", "j").mapInArrow(rough_partners, schema)
        proven = proven.unionByName(_dealt(partners.join(texts, "rep").select(*names, "text"), "family", "i", "j").mapInArrow(checked_rest, "a long, b long"))
    links = components(work.save(proven, "proven"), work, "links")
    found = classes.join(links, classes["rep"] == links["id"], "left").select("digest", F.coalesce("component", "rep").alias("c"))
    out = made.select("doc_id", "n", F.when(F.col("doc_id").isNotNull(), F.col("digest")).alias("digest")).join(found, "digest", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("c", "doc_id").alias("component_id")).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def deduplicated(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One row of docs for each group: that of the component's id. Rows without a doc_id or without words stay.

    Rows that repeat an id and a text are one document; the least text stands for an id with several.
    """
    work = Workspace(docs.sparkSession, "minhash-kept")
    # ids alone decide, so that texts are shuffled once at most
    gone = work.save(near_duplicates(docs, percent).groupBy("doc_id").agg(F.bool_or("kept").alias("kept"), F.count("*").alias("many")).where("doc_id IS NOT NULL AND (NOT kept OR many > 1)"), "gone")
    names = docs.columns
    held = docs.select(F.struct(*[docs[f"`{c}`"] for c in names]).alias("doc"), docs["doc_id"].cast("long").alias("__id"))
    joined = held.join(gone, held["__id"] == gone["doc_id"], "left").where("kept IS NULL OR kept")
    once = joined.where("many IS NULL").select("doc").unionByName(joined.where("many > 1").groupBy("__id").agg(F.min_by("doc", F.coalesce(F.col("doc.text").cast("string"), F.lit(""))).alias("doc")).select("doc"))
    return once.select("doc.*")


def op2_minhash_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir))
