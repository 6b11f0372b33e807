"""Nulls, empty and long texts, ties, repeated rows, empty tables and further columns, for every operator and stage."""

import pathlib
import random

import pytest
from conftest import DATA
from pyspark.sql import functions as F

import corpus_pipeline
from sievewright.llm import digests, embedding_dups, minhash_dups, mixing, packing, quality, repeats, resharding, secret_scan, token_output
from sievewright.operators.workspace import Workspace

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, score double, bucket int, part long, component_id long, quality int, h long, n long, copies int"
MORE = (1, 0.5, 2, 3, 4, 5, 6, 7, 8)
ROWS = [
    (1, "one two three four five six seven", "en", "a", 33, *MORE),
    (1, "one two three four five six seven", "en", "a", 33, *MORE),
    (2, None, None, None, None, *[None] * 9),
    (None, "no id here at all, none", "en", None, 23, *MORE),
    (3, "", "en", "b", 0, *MORE),
    (4, " \n\t ", "en", "b", 4, *MORE),
    (5, "word " * 30_000, "en", "b", 150_000, *MORE),
    (6, "x" * 50_000, "en", "c", 50_000, *MORE),
    (7, "one two three four five six seven", "en", "a", 33, *MORE),
    (7, "another text under the same id", "en", "a", 30, *MORE),
]
BY_ROW = {
    "tokens": token_output.token_output, "minhash": minhash_dups.near_duplicates, "mix": mixing.mix, "repeats": repeats.repeats_removed, "secrets": secret_scan.scan, "shards": resharding.plan, "digests": digests.digests, "masked": secret_scan.redacted,
}


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.mark.parametrize("name", BY_ROW)
def test_a_row_for_each_row(spark, odd, name):
    assert BY_ROW[name](odd).count() == len(ROWS)
    assert BY_ROW[name](odd.limit(0)).count() == 0
    assert BY_ROW[name](spark.createDataFrame([(9, None)], "doc_id long, text string") if name != "mix" else odd.where("doc_id = 2")).count() == 1


def test_packing(odd):
    rows = packing.packed(odd).toPandas()
    assert (rows.piece == 0).sum() == len(ROWS) and packing.packed(odd.limit(0)).count() == 0


def test_equal_rows_are_packed_apart(spark, monkeypatch):
    monkeypatch.setattr(packing, "PARTITION", 400)
    rows = packing.packed(spark.range(4000).selectExpr("7L AS doc_id", "'some words of a row that all have' AS text")).toPandas()
    assert len(rows) == 4000 and rows.groupby("sequence_id")["length"].sum().max() <= 1024
    # each of the ten partitions is certified by itself, so that it may take a bin more than its share
    assert ((rows.sequence_id // 2**32) % 2**24).nunique() == 10 and rows.sequence_id.nunique() <= packing.lower_bound(rows["length"].to_numpy(), 1024) + 10


def test_quality(spark, odd):
    for labels in ([], [(k, k % 2) for k in range(8)], [(1, 1)]):
        given = spark.createDataFrame(labels, "doc_id long, quality int")
        out = quality.scored(odd.withColumnRenamed("score", "SCORE"), quality.train(odd, given)).toPandas()
        assert list(out.columns) == [*odd.drop("score").columns, "score"]
        assert len(out) == len(ROWS) and out.score.between(0, 1).all() and out[out.text.isna()].score.iloc[0] == out[out.text == ""].score.iloc[0]
        assert quality.accepted(odd, given).columns == odd.columns
    assert quality.scored(odd.drop("score").limit(0), quality.train(odd.limit(0), given)).count() == 0


def test_values_of_odd_rows(odd):
    first = {(r.doc_id, r.n_bytes): r for r in repeats.repeats_removed(odd).collect()}
    assert first[5, 150_000].n_removed == 150_000 and first[6, 50_000].n_removed == 50_000 and first[2, 0].n_spans == 0
    dup = minhash_dups.near_duplicates(odd).collect()
    assert {(r.doc_id, r.component_id) for r in dup} >= {(1, 1), (7, 1), (2, 2), (None, None), (3, 3)} and all(r.kept for r in dup if r.doc_id in (1, 2, 3, 4, None))
    kept = minhash_dups.deduplicated(odd)
    assert kept.columns == odd.columns and sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 2, 3, 4, 5, 6, 7]
    tokens = token_output.token_output(odd).orderBy("start").collect()
    assert tokens[0].doc_id is None and [r.n_tokens for r in tokens if r.doc_id in (2, 3, 4)] == [1, 1, 1]
    assert sum(r.near_next == 1.0 for r in digests.digests(odd).collect() if r.doc_id in (2, 3)) >= 1


def test_a_long_row_of_copies(spark):
    many = spark.range(3000).selectExpr("id AS doc_id", "'the same words over and over in every single row' AS text", "'s' AS source")
    assert {(r.component_id, r.n_shingles) for r in minhash_dups.near_duplicates(many).collect()} == {(0, 6)}
    assert resharding.plan(many, 32, 40).groupBy("shard").count().agg({"count": "max"}).first()[0] <= 80


def test_repeated_rows_hold_their_places_once(spark):
    rng = random.Random(5)
    text = " ".join(str(rng.random()) for _ in range(200))
    told = {}
    for many in (2, 40):
        df = spark.range(many).select(F.lit(None).cast("long").alias("doc_id"), F.lit(text).alias("text"))
        (row,) = repeats.repeated_stretches(df, Workspace(spark, "test-repeats")).collect()
        told[many] = sorted(map(tuple, row.spans))
        got = {(r.n_bytes, r.n_removed, r.n_spans) for r in repeats.repeats_removed(df).collect()}
        assert got == {(len(text), len(text), 1)}
    assert told[2] == told[40] and len(set(told[2])) == len(told[2])


def test_files_of_equal_rows_stay_apart(spark, tmp_path):
    # the texts of id 5 fill more than two files, and the last of these also holds id 6
    words = token_output.FILE_IDS // 8
    rows = spark.range(20).selectExpr("5L AS doc_id", f"repeat('a ', {words}) AS text").unionByName(spark.createDataFrame([(6, "b")], "doc_id long, text string")).coalesce(1)
    out = token_output.token_output(rows, folder=tmp_path.as_uri()).orderBy("start").collect()
    assert [r.doc_id for r in out] == [5] * 20 + [6]
    assert [r.start for r in out] == [k * (words + 1) for k in range(21)]
    assert len({r.file for r in out}) == len(list(tmp_path.glob("*.swt"))) > 2
    back = [token_output.unpack_file(p.read_bytes()) for p in tmp_path.glob("*.swt")]
    assert sum(len(ids) for *_, ids in back) == 20 * (words + 1) + 2


def test_vectors(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, label int, n_links int")
    assert embedding_dups.near_duplicates(empty).count() == 0
    rows = [(1, [1.0, 0.0], 0, 9), (1, [1.0, 0.0], 0, 9), (None, [1.0, 0.0], 0, 9), (2, [0.0, 1.0], 0, 9)]
    got = embedding_dups.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, n_links int")).collect()
    assert sorted((r.vec_id or 0, r.n_links, r.component_id or 0) for r in got) == [(0, 0, 0), (1, 1, 1), (1, 1, 1), (2, 0, 2)]


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages(spark, odd, name, stage):
    for docs in (odd, odd.limit(0), spark.read.parquet(f"{DATA}/documents.parquet")):
        out = stage(spark, docs, DATA)
        assert out.count() <= 2 * docs.count() + 200
        if name != "best_fit_packing":
            assert out.columns == docs.columns and out.schema == docs.schema


def test_pipeline_runs_whole(spark):
    rows = corpus_pipeline.run(spark, DATA).toPandas()
    assert len(rows) > 0 and rows.groupby("sequence_id")["length"].sum().max() <= 1024


def test_shards_are_written_whole(spark, odd, tmp_path):
    docs = odd.unionByName(odd).unionByName(odd)
    for got in (resharding.resharded(docs, str(tmp_path / "s"), 8, 10), resharding.resharded(docs.limit(0))):
        assert got.columns == resharding.plan(odd).columns
    planned = resharding.plan(docs, 8, 10)
    got = resharding.resharded(docs, str(tmp_path / "s"), 8, 10)
    assert sorted(map(str, got.collect())) == sorted(map(str, planned.collect()))
    gone = {x for r in planned.where("old_shard != shard").collect() for x in (r.old_shard, r.shard)}
    written = spark.read.parquet(str(tmp_path / "s"))
    want = sorted((r.shard, str(r.doc_id), r.size) for r in planned.collect() if r.shard in gone)
    assert want and sorted((r["__shard"], str(r.doc_id), len((r.text or "").encode()) + 16) for r in written.collect()) == want
    if len(want) == docs.count():
        assert sorted(map(str, written.drop("__shard", "__old").collect())) == sorted(map(str, docs.collect()))
    assert resharding.rewrite(docs, planned, str(tmp_path / "r")).agg({"n_rows": "sum"}).first()[0] == len(want)


def test_a_store_is_resharded_from_its_files(spark, tmp_path):
    """Twice over: from hashed shards to even ones, and from these, which the second flow finds as stored, to more."""
    docs = spark.read.parquet(DATA.replace("sf0.001", "sf0.01") + "/documents.parquet")
    held = resharding.store(docs, str(tmp_path / "a"), 8)
    first = resharding.resharded(held, str(tmp_path / "b"), 8, 10)
    sizes = {r.old_shard: r.n for r in first.groupBy("old_shard").agg({"size": "sum"}).toDF("old_shard", "n").collect()}
    assert sizes == {r["__shard"]: r.n for r in held.groupBy("__shard").agg(F.sum(F.octet_length(F.coalesce("text", F.lit(""))) + 16).alias("n")).collect()}
    assert first.count() == docs.count() and {r.shard for r in first.select("shard").collect()} == set(range(10))
    again = resharding.stored(spark, str(tmp_path / "b"), docs.schema)
    assert again.count() == docs.count()
    second = resharding.resharded(again, str(tmp_path / "c"), 10, 12).toPandas()
    total, most = second["size"].sum(), second["size"].max()
    moved = second[second.old_shard != second.shard]["size"].sum()
    assert (abs(second.groupby("shard")["size"].sum() - total / 12) <= most).all() and moved <= total / 6 + 24 * most
    # from equal shards to as many no row moves, and nothing is written
    rows = [(k, "x" * 84) for k in range(400)]
    even = resharding.store(spark.createDataFrame(rows, "doc_id long, text string"), str(tmp_path / "d"), 1)
    same = resharding.resharded(even, str(tmp_path / "e"), 1, 1)
    assert same.count() == 400 and spark.read.schema(even.schema).option("pathGlobFilter", "*.parquet").parquet(str(tmp_path / "e")).count() == 0


def test_op9_gives_places_as_written(spark):
    rows = resharding.op9_resharding(spark, DATA).collect()
    root = pathlib.Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file://"))
    folder = max(root.glob("resharding-*/shards"), key=lambda p: p.stat().st_mtime)
    written = spark.read.parquet(f"file://{folder}").collect()
    affected = {x for r in rows if r.old_shard != r.shard for x in (r.old_shard, r.shard)}
    assert affected and sorted((r["__shard"], r.doc_id) for r in written) == sorted((r.shard, r.doc_id) for r in rows if r.shard in affected)
