"""Hard negatives and clusters: against SQL, bounds that hold, and odd rows."""

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from isobar.llm import oracles
from isobar.llm.clustering import Bisectors, cluster_vectors
from isobar.llm.hard_negatives import Anchors, Codes, hard_negatives
from isobar.llm.queries import op12_hard_negatives, op13_centroid_clustering
from tests.llm.conftest import clashing
from tests.oracle import assert_same

FIELDS = "vec_id bigint, embedding array<float>, label int"


def odd_vectors(width):
    """Copies of one vector for a third of the rows, ties, zeros, nulls, wrong lengths, repeated ids."""
    pick = np.random.default_rng(8)
    draw = lambda: [float(x) for x in pick.integers(-3, 4, width) / 4]
    rows = [(i, draw(), int(pick.integers(0, 3))) for i in range(90)]
    rows += [(100 + i, [0.5] * width, i % 3) for i in range(60)]
    rows += [(200, draw(), 1), (200, draw(), 1), (300, [0.0] * width, 2), (301, [0.0] * width, 0), (400, [0.5] * width, 1)]
    rows += [(500, None, 1), (501, draw(), None), (502, [None, *draw()[1:]], 1), (503, [float("nan"), *draw()[1:]], 1)]
    rows += [(504, [float("inf"), *draw()[1:]], 2), (700, [-x for x in rows[7][1]], 1), (None, [0.5] * width, 0)]
    return rows


@pytest.fixture(scope="module")
def vectors_dir(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("vectors"))
    clashing(spark.createDataFrame(odd_vectors(64), FIELDS)).coalesce(2).write.parquet(f"{folder}/embeddings.parquet")
    return folder


@pytest.fixture(scope="module")
def duck(vectors_dir):
    connection = duckdb.connect()
    connection.execute(f"create view embeddings as select * from '{vectors_dir}/embeddings.parquet/*.parquet'")
    return connection


def test_hard_negatives_of_odd_rows_match_sql(spark, vectors_dir, duck):
    assert assert_same(op12_hard_negatives(spark, vectors_dir), duck, oracles.HARD_NEGATIVES) > 20


@pytest.mark.parametrize(("bits", "planes", "sent"), [(64, 1, 1 << 21), (512, 5, 64), (1024, 8, 300)])
def test_codes_and_blocks_do_not_change_the_result(spark, vectors_dir, duck, bits, planes, sent):
    rows = spark.read.parquet(f"{vectors_dir}/embeddings.parquet").where("embedding is not null and not exists(embedding, x -> x is null or isnan(x) or abs(x) = double('inf'))")
    shifted = F.expr("if(vec_id % 7 = 0, (label + 1) % 10, label)")
    vectors = rows.select("vec_id", shifted.alias("label"), F.expr("transform(embedding, x -> int(floor(256 * x)))").alias("vector"))
    found = hard_negatives(vectors, F.col("vec_id") % 100 == 0, bits=bits, planes=planes, sent=sent)
    assert_same(found, duck, oracles.HARD_NEGATIVES)


@pytest.mark.parametrize("bits", [64, 512])
def test_intervals_hold_every_score(bits):
    pick = np.random.default_rng(4)
    vectors = np.concatenate([pick.integers(-300, 300, (200, 48)), np.zeros((3, 48), int), np.full((3, 48), 1 << 24)])
    packed, norms, along, lengths = Codes.stored(vectors.astype(float), bits)
    anchors = Anchors.of(np.arange(len(vectors)), np.zeros(len(vectors)), vectors, bits, 4)
    low, high = anchors.intervals(Codes.read(packed, norms, along, lengths), bits)
    exact = vectors @ vectors.T
    assert (low <= exact).all() and (exact <= high).all()
    ordinary = slice(0, 200)
    spread = np.median((high - low)[ordinary, ordinary]) / np.median(norms[ordinary]) ** 2
    assert spread < (0.75 if bits == 512 else 1.6)


def test_negatives_by_hand(spark):
    rows = [(0, 1, [10, 0]), (1, 1, [10, 0]), (2, 2, [9, 5]), (3, 2, [8, 1]), (4, 3, [7, 0]), (5, 2, [10, 9]), (6, 2, [11, 0])]
    docs = spark.createDataFrame(rows, "vec_id int, label int, vector array<int>")
    found = hard_negatives(docs, F.col("vec_id") == 0).collect()
    assert [tuple(r) for r in sorted(found, key=lambda r: r.rank)] == [
        (0, 1, 1, 5, 100, 100), (0, 1, 2, 2, 100, 90), (0, 1, 3, 3, 100, 80),
    ]


def test_vectors_of_different_lengths_end_in_zeros(spark):
    rows = [(0, 1, [4, 4, 4]), (1, 1, [5]), (2, 2, [4]), (3, 2, []), (4, 2, [0, 0, 0, 9])]
    docs = spark.createDataFrame(rows, "vec_id int, label int, vector array<int>")
    found = hard_negatives(docs, F.col("vec_id") == 0).collect()
    assert [(r.positive_id, r.negative_id, r.positive_score, r.negative_score) for r in found] == [(1, 2, 20, 16)]


def test_no_rows_and_no_anchors(spark):
    none = spark.createDataFrame([], "vec_id bigint, label int, vector array<int>")
    assert hard_negatives(none, F.lit(True)).count() == 0
    some = spark.createDataFrame([(1, 1, [2])], none.schema)
    assert hard_negatives(some, F.lit(False)).count() == 0
    assert hard_negatives(some, F.lit(None).cast("boolean")).count() == 0
    assert hard_negatives(some, F.lit(True)).count() == 0


def test_clusters_of_odd_rows_match_sql(spark, vectors_dir, duck):
    assert assert_same(op13_centroid_clustering(spark, vectors_dir), duck, oracles.clustering()) == 158


def test_tournament_finds_the_nearest():
    pick = np.random.default_rng(6)
    centroids = np.concatenate([pick.integers(-4, 5, (20, 3)), np.zeros((2, 3), int)])
    vectors = pick.integers(-5, 6, (5000, 3))
    planes = Bisectors.between(centroids)
    distances = ((vectors[:, None, :] - centroids) ** 2).sum(axis=2)
    found = planes.nearest(vectors)
    assert (found == distances.argmin(axis=1)).all()
    assert (planes.distances(vectors, found) == distances.min(axis=1)).all()


def test_empty_clusters_and_few_vectors(spark):
    table = spark.createDataFrame([(i, [float(i), 0.0], 1) for i in range(3)], FIELDS)
    found = {r.vec_id: r for r in cluster_vectors(table, dimension=2).collect()}
    assert {r.distance for r in found.values()} == {0} and len({r.cluster for r in found.values()}) == 3
    same = spark.createDataFrame([(i, [1.0, 2.0], 1) for i in range(50)], FIELDS)
    assert {(r.cluster, r.inertia) for r in cluster_vectors(same, dimension=2).collect()} == {(0, 0)}
    assert cluster_vectors(table, dimension=64).count() == 0
    huge = spark.createDataFrame([(i, [3e38 * (-1) ** i, 1.0], 1) for i in range(9)], FIELDS)
    assert cluster_vectors(huge, dimension=2, centroids=2).count() == 9
