"""Hard negatives: rotated one-bit codes with a proven interval around every estimate.

A frame of orthonormal columns turns each vector into more components than it had; their
signs are its code. Seen from the vector's own space the code is a direction, and the
vector's part along that direction is stored with it (the alignment). For a query q and a
vector x = along * d + r, with d the direction and r at right angles to it,

    <q, x> = along * <q, d> + <q - <q, d> d, r>,

where <q, d> comes from popcounts of the code against the bit planes of the turned query,
and by Cauchy and Schwarz the rest is at most |r| * sqrt(|q|^2 - <q, d>^2). What the planes
round off is bounded in the same way. Pairs whose interval cannot reach what an anchor
already has are let go; the others are scored on their integers, so results are exact.

Anchors go out in blocks of bounded size and meet all rows: once for their positives, once
for the negatives of these. Each task keeps the best of its own rows for each anchor, and
only those are shuffled.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from isobar.llm.arrow import ship_package
from isobar.llm.vectors import matrix
from isobar.storage import materialise

POSITIVES = NEGATIVES = 5
#: A negative's score is between this share, in hundredths, and the whole of the positive's.
LEAST = 80
#: Bits of a code, and bit planes of a turned query.
BITS, PLANES = 512, 5
#: Components of anchors that go out to the tasks at once: with codes and results some 50 MB.
SENT = 1 << 21
_ANCHORS, _ROWS = 128, 4096
_LAST = np.iinfo(np.int64).max
_LEAST_SCORE = np.iinfo(np.int64).min


@functools.lru_cache(maxsize=2)
def _frame(bits: int, width: int) -> np.ndarray:
    """``bits`` rows and orthonormal columns, or rows if there are fewer of them; always the same."""
    drawn = np.random.default_rng(23).standard_normal((bits, width))
    if bits >= width:
        return np.linalg.qr(drawn)[0]
    return np.ascontiguousarray(np.linalg.qr(drawn.T)[0].T)


def _packed(signs: np.ndarray) -> np.ndarray:
    return np.packbits(signs, axis=1).view(np.uint64)


@dataclass(frozen=True)
class Codes:
    """Codes of some rows; the part of each row along its code's direction, and what is left of it."""

    words: np.ndarray
    counts: np.ndarray
    along: np.ndarray
    rest: np.ndarray
    norms: np.ndarray
    lengths: np.ndarray  # of the codes, seen from the vectors' space

    @staticmethod
    def stored(vectors: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(bytes of the codes, norms, alignments, lengths) of some rows."""
        frame = _frame(bits, vectors.shape[1])
        signs = vectors @ frame.T >= 0
        seen = np.where(signs, 1.0, -1.0) @ frame
        lengths = np.maximum(np.linalg.norm(seen, axis=1), 1e-9)
        along = np.einsum("ij,ij->i", vectors, seen) / lengths
        return np.packbits(signs, axis=1), np.linalg.norm(vectors, axis=1), along, lengths

    @staticmethod
    def read(packed: np.ndarray, norms: np.ndarray, along: np.ndarray, lengths: np.ndarray) -> Codes:
        words = packed.view(np.uint64)
        rest = np.sqrt(np.maximum(norms**2 - along**2, 0))
        return Codes(words, np.bitwise_count(words).sum(axis=1, dtype=np.int64), along, rest, norms, lengths)

    def part(self, rows: slice) -> Codes:
        return Codes(*(getattr(self, name)[rows] for name in self.__dataclass_fields__))


@dataclass(frozen=True)
class Anchors:
    """A block of anchors: rows, labels, integers, and the bit planes of their turned vectors."""

    rows: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    planes: np.ndarray  # anchor, plane, word
    low: np.ndarray
    step: np.ndarray
    total: np.ndarray
    missed: np.ndarray  # length of what the planes round off
    norms: np.ndarray

    @staticmethod
    def of(rows: np.ndarray, labels: np.ndarray, vectors: np.ndarray, bits: int, planes: int) -> Anchors:
        turned = vectors @ _frame(bits, vectors.shape[1]).T
        low = turned.min(axis=1, initial=0.0)
        step = np.maximum((turned.max(axis=1, initial=0.0) - low) / (2**planes - 1), 1e-9)
        levels = np.rint((turned - low[:, None]) / step[:, None]).astype(np.int64)
        missed = np.linalg.norm(turned - (low[:, None] + step[:, None] * levels), axis=1)
        cut = np.stack([_packed((levels >> plane & 1).astype(bool)) for plane in range(planes)], axis=1)
        return Anchors(rows, labels, vectors, cut, low, step, levels.sum(axis=1), missed, np.linalg.norm(vectors, axis=1))

    def part(self, rows: slice) -> Anchors:
        return Anchors(*(getattr(self, name)[rows] for name in self.__dataclass_fields__))

    def intervals(self, codes: Codes, bits: int) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bounds of the scores of every anchor with every coded row."""
        held = np.zeros((len(self.rows), len(codes.along)), dtype=np.int64)
        for plane in range(self.planes.shape[1]):
            count = np.zeros(held.shape, dtype=np.uint16)
            for word in range(codes.words.shape[1]):
                count += np.bitwise_count(self.planes[:, plane, word, None] & codes.words[None, :, word])
            held += count.astype(np.int64) << plane
        # The sum of the turned query's components, each with the sign of the code.
        signed = self.low[:, None] * (2 * codes.counts - bits) + self.step[:, None] * (2 * held - self.total[:, None])
        toward = signed / codes.lengths
        slack = self.missed[:, None] * np.sqrt(bits) / codes.lengths
        sure = np.maximum(np.abs(toward) - slack, 0)
        aside = np.sqrt(np.maximum(self.norms[:, None] ** 2 - sure**2, 0))
        half = np.abs(codes.along) * slack + codes.rest * aside
        # More than rounding in doubles can amount to.
        half += 1e-7 * (self.norms[:, None] * codes.norms + 1)
        middle = codes.along * toward
        return middle - half, middle + half


class Best:
    """The best ``k`` rows of each anchor so far: the higher score, then the smaller id."""

    def __init__(self, anchors: int, k: int) -> None:
        self.k = k
        self.scores = np.full((anchors, k), _LEAST_SCORE)
        self.ids = np.full((anchors, k), _LAST)
        self.taken = np.zeros((anchors, k), dtype=bool)

    def reach(self, part: slice) -> np.ndarray:
        """What a score must reach to be among the best, as far as is known."""
        return np.where(self.taken[part, -1], self.scores[part, -1], _LEAST_SCORE)

    def add(self, first: int, anchors: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """Offer rows to the anchors ``first + anchors``."""
        if not len(anchors):
            return
        concerned = np.unique(anchors)
        held, place = np.nonzero(self.taken[first + concerned])
        held = concerned[held]
        place = (first + held, place)
        whose = np.concatenate([held, anchors])
        score, name = np.concatenate([self.scores[place], scores]), np.concatenate([self.ids[place], ids])
        order = np.lexsort((name, -score, whose))
        whose, score, name = whose[order], score[order], name[order]
        _, begin, number = np.unique(whose, return_index=True, return_counts=True)
        rank = np.arange(len(whose)) - np.repeat(begin, number)
        keep = rank < self.k
        at = (first + whose[keep], rank[keep])
        self.scores[at], self.ids[at], self.taken[at] = score[keep], name[keep], True

    def batch(self, rows: np.ndarray, slot: int) -> pa.RecordBatch:
        anchor, place = np.nonzero(self.taken)
        ids = self.ids[anchor, place]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(rows[anchor]), pa.array(np.full(len(anchor), slot), pa.int32()),
                pa.array(ids, mask=ids == _LAST), pa.array(self.scores[anchor, place]),
            ],
            ["anchor", "slot", "id", "score"],
        )


_FOUND = "anchor bigint, slot int, id bigint, score bigint"


def _encoded(rows: DataFrame, width: int, bits: int) -> DataFrame:
    """The rows with their codes, alignments, norms and the codes' lengths."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed, norms, along, lengths = Codes.stored(matrix(batch.column("vector"), width).astype(np.float64), bits)
            code = pa.array([row.tobytes() for row in packed], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, code, pa.array(norms), pa.array(along), pa.array(lengths)],
                [*batch.schema.names, "code", "norm", "along", "length"],
            )

    return rows.mapInArrow(
        encode,
        "row bigint, id bigint, label bigint, anchor boolean, vector array<int>, "
        "code binary, norm double, along double, length double",
    )


@dataclass(frozen=True)
class _Batch:
    rows: np.ndarray
    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    codes: Codes

    @staticmethod
    def all(batches: Iterator[pa.RecordBatch], width: int, bits: int) -> Iterator[_Batch]:
        for whole in batches:
            for at in range(0, whole.num_rows, _ROWS):
                batch = whole.slice(at, _ROWS)
                column = lambda name, batch=batch: batch.column(name).to_numpy(zero_copy_only=False)
                packed = np.frombuffer(b"".join(batch.column("code").to_pylist()), dtype=np.uint8)
                codes = Codes.read(packed.reshape(-1, bits // 8), column("norm"), column("along"), column("length"))
                ids = batch.column("id").fill_null(_LAST).to_numpy()
                yield _Batch(column("row"), ids, column("label"), matrix(batch.column("vector"), width), codes)


def _scores(anchors: Anchors, vectors: np.ndarray, where: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The pairs that survive, with their exact scores."""
    left, right = np.nonzero(where)
    scores = np.empty(len(left), dtype=np.int64)
    for at in range(0, len(left), 1 << 16):
        pair = slice(at, at + (1 << 16))
        scores[pair] = np.einsum("ij,ij->i", anchors.vectors[left[pair]], vectors[right[pair]])
    return left, right, scores


def _positives(coded: DataFrame, anchors: Anchors, k: int, width: int, bits: int) -> DataFrame:
    """For each anchor the best rows with its label in each task."""
    shared = coded.sparkSession.sparkContext.broadcast(anchors)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        everyone = shared.value
        best = Best(len(everyone.rows), k)
        for batch in _Batch.all(batches, width, bits):
            for first in range(0, len(everyone.rows), _ANCHORS):
                tile = slice(first, first + _ANCHORS)
                some = everyone.part(tile)
                lower, upper = some.intervals(batch.codes, bits)
                fit = (some.labels[:, None] == batch.labels) & (some.rows[:, None] != batch.rows)
                reach = best.reach(tile).astype(np.float64)
                if len(batch.rows) > k:
                    # The k-th best lower bound is reached by k rows for certain.
                    lower = np.where(fit, lower, -np.inf)
                    reach = np.maximum(reach, np.partition(lower, -k, axis=1)[:, -k])
                left, right, scores = _scores(some, batch.vectors, fit & (upper >= reach[:, None]))
                best.add(first, left, scores, batch.ids[right])
        yield best.batch(everyone.rows, 0)

    return coded.mapInArrow(search, _FOUND)


def _negatives(
    coded: DataFrame, anchors: Anchors, wanted: np.ndarray, k: int, least: int, width: int, bits: int
) -> DataFrame:
    """For each anchor and positive the best rows of other labels in each task.

    ``wanted`` has the positives' scores by anchor and slot, -1 where there is none.
    """
    shared = coded.sparkSession.sparkContext.broadcast((anchors, wanted))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        everyone, high = shared.value
        low = np.where(high < 0, _LAST, -(-least * high // 100))
        best = [Best(len(everyone.rows), k) for _ in range(high.shape[1])]
        for batch in _Batch.all(batches, width, bits):
            for first in range(0, len(everyone.rows), _ANCHORS):
                tile = slice(first, first + _ANCHORS)
                some = everyone.part(tile)
                lower, upper = some.intervals(batch.codes, bits)
                floors = [np.maximum(low[tile, slot], best[slot].reach(tile)) for slot in range(len(best))]
                need = np.min(floors, axis=0)[:, None].astype(np.float64)
                most = high[tile].max(axis=1)[:, None].astype(np.float64)
                fit = (some.labels[:, None] != batch.labels) & (upper >= need) & (lower <= most)
                left, right, scores = _scores(some, batch.vectors, fit)
                for slot, floor in enumerate(floors):
                    inside = (scores >= floor[left]) & (scores <= high[tile, slot][left])
                    best[slot].add(first, left[inside], scores[inside], batch.ids[right[inside]])
        for slot, found in enumerate(best):
            yield found.batch(everyone.rows, slot)

    return coded.mapInArrow(search, _FOUND)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """The best ``k`` of all tasks by anchor and slot; each task hands on its own ``k`` at most."""
    order = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(
    rows: DataFrame,
    anchor: Column,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    least: int = LEAST,
    id_col: str = "vec_id",
    label_col: str = "label",
    vector_col: str = "vector",
    bits: int = BITS,
    planes: int = PLANES,
    sent: int = SENT,
) -> DataFrame:
    """For each anchor and each of its positives the hardest rows of other labels.

    ``vector_col`` holds integer components of at most 2^24 in size; ``anchor`` is a
    condition on the columns of ``rows``. Scores are inner products; higher scores come
    first, then smaller ids, then rows without an id. A positive is one of the first
    ``positives`` other rows of the anchor's label. A negative has another label and a
    score from ``least`` hundredths of the positive's up to that score itself, so a
    positive below zero has none. An anchor or positive without negatives gives no row.
    Returns anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Rows without a label or vector take no part. Repeated rows are rows of their own: each
    repeated anchor is mined, and an anchor's copy may be its positive. Vectors of
    different lengths are compared as if the shorter one ended in zeros; an empty vector
    scores 0 with all. An empty table, or one without anchors, gives an empty result.
    Other columns are ignored.
    """
    spark = rows.sparkSession
    ship_package(spark)
    taken = rows.where(F.col(label_col).isNotNull() & F.col(vector_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"),
        F.coalesce(anchor, F.lit(False)).alias("anchor"), F.col(vector_col).cast("array<int>").alias("vector"),
    )
    numbered = taken.select(F.monotonically_increasing_id().alias("row"), "id", "label", "anchor", "vector")
    numbered = materialise(numbered, "vectors")
    chosen = F.col("anchor")
    width, count = numbered.agg(F.max(F.size("vector")), F.count_if(chosen)).first()
    width = max(1, width or 0)
    coded = materialise(_encoded(numbered, width, bits), "codes")

    found = []
    blocks = ceil(count * width / sent)
    for block in range(blocks):
        own = numbered.where(chosen & (F.pmod(F.xxhash64("row"), F.lit(blocks)) == block)).select("row", "id", "label", "vector")
        met = own.toArrow().combine_chunks()
        if not met.num_rows:
            continue
        batch = met.to_batches()[0]
        rows_of, labels = batch.column("row").to_numpy(), batch.column("label").to_numpy()
        anchors = Anchors.of(rows_of, labels, matrix(batch.column("vector"), width), bits, planes)

        best = _ranked(_positives(coded, anchors, positives, width, bits), positives)
        best = materialise(best.select("anchor", F.col("rank").alias("slot"), "id", "score"), "positives")
        wanted = np.full((len(anchors.rows), positives), -1, dtype=np.int64)
        order = np.argsort(anchors.rows)
        taken_up = best.select("anchor", "slot", "score").toArrow()
        at = order[np.searchsorted(anchors.rows[order], taken_up.column("anchor").to_numpy())]
        wanted[at, taken_up.column("slot").to_numpy() - 1] = taken_up.column("score").to_numpy()

        hard = _ranked(_negatives(coded, anchors, wanted, negatives, least, width, bits), negatives)
        named = best.select(
            "anchor", (F.col("slot") - 1).alias("slot"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")
        )
        mined = hard.join(named, ["anchor", "slot"]).join(own.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id")), "anchor")
        columns = mined.select(
            "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score",
            F.col("score").alias("negative_score"),
        )
        found.append(materialise(columns, "hard-negatives"))
    if not found:
        return spark.createDataFrame(
            [], "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
        )
    return reduce(DataFrame.unionByName, found)
