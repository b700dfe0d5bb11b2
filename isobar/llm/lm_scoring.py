"""Masked pseudo-likelihood of documents under a small bidirectional window network.

Every word is predicted from the words on both sides of it. The network, written in
numpy, adds up embeddings of the neighbours, weighed by their distance, and gives a
distribution over word classes; within a class, words have their share of the corpus.
Frequent words are classes of their own, the others are spread over classes by hash. The
shares of the frequent words go out to the tasks; words too rare for that get theirs by a
join with the counts, in which no key is hot. A
document's score is the sum of the log probabilities of all its words.

Vocabulary and class shares are counted over all documents. With them every document is
written once as the codes of its words, from which training and scoring read; neither
touches a text again. Training takes all documents: in each round every task starts from
the same weights and learns from its own documents, at every ``stride``-th word, and the
rounds take turns; then the tasks' weights are averaged, a bounded number at a time, and
sent out again.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isobar.llm.arrow import chunks, list_chunks, lists, ship_package
from isobar.llm.words import words_of
from isobar.storage import materialise

#: Words with an embedding of their own, and hashed embeddings for all others.
VOCABULARY, OTHERS = 8192, 256
#: Words whose counts go out to the tasks, about; rarer ones are joined with theirs.
SENT = 1 << 18
#: Words that are a class of their own, and classes that share the rest.
SINGLE, SHARED = 64, 64
WIDTH = 16
REACH = 2
ROUNDS = 2
#: Every so many words one is learned from in a round, another in each; as many as rounds, so that all are learned from.
STRIDE = ROUNDS
#: Tasks whose weights are averaged in one step, and weights of one row.
FAN_IN, SLICE = 64, 16_384
#: Words of a gradient step, and words scored at once, whose logits fit the processor's cache.
_STEP, _BLOCK = 1024, 2048
#: Words handled at once, a longer document alone.
_WORDS = 1 << 18
_RATE = 0.3


@dataclass(frozen=True)
class Vocabulary:
    """Sorted hashes of the kept words, their rank by count, and log shares within classes."""

    hashes: np.ndarray
    ranks: np.ndarray
    log_share: np.ndarray  # by rank
    log_rest: np.ndarray  # by shared class: all words without a rank together
    sent: np.ndarray  # sorted hashes of more words, without a rank or with one
    log_sent: np.ndarray  # log counts of these
    log_unranked: np.ndarray  # by shared class: log count of all words without a rank, and one for unseen words

    def ids(self, words: np.ndarray) -> np.ndarray:
        """Ranks, and hashed numbers behind them for words without one."""
        unknown = len(self.ranks) + (words % np.uint64(OTHERS)).astype(np.int64)
        if not len(self.hashes):
            return unknown
        at = np.minimum(np.searchsorted(self.hashes, words), len(self.hashes) - 1)
        return np.where(self.hashes[at] == words, self.ranks[at], unknown)

    def classes(self, words: np.ndarray, ids: np.ndarray) -> np.ndarray:
        single = ids < min(SINGLE, len(self.ranks))
        return np.where(single, ids, SINGLE + _shared_class(words))

    def codes(self, words: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """One number for a word's embedding and class: its rank, or both behind the ranks."""
        behind = len(self.ranks) + (ids - len(self.ranks)) * SHARED + _shared_class(words)
        return np.where(ids < len(self.ranks), ids, behind).astype(np.int32)

    def decoded(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The embeddings and the classes of coded words."""
        kept = len(self.ranks)
        behind = np.maximum(codes - kept, 0)
        # Few enough for 16 bits, which sort fastest.
        ids = np.where(codes < kept, codes, kept + behind // SHARED).astype(np.int32 if kept > 30_000 else np.int16)
        by_rank = np.empty(kept, dtype=np.int64)
        by_rank[self.ranks] = SINGLE + _shared_class(self.hashes)
        by_rank[:SINGLE] = np.arange(min(SINGLE, kept))
        classes = np.where(codes < kept, by_rank[np.minimum(codes, kept - 1)] if kept else 0, SINGLE + behind % SHARED)
        return ids, classes

    def within(self, ids: np.ndarray, classes: np.ndarray) -> np.ndarray:
        known = ids < len(self.ranks)
        rest = self.log_rest[np.maximum(classes - SINGLE, 0)]
        return np.where(known, self.log_share[np.where(known, ids, 0)] if len(self.ranks) else 0.0, rest)

    def among_rest(self, words: np.ndarray, ids: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Log share of each word among the words without a rank, and where its log count is still to be added."""
        logs, far = np.zeros(len(words)), np.zeros(len(words), dtype=bool)
        places = np.flatnonzero(ids >= len(self.ranks))
        rare = words[places]
        logs[places] = -self.log_unranked[classes[places] - SINGLE]
        far[places] = True
        if len(self.sent):
            at = np.minimum(np.searchsorted(self.sent, rare), len(self.sent) - 1)
            here = self.sent[at] == rare
            logs[places[here]] += self.log_sent[at[here]]
            far[places[here]] = False
        return logs, far


def _shared_class(words: np.ndarray) -> np.ndarray:
    return ((words >> np.uint64(32)) % np.uint64(SHARED)).astype(np.int64)


def count_words(docs: DataFrame, text_col: str) -> DataFrame:
    """(word, n) over all documents, words as signed hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text"):
            words, number = np.unique(words_of(batch.column("text")).hashes, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(number)], ["word", "n"])

    texts = docs.select(F.col(text_col).alias("text"))
    return texts.mapInArrow(run, "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def _sent(counted: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes and log counts of the words at least as frequent as a limit that at most SENT words reach."""
    level = F.floor(F.log2("n") * 4).cast("int")
    sizes = sorted(counted.groupBy(level.alias("level")).count().collect(), reverse=True)
    above = np.cumsum([row["count"] for row in sizes])
    chosen = int((above <= SENT).sum())
    if not chosen:
        return np.empty(0, dtype=np.uint64), np.empty(0)
    found = counted.where(level >= sizes[chosen - 1]["level"]).toArrow()
    hashes = found.column("word").to_numpy().view(np.uint64)
    order = np.argsort(hashes)
    return hashes[order], np.log(found.column("n").to_numpy()[order])


def vocabulary(docs: DataFrame, text_col: str, size: int, counted: DataFrame | None = None) -> Vocabulary:
    if counted is None:
        counted = materialise(count_words(docs, text_col), "word-counts")
    top = [tuple(row) for row in counted.orderBy(F.desc("n"), "word").limit(size).collect()]
    hashes = np.array([row[0] for row in top], dtype=np.int64).view(np.uint64)
    number = np.array([row[1] for row in top], dtype=np.float64)
    shared = F.pmod(F.shiftrightunsigned("word", 32), F.lit(SHARED)).cast("int").alias("class")
    totals = np.zeros(SHARED)
    for place, n in counted.groupBy(shared).agg(F.sum("n")).collect():
        totals[place] = n
    own = _shared_class(hashes)
    single = np.arange(len(hashes)) < SINGLE
    np.subtract.at(totals, own[single], number[single])
    known = np.bincount(own[~single], weights=number[~single], minlength=SHARED)
    # One more than counted for words never seen, so that no probability is zero.
    rest = totals - known + 1
    share = np.where(single, 1.0, number / (totals + 1)[own]) if len(own) else np.empty(0)
    order = np.argsort(hashes)
    log_rest = np.log(rest / (totals + 1))
    return Vocabulary(hashes[order], order.astype(np.int64), np.log(share), log_rest, *_sent(counted), np.log(rest))


@dataclass
class Network:
    """Embeddings, a weight vector for each distance, and the output layer."""

    embeddings: np.ndarray
    distances: np.ndarray
    bias: np.ndarray
    output: np.ndarray
    output_bias: np.ndarray

    @staticmethod
    def fresh(inputs: int) -> Network:
        random = np.random.default_rng(17)
        draw = lambda *shape: (random.standard_normal(shape) * 0.1).astype(np.float32)
        classes = SINGLE + SHARED
        return Network(
            draw(inputs, WIDTH), np.ones((2 * REACH, WIDTH), dtype=np.float32), np.zeros(WIDTH, dtype=np.float32),
            draw(WIDTH, classes), np.zeros(classes, dtype=np.float32),
        )

    def _parts(self) -> list[np.ndarray]:
        return [self.embeddings, self.distances, self.bias, self.output, self.output_bias]

    def flat(self) -> np.ndarray:
        return np.concatenate([part.ravel() for part in self._parts()])

    def replaced(self, flat: np.ndarray) -> Network:
        parts, at = [], 0
        for part in self._parts():
            parts.append(flat[at : at + part.size].reshape(part.shape).astype(np.float32))
            at += part.size
        return Network(*parts)

    def _hidden(self, around: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        near = np.take(self.embeddings, around, axis=0)
        return near, np.tanh(np.einsum("ndw,dw->nw", near, self.distances) + self.bias)

    def log_classes(self, around: np.ndarray, classes: np.ndarray) -> np.ndarray:
        """Log probability of each row's class, given the ids around it."""
        _, hidden = self._hidden(around)
        logits = hidden @ self.output + self.output_bias
        logits -= logits.max(axis=1, keepdims=True)
        own = logits[np.arange(len(classes)), classes]
        return own - np.log(np.exp(logits, out=logits).sum(axis=1))

    def learn(self, around: np.ndarray, classes: np.ndarray, rate: float) -> None:
        """One gradient step on a small batch."""
        near, hidden = self._hidden(around)
        logits = hidden @ self.output + self.output_bias
        logits = np.exp(logits - logits.max(axis=1, keepdims=True))
        error = logits / logits.sum(axis=1, keepdims=True)
        error[np.arange(len(classes)), classes] -= 1
        back = (error @ self.output.T) * (1 - hidden**2)
        size = np.float32(len(classes))
        flat = around.ravel()
        order = np.argsort(flat, kind="stable")
        sorted_ids = flat[order]
        starts = np.flatnonzero(np.concatenate([[True], sorted_ids[1:] != sorted_ids[:-1]]))
        ids, number = sorted_ids[starts], np.diff(np.append(starts, len(flat)))
        pulls = np.take((back[:, None, :] * self.distances).reshape(-1, WIDTH), order, axis=0)
        summed = np.add.reduceat(pulls, starts, axis=0)
        self.output -= rate * (hidden.T @ error) / size * 4
        self.output_bias -= rate * error.sum(axis=0) / size * 4
        self.distances -= rate * np.einsum("ndw,nw->dw", near, back) / size
        self.bias -= rate * back.sum(axis=0) / size
        self.embeddings[ids] -= rate * summed / np.sqrt(number)[:, None].astype(np.float32)


def _around(ids: np.ndarray, first: np.ndarray, pad: int) -> np.ndarray:
    """The ids at the distances -REACH to REACH without 0; ``pad`` beyond the ends of a text."""
    counts = np.diff(first)
    # Every text between two runs of pads: a neighbour is then a plain shift.
    places = np.arange(len(ids)) + np.repeat(REACH * np.arange(1, len(counts) + 1), counts)
    padded = np.full(len(ids) + REACH * (len(counts) + 1), pad, dtype=ids.dtype)
    padded[places] = ids
    return np.stack([padded[places + d] for d in [*range(-REACH, 0), *range(1, REACH + 1)]], axis=1)


def encode(docs: DataFrame, words: Vocabulary, id_col: str, text_col: str) -> DataFrame:
    """(id, codes, shares, far): the words of each document as codes, the sum of the log shares
    within their classes, and the words whose log count is still to be added to it."""
    shared = docs.sparkSession.sparkContext.broadcast(words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = shared.value
        for batch in chunks(batches, "text"):
            own = words_of(batch.column("text"))
            ids = words.ids(own.hashes)
            classes = words.classes(own.hashes, ids)
            shares, far = words.among_rest(own.hashes, ids, classes)
            totals = np.concatenate([[0.0], np.cumsum(shares + words.within(ids, classes))])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"), lists(words.codes(own.hashes, ids), own.first),
                    pa.array(totals[own.first[1:]] - totals[own.first[:-1]]),
                    lists(own.hashes[far].view(np.int64), np.concatenate([[0], np.cumsum(far)])[own.first]),
                ],
                ["id", "codes", "shares", "far"],
            )

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, codes array<int>, shares double, far array<bigint>")


def _codes(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    column = batch.column("codes")
    ends = column.offsets.to_numpy()
    return column.flatten().to_numpy(), (ends - ends[0]).astype(np.int64)


def _averaged(parts: DataFrame, size: int) -> np.ndarray:
    """The mean of the tasks' weights, each by the words it learned from."""

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        weights = rows["weight"].to_numpy()
        total = sum(np.asarray(v) * w for v, w in zip(rows["values"], weights, strict=True))
        whole = weights.sum()
        return pd.DataFrame(
            {"slice": [rows["slice"].iloc[0]], "part": [rows["part"].iloc[0] // FAN_IN], "weight": [whole],
             "values": [(total / whole).astype(np.float32)]}
        )

    left = materialise(parts, "weights")
    while True:
        shape = left.select("part").agg(F.max("part"), F.countDistinct("part")).first()
        if shape[1] <= 1:
            break
        group = F.expr(f"part div {FAN_IN}").alias("group")
        left = materialise(left.groupBy("slice", group).applyInPandas(add, parts.schema), "weights")
    flat = np.zeros(size, dtype=np.float32)
    for row in left.collect():
        flat[row["slice"] * SLICE : row["slice"] * SLICE + len(row["values"])] = row["values"]
    return flat


def train(coded: DataFrame, words: Vocabulary, rounds: int = ROUNDS, stride: int = STRIDE) -> Network:
    """``coded`` is a stored table of codes."""
    spark = coded.sparkSession
    pad = len(words.ranks) + OTHERS
    network = Network.fresh(pad + 1)
    size = len(network.flat())
    for number in range(rounds):
        shared = spark.sparkContext.broadcast((words, network))

        def learn(batches: Iterator[pa.RecordBatch], number: int = number, shared=shared) -> Iterator[pa.RecordBatch]:
            words, network = shared.value
            network, learned = network.replaced(network.flat()), 0
            rate = np.float32(_RATE / (1 + number))
            for batch in list_chunks(batches, "codes", _WORDS):
                codes, first = _codes(batch)
                ids, classes = words.decoded(codes)
                places = np.arange(number % stride, len(ids), stride)
                # In a fixed random order, so that a step sees many documents.
                places = places[np.random.default_rng(number).permutation(len(places))]
                around = _around(ids, first, pad)
                for at in range(0, len(places), _STEP):
                    step = places[at : at + _STEP]
                    network.learn(around[step], classes[step], rate)
                learned += len(places)
            if learned:
                flat = network.flat()
                slices = [flat[at : at + SLICE] for at in range(0, len(flat), SLICE)]
                count = len(slices)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(range(count), pa.int32()), pa.array([TaskContext.get().partitionId()] * count, pa.int64()),
                        pa.array([float(learned)] * count), pa.array(slices, pa.list_(pa.float32())),
                    ],
                    ["slice", "part", "weight", "values"],
                )

        parts = coded.select("codes").mapInArrow(learn, "slice int, part bigint, weight double, values array<float>")
        flat = _averaged(parts, size)
        if flat.any():
            network = network.replaced(flat)
    return network


def score(coded: DataFrame, words: Vocabulary, counted: DataFrame, network: Network) -> DataFrame:
    """(id, n_words, log_likelihood) of a stored table of codes with row numbers."""
    shared = coded.sparkSession.sparkContext.broadcast((words, network))
    pad = len(words.ranks) + OTHERS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, network = shared.value
        for batch in list_chunks(batches, "codes", _WORDS):
            codes, first = _codes(batch)
            ids, classes = words.decoded(codes)
            around, logs = _around(ids, first, pad), np.zeros(len(ids))
            for at in range(0, len(ids), _BLOCK):
                block = slice(at, at + _BLOCK)
                logs[block] = network.log_classes(around[block], classes[block])
            totals = np.concatenate([[0.0], np.cumsum(logs)])
            sums = totals[first[1:]] - totals[first[:-1]] + batch.column("shares").to_numpy()
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("id"), pa.array(np.diff(first)), pa.array(sums)],
                ["row", "id", "n_words", "log_likelihood"],
            )

    kind = coded.schema["id"].dataType.simpleString()
    scored = coded.select("row", "id", "codes", "shares").mapInArrow(
        run, f"row bigint, id {kind}, n_words bigint, log_likelihood double"
    )
    missing = coded.select("row", F.explode("far").alias("word")).join(counted, "word")
    missing = missing.groupBy("row").agg(F.sum(F.log("n")).alias("more"))
    whole = F.col("log_likelihood") + F.coalesce("more", F.lit(0.0))
    return scored.join(missing, "row", "left").select("id", "n_words", whole.alias("log_likelihood"))


def pseudo_likelihood(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = VOCABULARY,
    rounds: int = ROUNDS,
    stride: int = STRIDE,
) -> DataFrame:
    """One row per input row: id, words, the sum of log probabilities, and its mean by word.

    A text without words, null or empty, has the sum 0 and no mean. Words beyond the
    ``size`` most frequent share their embeddings; every word is scored by its own share
    of its class, which keeps a count of one for unseen words. Repeated rows each
    give a row and count in training; other columns are ignored. An empty table gives an
    empty result.
    """
    ship_package(docs.sparkSession)
    counted = materialise(count_words(docs, text_col), "word-counts")
    words = vocabulary(docs, text_col, size, counted)
    coded = encode(docs, words, id_col, text_col).withColumn("row", F.monotonically_increasing_id())
    coded = materialise(coded, "codes")
    network = train(coded, words, rounds, stride)
    scored = score(coded, words, counted, network)
    return scored.select(
        F.col("id").alias(id_col), "n_words", "log_likelihood",
        (F.col("log_likelihood") / F.nullif("n_words", F.lit(0))).alias("mean_log_likelihood"),
    )
