"""Near duplicates: a Jaccard join over word n-grams by MinHash banding.

Documents with one text are one node. Each text's signature is cut into bands, the
number and length of which follow from the wanted recall, and texts are shuffled on
their band hashes. Pairs are never listed within a bucket. Each member is compared, on
the full n-gram sets, with one leader of its bucket; the links found join the members.

A bucket whose members have not become one group may hide more links, between members
that are both unlike the leader. In a small bucket the members of different groups are
compared, so each has a bounded number of partners. In a large one they are joined on
prefixes: two sets with a similarity of t share one of the |x| - ceil(t |x|) + 1 rarest
n-grams of either, at places that leave room for the overlap. These links make the classes.

A link has both ends in one class, so the links of a text are counted within its class:
classes are dealt into blocks, every two blocks of a class meet in a task that compares
all their texts, and only the number of partners of each text leaves it.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isobar.llm.arrow import chunks, lists, ship_package
from isobar.llm.components import components
from isobar.llm.words import mixed, odd_numbers, shingles_of, words_of
from isobar.storage import materialise

WORDS = 5
SIMILARITY = 0.8
RECALL = 0.99
#: Hash functions that may be spent on a signature.
HASHES = 256
#: Members of a bucket that are compared directly; beyond, prefixes choose the pairs.
SMALL = 24
#: Texts, and bytes of text, in a block of a class whose links are counted.
BLOCK, BLOCK_BYTES = 512, 4 << 20
_PART, _COLUMNS = 2048, 4096


def choose_bands(similarity: float = SIMILARITY, recall: float = RECALL, hashes: int = HASHES) -> tuple[int, int]:
    """(bands, rows): the longest bands that find a pair at the threshold with ``recall``.

    A pair of similarity s shares a band with probability 1 - (1 - s^rows)^bands. Longer
    bands bring fewer chance meetings but need more of them.
    """
    best = (ceil(log(1 - recall) / log(1 - similarity)), 1)
    for rows in range(2, hashes + 1):
        chance = similarity**rows
        bands = ceil(log(1 - recall) / log(1 - chance))
        if bands * rows > hashes:
            break
        best = (bands, rows)
    return best


def _signature(grams: np.ndarray, factors: np.ndarray) -> np.ndarray:
    lowest = np.full(len(factors), np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(grams), _PART):
        part = grams[at : at + _PART]
        np.minimum(lowest, (part[None, :] * factors[:, None]).min(axis=1), out=lowest)
    return lowest


def _key(text: str) -> Column:
    return F.substring(F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")), 256)), 1, 16)


def signatures(rows: DataFrame, words: int, bands: int, length: int) -> DataFrame:
    """(key, grams, bands) of (key, text): the number of distinct n-grams, a hash per band."""
    ship_package(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors, band_factors = odd_numbers(bands * length, 1), odd_numbers(length, 2)
        band_number = odd_numbers(bands, 3)
        for batch in chunks(batches, "text"):
            grams, first = shingles_of(words_of(batch.column("text")), words)
            sizes, hashes = [], []
            for a, b in zip(first[:-1], first[1:], strict=True):
                own = np.unique(grams[a:b])
                sizes.append(len(own))
                if len(own):
                    rows = _signature(own, factors).reshape(bands, length)
                    hashes.append(mixed((rows * band_factors).sum(axis=1, dtype=np.uint64) ^ band_number))
            flat = np.concatenate(hashes).view(np.int64) if hashes else np.empty(0, np.int64)
            banded = lists(flat, np.concatenate([[0], np.cumsum((np.array(sizes) > 0) * bands)]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(sizes, pa.int32()), banded], ["key", "grams", "bands"]
            )

    return rows.mapInArrow(run, "key binary, grams int, bands array<bigint>")


def _verified(pairs: DataFrame, texts: DataFrame, words: int, similarity: float) -> DataFrame:
    """The pairs (a, b) whose full n-gram sets have a Jaccard similarity of ``similarity``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text_a"):
            left, first_a = shingles_of(words_of(batch.column("text_a")), words)
            right, first_b = shingles_of(words_of(batch.column("text_b")), words)
            keep = []
            for i in range(batch.num_rows):
                one = np.unique(left[first_a[i] : first_a[i + 1]])
                other = np.unique(right[first_b[i] : first_b[i + 1]])
                both = np.sort(np.concatenate([one, other]))
                common = int((both[1:] == both[:-1]).sum())
                keep.append(common >= similarity * (len(one) + len(other) - common))
            yield batch.filter(pa.array(keep, pa.bool_())).select(["a", "b"])

    sides = [texts.select(F.col("node").alias(c), F.col("text").alias(f"text_{c}")) for c in "ab"]
    # Joins that carry texts are planned alike at every size; AQE splits their hot keys.
    joined = pairs.hint("merge").join(sides[0], "a").hint("merge").join(sides[1], "b")
    joined = joined.select("a", "b", "text_a", "text_b")
    return joined.mapInArrow(run, "a bigint, b bigint")


def _alike_in_size(similarity: float) -> Column:
    return F.least("grams_a", "grams_b") >= similarity * F.greatest("grams_a", "grams_b")


def _sides(table: DataFrame, on: list[str]) -> tuple[DataFrame, DataFrame]:
    others = [name for name in table.columns if name not in on]
    left, right = (table.select(*on, *(F.col(c).alias(f"{c}_{side}") for c in others)) for side in "ab")
    return left, right


def _small_pairs(members: DataFrame, similarity: float) -> DataFrame:
    """(a, b) of members of one small bucket that are in different groups."""
    left, right = _sides(members.select("band", "node", "label", "grams"), ["band"])
    apart = (F.col("node_a") < F.col("node_b")) & (F.col("label_a") != F.col("label_b")) & _alike_in_size(similarity)
    return left.join(right, "band").where(apart).select(F.col("node_a").alias("a"), F.col("node_b").alias("b")).distinct()


def _sets(members: DataFrame, texts: DataFrame, words: int) -> DataFrame:
    """(node, sets): the n-grams of each member."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text"):
            grams, first = shingles_of(words_of(batch.column("text")), words)
            own = [np.unique(grams[a:b]).view(np.int64) for a, b in zip(first[:-1], first[1:], strict=True)]
            column = lists(np.concatenate(own), np.concatenate([[0], np.cumsum([len(x) for x in own])]))
            yield pa.RecordBatch.from_arrays([batch.column("node"), column], ["node", "sets"])

    chosen = texts.join(members.select("node").distinct(), "node", "left_semi").select("node", "text")
    return chosen.mapInArrow(run, "node bigint, sets array<bigint>")


def _large_pairs(members: DataFrame, texts: DataFrame, words: int, similarity: float) -> DataFrame:
    """(a, b) of members of one large bucket, of different groups, that share an n-gram of both prefixes.

    A pair is made once: in the first bucket the two share, at their first common n-gram.
    """
    sets = materialise(_sets(members, texts, words), "sets")
    grams = sets.select("node", F.explode("sets").alias("gram"))
    seen = grams.groupBy("gram").agg(F.count(F.lit(1)).alias("seen"))
    # The rarest n-grams come first; those of one text alone still take their places.
    order = F.array_sort(F.collect_list(F.struct("seen", "gram")))
    ranked = grams.join(seen, "gram").groupBy("node").agg(order.alias("order"))
    size = F.size("order")
    prefix = F.slice("order", F.lit(1), size - F.ceil(size * similarity).cast("int") + 1)
    prefixes = materialise(ranked.select("node", prefix.alias("prefix")), "prefixes")
    own = members.groupBy("node", "label", "grams").agg(F.array_sort(F.collect_set("band")).alias("bands"))
    tokens = own.join(prefixes, "node").select(
        "node", "label", "grams", "bands", F.posexplode("prefix").alias("at", "token"),
        F.transform(F.filter("prefix", lambda t: t["seen"] > 1), lambda t: t["gram"]).alias("prefix"),
    )
    placed = tokens.where("token.seen > 1").withColumn("gram", F.col("token.gram")).drop("token")
    placed = materialise(placed.withColumn("band", F.explode("bands")), "placed")
    left, right = _sides(placed, ["band", "gram"])
    # The overlap that the similarity asks for must fit behind the first common n-gram.
    overlap = F.ceil((F.col("grams_a") + F.col("grams_b")) * similarity / (1 + similarity) - 1e-9)
    room = F.least(F.col("grams_a") - F.col("at_a"), F.col("grams_b") - F.col("at_b"))
    apart = (F.col("node_a") < F.col("node_b")) & (F.col("label_a") != F.col("label_b")) & _alike_in_size(similarity)
    first = (F.get(F.array_intersect("prefix_a", "prefix_b"), F.lit(0)) == F.col("gram")) & (
        F.get(F.array_intersect("bands_a", "bands_b"), F.lit(0)) == F.col("band")
    )
    pairs = left.join(right, ["band", "gram"]).where(apart & (room >= overlap) & first)
    return pairs.select(F.col("node_a").alias("a"), F.col("node_b").alias("b"))


def _open_members(buckets: DataFrame, labels: DataFrame) -> DataFrame:
    """The members of buckets that hold more than one group, with their groups."""
    named = labels.withColumnRenamed("node", "known")
    grouped = buckets.join(named, F.col("node") == F.col("known"), "left")
    grouped = materialise(
        grouped.select("band", "node", "grams", "members", F.coalesce("label", "node").alias("label")), "grouped"
    )
    mixed_up = grouped.groupBy("band").agg(F.min("label").alias("low"), F.max("label").alias("high"))
    open_bands = materialise(mixed_up.where("low <> high").select("band"), "open")
    return materialise(grouped.join(open_bands, "band", "left_semi"), "open-members")


def _common(grams: np.ndarray, owners: np.ndarray, texts: int, split: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of each text, and how many of them each text shares with each from ``split`` on.

    The rows are the texts before ``split``, or all if it is 0.
    """
    order = np.lexsort((owners, grams))
    grams, owners = grams[order], owners[order]
    fresh = np.ones(len(grams), dtype=bool)
    fresh[1:] = (grams[1:] != grams[:-1]) | (owners[1:] != owners[:-1])
    grams, owners = grams[fresh], owners[fresh]
    sizes = np.bincount(owners, minlength=texts)
    _, column, holders = np.unique(grams, return_inverse=True, return_counts=True)
    shared = holders > 1
    keep = shared[column]
    owners, column = owners[keep], (np.cumsum(shared) - 1)[column[keep]]
    common = np.zeros((split or texts, texts - split))
    for at in range(0, int(shared.sum()), _COLUMNS):
        a, b = np.searchsorted(column, [at, at + _COLUMNS])
        held = np.zeros((texts, _COLUMNS), dtype=np.float32)
        held[owners[a:b], column[a:b] - at] = 1
        common += held[: split or texts] @ held[split:].T
    return sizes, common


def _link_counts(labels: DataFrame, texts: DataFrame, words: int, similarity: float) -> DataFrame:
    """(node, n_links): the texts that each text is similar to, from all pairs within its class."""
    members = materialise(labels.join(texts, "node").select("label", "node", "text"), "members")
    blocks = F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK), F.ceil(F.sum(F.octet_length("text")) / BLOCK_BYTES))
    classes = members.groupBy("label").agg(F.count(F.lit(1)).alias("nodes"), blocks.cast("int").alias("blocks"))
    classes = materialise(classes, "class-sizes")
    # The two texts of a class of two are linked; larger classes are compared.
    dealt = members.join(classes.where("nodes > 2"), "label")
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    dealt = dealt.select("label", "node", "text", "block", other).select(
        "label", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "node", "text"
    )

    def count(met: pa.Table) -> pa.Table:
        met = met.sort_by("block")
        nodes, own = met.column("node"), met.column("block").to_numpy()
        split = int((own == own[0]).sum()) if met.column("low")[0] != met.column("high")[0] else 0
        if split == len(own):
            return pa.table({"node": nodes, "n": pa.array([0] * len(own), pa.int64())})
        grams, sizes = [], []
        for batch in chunks(met.to_batches(), "text"):
            found, first = shingles_of(words_of(batch.column("text")), words)
            grams.append(found)
            sizes.append(np.diff(first))
        owners = np.repeat(np.arange(len(own)), np.concatenate(sizes))
        distinct, common = _common(np.concatenate(grams), owners, len(own), split)
        rows, columns = distinct[: split or len(own)], distinct[split:]
        alike = common >= similarity * (rows[:, None] + columns[None, :] - common)
        if split:
            found = np.concatenate([alike.sum(axis=1), alike.sum(axis=0)])
        else:
            np.fill_diagonal(alike, False)
            found = alike.sum(axis=1)
        return pa.table({"node": nodes, "n": pa.array(found.astype(np.int64))})

    compared = dealt.groupBy("label", "low", "high").applyInArrow(count, "node bigint, n bigint")
    compared = compared.groupBy("node").agg(F.sum("n").alias("n_links"))
    twos = labels.join(classes.where("nodes = 2").select("label"), "label").select("node", F.lit(1).cast("long"))
    return compared.unionAll(twos)


def near_duplicates(
    docs: DataFrame,
    words: int = WORDS,
    similarity: float = SIMILARITY,
    recall: float = RECALL,
    id_col: str = "doc_id",
    text_col: str = "text",
    links: bool = True,
) -> DataFrame:
    """One row per input row: id, ``class_id``, ``class_size``, ``n_links``, ``n_copies``.

    A class is a connected group of texts that are similar to each other, directly or
    through others; ``class_id`` is its smallest id and ``class_size`` its rows.
    ``n_links`` is the number of different texts of the class that the text is similar
    to, from all pairs of the class. ``n_copies`` counts the rows with the very same text. Texts of fewer than ``words`` words are compared as one n-gram. Texts
    without words, null or empty, link to nothing but their copies. Without ``links`` they
    are not counted, which spares the comparison of all pairs of a class. Other columns are
    ignored; an empty table gives an empty result.
    """
    bands, length = choose_bands(similarity, recall)
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.select("id", _key("text").alias("key"), "text")
    # Copies have one signature; a task drops those of its own before the shuffle.
    signed = signatures(rows.select("key", "text"), words, bands, length).dropDuplicates(["key"])
    signed = materialise(signed.withColumn("node", F.monotonically_increasing_id()), "signatures")

    banded = signed.select("node", "grams", F.explode("bands").alias("band"))
    leaders = banded.groupBy("band").agg(F.min("node").alias("leader"), F.count(F.lit(1)).alias("members"))
    leaders = materialise(leaders.where("members > 1"), "leaders")
    buckets = materialise(banded.join(leaders, "band"), "buckets")
    pairs = buckets.where("node <> leader").select(F.col("leader").alias("a"), F.col("node").alias("b")).distinct()
    pairs = materialise(pairs, "leader-pairs")

    compared = signed.join(buckets.select("node").distinct(), "node", "left_semi").select("key", "node")
    compared = materialise(compared, "compared")
    # Each task drops its copies of a text before any is shuffled, so no key is hot.
    texts = rows.select("key", "text").dropDuplicates(["key"]).join(compared.hint("merge"), "key").select("node", "text")
    texts = materialise(texts, "texts")
    linked = materialise(_verified(pairs, texts, words, similarity), "links")

    open_members = _open_members(buckets, components(linked))
    small = _small_pairs(open_members.where(F.col("members") <= SMALL), similarity)
    large = _large_pairs(open_members.where(F.col("members") > SMALL), texts, words, similarity)
    late = materialise(small.unionByName(large).distinct().join(pairs, ["a", "b"], "left_anti"), "late-pairs")
    linked = materialise(linked.unionByName(_verified(late, texts, words, similarity)), "links")

    ids = materialise(rows.select("id", "key"), "ids")
    labels = components(linked)
    nodes = ids.groupBy("key").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n_copies"))
    nodes = nodes.join(signed.select("key", "node"), "key")
    nodes = nodes.join(labels, "node", "left")
    if links:
        nodes = nodes.join(materialise(_link_counts(labels, texts, words, similarity), "link-counts"), "node", "left")
    nodes = materialise(nodes.withColumn("label", F.coalesce("label", "node")), "nodes")
    classes = nodes.groupBy("label").agg(F.min("first").alias("class_id"), F.sum("n_copies").alias("class_size"))
    known = materialise(nodes.join(classes, "label").drop("label", "first", "node"), "classes")
    counts = [F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links")] if links else []
    return ids.join(known, "key").select(F.col("id").alias(id_col), "class_id", "class_size", *counts, "n_copies")
