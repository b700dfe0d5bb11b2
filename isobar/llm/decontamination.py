"""Benchmark passages in documents: a prefix-filtered set join over word shingles.

Every window of an item (``window`` consecutive words, or the whole of a shorter item)
is a set of shingles at known places. Shingles are ordered by how often the documents
hold them, and as a window must be contained whole, its rarest shingle alone is the
necessary prefix. Documents are joined on these prefix shingles only; the place of the
shingle in the window gives the one position where the window can start, and the words
there are compared one by one.

A document is read three times and never shuffled: to count shingles, to find prefix
shingles, to count words. Only the words around a prefix shingle leave the scan.
"""

from __future__ import annotations

import string
from functools import reduce
from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from isobar.storage import materialise

WINDOW = 13
SHINGLE = 4
#: Prefix shingles broadcast at once: eight bytes each, so about 32 MB as a hash table.
#: More are taken in blocks, with one pass over the documents for each block.
BROADCAST_SHINGLES = 1_000_000

_BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _pieces(text: Column) -> Column:
    """The words between two ends, either of which may be empty; a word never is."""
    return F.split(text, _BETWEEN_WORDS, -1)


def _lower_ascii(words: Column) -> Column:
    return F.transform(words, lambda w: F.translate(w, string.ascii_uppercase, string.ascii_lowercase))


def _shingle_hash(words: str, at: str, size: int) -> Column:
    """Of words in upper case, which ignores more than A-Z and, unlike lower case, no context."""
    return F.xxhash64(F.lit(size), *(F.expr(f"get({words}, {at} + {i})") for i in range(size)))


def item_windows(items: DataFrame, item_col: str, text_col: str, window: int) -> DataFrame:
    """(item_id, size, words) of each window of each item."""
    words = F.filter(_lower_ascii(_pieces(F.col(text_col))), lambda w: w != "")
    each = items.select(F.col(item_col).alias("item_id"), words.alias("all")).where(F.size("all") > 0)
    size = F.least(F.size("all"), F.lit(window))
    starts = each.select("item_id", "all", size.alias("size"), F.explode(F.sequence(F.lit(1), F.size("all") - size + 1)).alias("at"))
    return starts.select("item_id", "size", F.slice("all", F.col("at"), F.col("size")).alias("words"))


def _window_shingles(windows: DataFrame) -> DataFrame:
    """(window_id, size, words, length, shift, shingle): all shingles of all windows."""
    length = F.least(F.col("size"), F.lit(SHINGLE))
    shifts = windows.withColumn("length", length).withColumn(
        "shift", F.explode(F.expr("sequence(0, size - length)"))
    )
    lowered = shifts.withColumn("folded", F.transform("words", F.upper))
    hashed = reduce(
        lambda column, n: F.when(F.col("length") == n, _shingle_hash("folded", "shift", n)).otherwise(column),
        range(1, SHINGLE + 1),
        F.lit(None).cast("long"),
    )
    return lowered.withColumn("shingle", hashed).drop("folded")


def _positions(docs: DataFrame, length: int, *carry: str) -> DataFrame:
    """A row per shingle of a document, with its place ``at`` among the pieces."""
    last = F.greatest(F.size("folded") - length, F.lit(-1))
    exploded = docs.where(F.size("folded") >= length).withColumn("at", F.explode(F.sequence(F.lit(0), last)))
    return exploded.select(*carry, "at", _shingle_hash("folded", "at", length).alias("shingle"))


def _rarity(docs: DataFrame, shingles: DataFrame, lengths: list[int]) -> DataFrame:
    """(shingle, seen): how often the documents hold each shingle of the benchmark."""
    wanted = materialise(shingles.select("shingle").distinct(), "shingles")
    seen = None
    for block in _broadcastable(wanted):
        for length in lengths:
            hits = _positions(docs, length).join(F.broadcast(block), "shingle", "left_semi")
            counts = hits.groupBy("shingle").agg(F.count(F.lit(1)).alias("seen"))
            seen = counts if seen is None else seen.unionByName(counts)
    return seen


def _broadcastable(shingles: DataFrame) -> list[DataFrame]:
    """Parts of a stored table of distinct shingles, each small enough to broadcast."""
    blocks = max(1, ceil(shingles.count() / (BROADCAST_SHINGLES * 0.9)))
    if blocks == 1:
        return [shingles]
    return [shingles.where(F.pmod(F.xxhash64("shingle"), F.lit(blocks)) == n) for n in range(blocks)]


def window_hits(
    docs: DataFrame, windows: DataFrame, window: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, text_key, start, size, window_id) of every place where a document holds a window.

    ``windows`` is a stored table of distinct (window_id, size, words).
    """
    text = F.col(text_col)
    rows = docs.select(
        F.col(id_col).alias("id"), F.xxhash64(text).alias("text_key"),
        _pieces(text).alias("pieces"), _pieces(F.upper(text)).alias("folded"),
    ).where(text.isNotNull())
    shingles = materialise(_window_shingles(windows), "window-shingles")
    lengths = sorted(row[0] for row in shingles.select("length").distinct().collect())
    if not lengths:
        kind = rows.schema["id"].dataType.simpleString()
        schema = f"id {kind}, text_key bigint, start int, size int, window_id bigint"
        return docs.sparkSession.createDataFrame([], schema)

    seen = materialise(_rarity(rows, shingles, lengths), "rarity")
    ranked = shingles.join(seen, "shingle", "left").withColumn("seen", F.coalesce("seen", F.lit(0)))
    # A window with a shingle that no document holds occurs nowhere.
    order = F.struct("seen", "shift", "shingle")
    rarest = ranked.groupBy("window_id").agg(F.min(order).alias("rarest")).where("rarest.seen > 0")
    prefixes = materialise(
        rarest.select("window_id", "rarest.shingle", "rarest.shift").join(windows, "window_id"), "prefixes"
    )

    wanted = materialise(prefixes.select("shingle").distinct(), "prefix-shingles")
    reach = 2 * window
    around = F.expr(f"slice(pieces, greatest(at - {window} + 1, 0) + 1, {reach})")
    found = []
    for block in _broadcastable(wanted):
        for length in lengths:
            near = _positions(rows, length, "id", "text_key", "pieces").join(
                F.broadcast(block), "shingle", "left_semi"
            )
            found.append(near.select("id", "text_key", "shingle", "at", around.alias("around")))
    candidates = reduce(DataFrame.unionByName, found).join(prefixes, "shingle")
    start = F.expr("at - shift")
    begin = F.expr(f"at - shift - greatest(at - {window} + 1, 0) + 1")
    there = candidates.withColumn("start", start).where("start >= 0").withColumn("begin", begin)
    held = F.expr("slice(around, begin, size)")
    whole = there.where(F.col("begin") >= 1).where(_lower_ascii(held) == F.col("words"))
    return whole.select("id", "text_key", "start", "size", "window_id").distinct()


def _covered(hits: DataFrame) -> DataFrame:
    """(id, text_key, n_hit): words inside at least one window."""
    places = hits.select("id", "text_key", "start", (F.col("start") + F.col("size")).alias("end"))
    earlier = Window.partitionBy("id", "text_key").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    fresh = F.greatest(F.col("start"), F.coalesce(F.max("end").over(earlier), F.lit(0)))
    new = places.distinct().withColumn("new", F.greatest(F.lit(0), F.col("end") - fresh))
    return new.groupBy("id", "text_key").agg(F.sum("new").alias("n_hit"))


def contamination(
    docs: DataFrame,
    items: DataFrame,
    window: int = WINDOW,
    share: int = 20,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """One row per document: words, words inside benchmark windows, and the items found.

    ``contaminated`` when 1/``share`` of the words or more are inside windows. A null or
    empty text has no words and is clean; a null or empty item has no windows, and a null
    item id is left out of the item list. Items that share a window are all found. Rows
    repeated under one id each give a row. Other columns are ignored, and an empty
    benchmark leaves every document clean.
    """
    each = materialise(item_windows(items, item_col, item_text_col, window), "item-windows")
    windows = materialise(
        each.select("size", "words").distinct().sortWithinPartitions("words").withColumn(
            "window_id", F.monotonically_increasing_id()
        ),
        "windows",
    )
    hits = materialise(window_hits(docs, windows, window, id_col, text_col), "window-hits")
    owners = materialise(each.join(windows, ["size", "words"]).select("window_id", "item_id").distinct(), "owners")

    found = hits.select("id", "text_key", "window_id").distinct().join(owners, "window_id")
    per_doc = found.select("id", "text_key", "item_id").where("item_id is not null").distinct()
    names = F.array_sort(F.collect_list(F.col("item_id").cast("string")))
    listed = per_doc.groupBy("id", "text_key").agg(
        F.count(F.lit(1)).alias("n_items"), F.sha2(F.array_join(names, ","), 256).alias("items_sha256")
    )
    covered = _covered(hits)
    report = materialise(covered.join(listed, _same(covered, listed), "left").select(
        covered["id"], covered["text_key"], "n_hit", "n_items", "items_sha256"), "hits")

    text = F.col(text_col)
    words = F.coalesce(F.regexp_count(text, F.lit(_WORD)), F.lit(0)).cast("long")
    base = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("text_key"), words.alias("n_words"))
    n_hit, n_items = (F.coalesce(report[c], F.lit(0)).cast("long") for c in ("n_hit", "n_items"))
    joined = base.join(report, _same(base, report), "left")
    return joined.select(
        base["id"].alias(id_col), "n_words", n_hit.alias("n_hit"), n_items.alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
        ((n_hit > 0) & (share * n_hit >= F.col("n_words"))).alias("contaminated"),
    )


def _same(left: DataFrame, right: DataFrame) -> Column:
    return left["id"].eqNullSafe(right["id"]) & (left["text_key"] == right["text_key"])
