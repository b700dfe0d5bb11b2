"""Exact duplicates by deterministic block naming.

A text, its white space normalised, is cut into blocks of a fixed number of bytes.
The distinct blocks are sorted and numbered, so that equal blocks, and no others,
share an integer name. Then the names of neighbouring blocks are paired and the
distinct pairs numbered the same way, until one name is left for each document: two
documents of equally many blocks have the same last name exactly if their texts are
equal.

Text is shuffled once, to find the distinct blocks. Documents meet the names through a
64-bit route of the block. A route that only one distinct block has proves which block
it was; blocks that share a route are joined on their bytes instead.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isobar.storage import materialise

BLOCK_BYTES = 4096
WHITE_SPACE = r"[\x20\x09-\x0D]+"


def normalised(text: str) -> Column:
    """The text with every run of ASCII white space as one space; null is empty."""
    return F.regexp_replace(F.coalesce(F.col(text), F.lit("")), WHITE_SPACE, " ")


def _blocks(rows: DataFrame, block_bytes: int) -> DataFrame:
    """A row per block; an empty text is one empty block."""
    last = F.greatest(F.lit(0), F.floor((F.octet_length("body") - 1) / block_bytes)).cast("int")
    cut = rows.select("id", "digest", "body", F.explode(F.sequence(F.lit(0), last)).alias("at"))
    return cut.select(
        "id", "digest", F.col("at").cast("long").alias("at"),
        F.expr(f"substring(body, at * {block_bytes} + 1, {block_bytes})").alias("block"),
    )


def _named(distinct: DataFrame, columns: list[str]) -> DataFrame:
    """Number sorted distinct rows. Each partition holds whole keys in sorted order, so
    a task that runs again gives the same numbers."""
    return distinct.sortWithinPartitions(*columns).withColumn("name", F.monotonically_increasing_id())


def _first_names(blocks: DataFrame) -> DataFrame:
    """(id, digest, at, name) of every block."""
    # dropDuplicates drops a task's repeated blocks before they are shuffled.
    distinct = blocks.select("route", "block").dropDuplicates()
    per_route = _named(distinct, ["route", "block"]).groupBy("route")
    routes = materialise(per_route.agg(F.min("name").alias("name"), F.count(F.lit(1)).alias("blocks")), "routes")
    proven = routes.where("blocks = 1").drop("blocks")
    found = blocks.drop("block").join(proven, "route").select("id", "digest", "at", "name")
    shared = routes.where("blocks > 1").select("route")
    if shared.isEmpty():
        return found
    clashing = _named(distinct.join(shared, "route", "left_semi"), ["route", "block"])
    clashing = materialise(clashing.withColumn("name", -1 - F.col("name")), "clashing")
    exact = blocks.join(clashing, ["route", "block"]).select("id", "digest", "at", "name")
    return found.unionByName(exact)


def _pair_names(names: DataFrame) -> DataFrame:
    """Halve the names of documents that have more than one."""
    key = ["id", "digest", "blocks", F.expr("at div 2").alias("at")]
    left, right = (F.max(F.when(F.col("at") % 2 == side, F.col("name"))) for side in (0, 1))
    pairs = materialise(
        names.groupBy(*key).agg(left.alias("left"), F.coalesce(right, F.lit(-1)).alias("right")), "pairs"
    )
    distinct = materialise(_named(pairs.select("left", "right").distinct(), ["left", "right"]), "pair-names")
    return pairs.join(distinct, ["left", "right"]).select("id", "digest", "blocks", "at", "name")


def identities(rows: DataFrame, block_bytes: int, route: Callable[[str], Column]) -> DataFrame:
    """(id, digest, blocks, name): equal (blocks, name) means equal texts.

    ``rows`` has (id, digest, body), each combination of id and digest once or more.
    """
    blocks = _blocks(rows, block_bytes).withColumn("route", route("block"))
    # Repeated rows of one id and text name the same blocks again; one is enough.
    first = _first_names(blocks).groupBy("id", "digest", "at").agg(F.min("name").alias("name"))
    first = materialise(first, "first-names")
    counts = first.groupBy("id", "digest").agg(
        F.count(F.lit(1)).alias("blocks"), F.min(F.when(F.col("at") == 0, F.col("name"))).alias("name")
    )
    done = counts.where("blocks = 1").select("id", "digest", "blocks", "name")
    long = counts.where("blocks > 1").drop("name").alias("c")
    same = F.col("f.id").eqNullSafe(F.col("c.id")) & (F.col("f.digest") == F.col("c.digest"))
    left = first.alias("f").join(long, same).select("f.id", "f.digest", "c.blocks", "f.at", "f.name")
    left = materialise(left, "long-names")
    width = left.agg(F.max("blocks")).first()[0] or 1
    while width > 1:
        left = _pair_names(left)
        width = (width + 1) // 2
        # Texts of fewer blocks keep being paired with nothing, which changes no equality.
        left = materialise(left, "named")
    return done.unionByName(left.select("id", "digest", "blocks", "name"))


def exact_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    block_bytes: int = BLOCK_BYTES,
    route: Callable[[str], Column] = F.xxhash64,
) -> DataFrame:
    """One row per input row: id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Null texts equal empty ones. ``keep_id`` is the smallest id of the rows with an
    equal text; a null id is never the smallest unless all are null. Rows repeated under
    one id count in ``group_size`` and share the decision. Other columns of ``docs`` are
    ignored. An empty table gives an empty result.
    """
    body = docs.select(F.col(id_col).alias("id"), normalised(text_col).alias("body"))
    rows = body.select("id", F.unhex(F.sha2("body", 256)).alias("digest"), F.encode("body", "UTF-8").alias("body"))
    named = identities(rows, block_bytes, route).alias("n")
    counted = rows.groupBy("id", "digest").agg(F.count(F.lit(1)).alias("rows")).alias("r")
    same = F.col("n.id").eqNullSafe(F.col("r.id")) & (F.col("n.digest") == F.col("r.digest"))
    texts = materialise(
        counted.join(named, same).select("r.id", "r.digest", "r.rows", "n.blocks", "n.name"), "identities"
    )
    groups = materialise(
        texts.groupBy("blocks", "name").agg(F.min("id").alias("keep_id"), F.sum("rows").alias("group_size")),
        "groups",
    )
    each = texts.join(groups, ["blocks", "name"]).withColumn("_", F.explode(F.expr("sequence(1L, rows)")))
    return each.select(
        F.col("id").alias(id_col), "keep_id", "group_size",
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"),
    )
