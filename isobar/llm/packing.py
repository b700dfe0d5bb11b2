"""Concatenate and cut: documents end to end, cut into sequences of a fixed length.

First pass: every task encodes its documents, stores the ids with each document's place
among the task's tokens, and so the total of each partition. The running total over the
partitions is where each partition starts. Second pass: global places are sums of the
two, and the boundaries of the fixed windows cut a document into pieces by slicing its
stored ids; that pass is plain column expressions.

Only the last sequence of all is short, so padding is less than one sequence.
"""

from __future__ import annotations

from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from isobar.llm.arrow import chunks, give_back_memory, ship_package
from isobar.llm.pretokens import SPECIAL, UnitEncoder, unit_bytes, units, worker_encoder
from isobar.storage import materialise

LENGTH = 2048
#: The id that ends each document.
END = 1
#: Units a worker remembers before it starts anew.
REMEMBERED = 250_000
#: Partitions of the first pass whose totals are summed by one task.
BLOCK = 4096


def encode_texts(texts: pa.Array, encoder: UnitEncoder) -> list[bytes]:
    """The ids of each text as little-endian unsigned 32-bit numbers."""
    special = pc.match_substring(pc.fill_null(texts, ""), SPECIAL).to_numpy(zero_copy_only=False)
    coded, firsts = units(pc.if_else(pa.array(special), pa.scalar("", texts.type), texts))
    each = encoder.units(unit_bytes(coded.dictionary))
    sizes = np.array([len(ids) for ids in each], dtype=np.int64) // 4
    flat = np.frombuffer(b"".join(each), dtype="<u4")
    starts = np.cumsum(sizes) - sizes
    order = coded.indices.to_numpy()
    ends = np.concatenate([[0], np.cumsum(sizes[order])])
    # Token j of the chunk is token j - (first of its unit here) of that unit's ids.
    shift = np.repeat(starts[order] - ends[:-1], sizes[order])
    ids = flat[shift + np.arange(ends[-1])]
    places = ends[firsts]
    out = [ids[a:b].tobytes() for a, b in zip(places[:-1], places[1:], strict=True)]
    for i in np.flatnonzero(special):
        out[i] = encoder.whole(texts[int(i)].as_py())
    return out


def encode(docs: DataFrame, tokenizer: str, end: int, id_col: str, text_col: str) -> DataFrame:
    """(id, part, before, tokens, ids): a document's ids, and the tokens before it in its partition."""
    spark = docs.sparkSession
    ship_package(spark)
    definition = spark.sparkContext.broadcast(Path(tokenizer).read_text(encoding="utf-8"))
    last = np.array([end], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back_memory()
        encoder, part, total = worker_encoder(definition.value, REMEMBERED), TaskContext.get().partitionId(), 0
        for batch in chunks(batches, "text"):
            ids = [one + last for one in encode_texts(batch.column("text"), encoder)]
            sizes = np.array([len(one) for one in ids], dtype=np.int64) // 4
            before = total + np.cumsum(sizes) - sizes
            total += int(sizes.sum())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array([part] * len(ids), pa.int64()), pa.array(before), pa.array(sizes),
                 pa.array(ids, pa.binary())],
                ["id", "part", "before", "tokens", "ids"],
            )

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, part bigint, before bigint, tokens bigint, ids binary")


def _partition_starts(encoded: DataFrame) -> DataFrame:
    """(part, base): tokens in all earlier partitions; blocks of partitions are summed first."""
    totals = encoded.groupBy("part").agg(F.sum("tokens").alias("total"))
    totals = totals.withColumn("block", F.expr(f"part div {BLOCK}"))
    earlier = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = totals.groupBy("block").agg(F.sum("total").alias("all"))
    blocks = blocks.select("block", F.coalesce(F.sum("all").over(earlier), F.lit(0)).alias("block_base"))
    inside = Window.partitionBy("block").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    placed = totals.withColumn("inner", F.coalesce(F.sum("total").over(inside), F.lit(0)))
    return placed.join(blocks, "block").select("part", (F.col("inner") + F.col("block_base")).alias("base"))


def pack(
    docs: DataFrame,
    tokenizer: str,
    length: int = LENGTH,
    end: int = END,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per piece: where it lies in its document and in its sequence, and its ids.

    Documents follow each other in the order of the input's partitions. A null or empty
    text is its end token alone. Repeated rows are packed as often as they come; other
    columns are ignored. An empty table gives no pieces.
    """
    encoded = materialise(encode(docs, tokenizer, end, id_col, text_col), "token-ids")
    starts = materialise(_partition_starts(encoded), "partition-starts")
    placed = encoded.join(starts, "part").withColumn("at", F.col("base") + F.col("before"))
    last = F.expr(f"(at + tokens - 1) div {length}")
    cut = placed.withColumn("sequence_id", F.explode(F.sequence(F.expr(f"at div {length}"), last)))
    start = F.greatest(F.lit(0), F.col("sequence_id") * length - F.col("at"))
    stop = F.least(F.col("tokens"), (F.col("sequence_id") + 1) * length - F.col("at"))
    pieces = cut.withColumn("start", start).withColumn("length", stop - start)
    ids = F.expr("substring(ids, cast(4 * start + 1 as int), cast(4 * length as int))")
    return pieces.select(
        F.col("id").alias(id_col), "start", "length", ids.alias("ids"), F.col("tokens").alias("doc_tokens"),
        "sequence_id", (F.col("at") + F.col("start") - F.col("sequence_id") * length).alias("offset"),
    )
