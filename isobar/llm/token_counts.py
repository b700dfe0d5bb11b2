"""Token counts without a shuffle: a broadcast table first, worker caches behind it.

The lengths in tokens of the pre-tokens that a sample of the documents uses most are
broadcast. A task cuts its texts into pre-tokens, counts the distinct ones of a few
megabytes at a time, looks them up in the table, then in its worker's cache, and encodes
what is left. Neither changes a count: a pre-token that is in neither is encoded.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isobar.llm.arrow import CHUNK_BYTES, chunks, ship_package, text_bytes
from isobar.llm.pretokens import SPECIAL, UnitEncoder, unit_bytes, units, worker_encoder

#: Entries of the broadcast table, at most some 2 MB.
FREQUENT = 65_536
#: Expected rows of the sample the table is made of; it decides speed, never a count.
SAMPLE_ROWS = 4_000
#: Pre-tokens a worker remembers before it starts anew.
REMEMBERED = 500_000


def _lengths(encoder: UnitEncoder, values: list[bytes]) -> np.ndarray:
    return np.array([len(ids) for ids in encoder.units(values)], dtype=np.int64) // 4


def count_tokens(texts: pa.Array, encoder: UnitEncoder, frequent: pa.Array, lengths: np.ndarray) -> np.ndarray:
    """Tokens of each text; texts that may hold special tokens are encoded whole."""
    special = pc.match_substring(pc.fill_null(texts, ""), SPECIAL).to_numpy(zero_copy_only=False)
    plain = pc.if_else(pa.array(special), pa.scalar("", texts.type), texts)
    coded, firsts = units(plain)
    known = pc.index_in(coded.dictionary, value_set=frequent)
    places = pc.fill_null(known, -1).to_numpy(zero_copy_only=False)
    each = np.where(places >= 0, lengths[places], 0) if len(lengths) else np.zeros(len(places), np.int64)
    missing = np.flatnonzero(places < 0)
    each[missing] = _lengths(encoder, unit_bytes(coded.dictionary.take(pa.array(missing))))
    totals = np.concatenate([[0], np.cumsum(each[coded.indices.to_numpy()])])
    counts = totals[firsts[1:]] - totals[firsts[:-1]]
    for i in np.flatnonzero(special):
        counts[i] = len(encoder.whole(texts[int(i)].as_py())) // 4
    return counts


def _frequent_units(docs: DataFrame, text_col: str, entries: int, sample_rows: int) -> list[str]:
    """The units that a sample of the rows uses most."""
    rows = docs.count()
    if not rows:
        return []

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text"):
            coded, _ = units(batch.column("text"))
            if len(coded):
                seen = np.bincount(coded.indices.to_numpy(), minlength=len(coded.dictionary))
                often = pa.array((seen > 1) & (pc.binary_length(coded.dictionary).to_numpy() <= UnitEncoder.LONGEST))
                names = pc.filter(coded.dictionary, often).cast(pa.string())
                yield pa.RecordBatch.from_arrays([names, pc.filter(pa.array(seen, pa.int64()), often)], ["unit", "seen"])

    sample = docs.select(F.col(text_col).alias("text")).sample(min(1.0, sample_rows / rows), seed=11)
    counts: Counter[str] = Counter()
    for unit, seen in sample.mapInArrow(tally, "unit string, seen bigint").toLocalIterator():
        counts[unit] += seen
    return [unit for unit, _ in sorted(counts.items(), key=lambda item: (-item[1], item[0]))[:entries]]


def token_counts(
    docs: DataFrame,
    tokenizer: str,
    limit: int = 1024,
    id_col: str = "doc_id",
    text_col: str = "text",
    frequent: int = FREQUENT,
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """One row per input row: id, UTF-8 bytes, tokens, and whether they exceed ``limit``.

    ``tokenizer`` is the path of a byte-level BPE definition on the driver, which ships its
    content. Counts are the library's without added tokens; special tokens in a text are
    one token each, as the library takes them by default. Null and empty texts have none.
    Repeated rows each give a row; other columns are ignored.
    """
    spark = docs.sparkSession
    ship_package(spark)
    definition = Path(tokenizer).read_text(encoding="utf-8")
    common = _frequent_units(docs, text_col, frequent, sample_rows)
    table = spark.sparkContext.broadcast(
        (definition, common, _lengths(UnitEncoder(definition, 0), [unit.encode() for unit in common]))
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        definition, common, lengths = table.value
        encoder = worker_encoder(definition, REMEMBERED)
        values = pa.array(common, pa.large_string())
        for batch in chunks(batches, "text", 8 * CHUNK_BYTES):
            texts = batch.column("text")
            _, places = text_bytes(texts)
            counts = count_tokens(texts, encoder, values, lengths)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(np.diff(places)), pa.array(counts)], ["id", "n_bytes", "n_tokens"]
            )

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    counted = rows.mapInArrow(count, f"id {kind}, n_bytes bigint, n_tokens bigint")
    return counted.select(
        F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
