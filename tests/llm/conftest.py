"""Odd documents every operator must take: nulls, empty and long texts, ties, copies, clashing columns."""

import pytest
from pyspark.sql import functions as F

PASSAGE = "alpha bravo charlie delta echo foxtrot golf hotel india juliet kilo lima mike november oscar"
FIELDS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
CLASHING = ("id", "key", "band", "words", "gone", "name", "label", "part", "digest", "_row", "_text", "spans", "grams")


def odd_rows():
    long = " ".join(f"w{i % 977}x{i % 31}" for i in range(2_500))
    texts = [
        None, "", " \t\n", "!!! ... ???", "a", "A b", "a  b", "one two three", f"start {PASSAGE} end",
        PASSAGE.upper(), f"{PASSAGE[:40]}, {PASSAGE[40:]}", long, long + " more", long.replace(" ", "\n"),
        "mail a.b+c@x-y.org, 10.0.0.1, 4111 1111 1111 1111, +1 (499) 555-6503", "x" * 5000,
        "Größe naïve çà ŉ İı ΑΣ' 中文 हिन्दी 😀 ×÷", "<|endoftext|> a<|startoftext|>b", "the the the the the the the the",
    ]
    rows = [(i, text, ("en", "de", None)[i % 3], None, len(text or "")) for i, text in enumerate(texts)]
    rows += [(100 + i, f"{PASSAGE} number {i} of many short copies", "en", "s", 9) for i in range(6)]
    rows += [(8, texts[8], "en", None, 1), (8, texts[8], "en", None, 1), (None, "a b", None, None, None), (None, None, None, None, None)]
    return rows


def clashing(df):
    return df.withColumns({name: F.lit(7) for name in CLASHING})


@pytest.fixture(scope="session")
def odd(spark):
    return clashing(spark.createDataFrame(odd_rows(), FIELDS)).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return clashing(spark.createDataFrame([], FIELDS))


@pytest.fixture(scope="session")
def items(spark):
    rows = [(1, PASSAGE), (2, PASSAGE), (3, "one two three"), (4, None), (5, ""), (None, PASSAGE), (10, "the"), (3, "A B")]
    return clashing(spark.createDataFrame(rows, "item_id bigint, text string").withColumn("doc_id", F.lit(1)))


@pytest.fixture(scope="session")
def odd_dir(spark, odd, items, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("odd"))
    odd.coalesce(1).write.parquet(f"{folder}/documents")
    items.coalesce(1).write.parquet(f"{folder}/benchmark")
    return folder
