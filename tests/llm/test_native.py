"""The operators that SQL expresses, against that SQL and on odd rows."""

from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from isobar.llm import oracles, queries
from isobar.llm.decontamination import contamination
from isobar.llm.exact_dedup import exact_groups
from isobar.llm.pii import find_pii, pii_digest
from tests.oracle import assert_same, connect


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def odd_duck(odd_dir):
    connection = duckdb.connect()
    for name in ("documents", "benchmark"):
        connection.execute(f"create view {name} as select * from '{odd_dir}/{name}/*.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_matches_sql(name, spark, sf_dir):
    assert assert_same(queries.queries()[name](spark, sf_dir), connect(sf_dir), queries.oracle_sql()[name]) > 0


@pytest.mark.parametrize(
    ("operator", "sql"),
    [
        (exact_groups, oracles.EXACT_DEDUP),
        (lambda docs: exact_groups(docs, block_bytes=16), oracles.EXACT_DEDUP),
        # Every block shares its route with all others, so the bytes alone tell them apart.
        (lambda docs: exact_groups(docs, block_bytes=512, route=lambda block: F.length(block) % 2), oracles.EXACT_DEDUP),
        (pii_digest, oracles.PII),
    ],
    ids=["dedup", "dedup-small-blocks", "dedup-shared-routes", "pii"],
)
def test_odd_rows_match_sql(operator, sql, odd, odd_duck):
    assert_same(operator(odd), odd_duck, sql)


def test_contamination_of_odd_rows_matches_sql(odd, items, odd_duck):
    found = contamination(odd, items)
    assert_same(found, odd_duck, oracles.contamination())
    by_id = {row.doc_id: row for row in found.collect()}
    assert by_id[9].contaminated and by_id[8].n_items == 2  # letter case is ignored; a null item has no name
    assert by_id[18].n_hit == 8 and by_id[7].n_items == 1


def test_contamination_with_small_broadcast_blocks(odd, items, odd_duck, monkeypatch):
    monkeypatch.setattr("isobar.llm.decontamination.BROADCAST_SHINGLES", 2)
    assert_same(contamination(odd, items), odd_duck, oracles.contamination())


def test_an_empty_benchmark_leaves_all_clean(odd, items):
    rows = contamination(odd, items.where("false")).collect()
    assert len(rows) == odd.count() and not any(row.contaminated for row in rows)


def test_empty_tables(nothing, items):
    assert exact_groups(nothing).count() == pii_digest(nothing).count() == contamination(nothing, items).count() == 0


def test_pii_reads_a_row_once_without_python_or_shuffle(odd):
    plan = plan_of(find_pii(odd.select("doc_id", "text")))
    assert "Python" not in plan and "Arrow" not in plan and plan.count("Exchange") <= 1  # the fixture's own


def spans_of(spark, text):
    rows = find_pii(spark.createDataFrame([(1, text)], "doc_id int, text string")).first().spans
    return [(row.kind, text[row.start : row.end], round(row.score, 1)) for row in rows]


def test_validators_and_context(spark):
    text = "IBAN DE89370400440532013000 or DE89370400440532013001, card 4111111111111111 or 4111111111111112, 999.1.1.1"
    assert spans_of(spark, text) == [("card", "4111111111111111", 0.9), ("iban", "DE89370400440532013000", 1.0)]
    assert spans_of(spark, "my ssn 123-45-6789")[0][:2] == ("ssn", "123-45-6789")
    assert spans_of(spark, "lot 123-45-6789") == [] == spans_of(spark, "ssn 000-45-6789")


def test_long_runs_stay_linear(spark):
    text = "a" * 200_000 + " " + "1." * 50_000 + " " + "7 " * 50_000 + "+" + "1" * 50_000 + " x@y.zz" * 3000
    assert Counter(kind for kind, _, _ in spans_of(spark, text)) == {"ip": 12_500, "email": 3000}


def test_spans_count_code_points(spark):
    assert spans_of(spark, "😀é a@b.cc 😀 1.2.3.4")[0][1] == "a@b.cc"


def test_context_on_both_sides(spark):
    assert spans_of(spark, "123-45-6789 is my ssn") == [("ssn", "123-45-6789", 0.5)]
    # Also beyond another match of the kind, on either side.
    both = spans_of(spark, "ssn 123-45-6789 and 223-45-6789 only")
    assert [text for _, text, _ in both] == ["123-45-6789", "223-45-6789"]
    assert spans_of(spark, "123-45-6789" + " x" * 30 + " ssn") == []


def test_account_numbers_in_groups(spark):
    text = "pay to DE89 3704 0044 0532 0130 00 or ES91 2100 0418 4502 0005 1332 please, not DE89 3704 0044 0532 0130 01"
    found = [span for span in spans_of(spark, text) if span[0] == "iban"]
    assert [t for _, t, _ in found] == ["DE89 3704 0044 0532 0130 00", "ES91 2100 0418 4502 0005 1332"]


def test_many_spans_with_context(spark):
    text = " ".join(f"user{i}@mail.org wrote 123-45-{i % 9000 + 1000}" for i in range(20_000))
    assert Counter(kind for kind, _, _ in spans_of(spark, text))["email"] == 20_000
