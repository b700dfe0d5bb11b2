"""The stages, each against a plain version, and the whole on odd rows."""

import re
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from isobar.llm.quality import quality_scores
from isobar.llm.queries import learned_labels
from tests.llm.test_near_duplicates import classes_by_hand


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def kept(df):
    return sorted(row.doc_id for row in df.collect())


def test_stages_and_columns(spark, docs, sf_dir):
    assert [name for name, _ in pipeline.STAGES] == ["quality", "exact_dedup", "near_dedup", "decontamination", "packing"]
    for _, stage in pipeline.STAGES[:-1]:
        assert stage(spark, docs, sf_dir).columns == docs.columns


def test_quality_keeps_what_is_predicted_good(spark, docs, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    wanted = quality_scores(docs, labels, learned_labels()).where("predicted = 1")
    assert kept(pipeline.quality(spark, docs, sf_dir)) == kept(wanted)


def test_exact_dedup_keeps_the_first(spark, docs, sf_dir):
    first = {}
    for row in sorted(docs.collect(), key=lambda r: r.doc_id):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", row.text or ""), row.doc_id)
    assert kept(pipeline.exact_dedup(spark, docs, sf_dir)) == sorted(first.values())


def test_near_dedup_keeps_one_of_each_group(spark, docs, sf_dir):
    classes = classes_by_hand([(row.doc_id, row.text) for row in docs.collect()])
    assert kept(pipeline.near_dedup(spark, docs, sf_dir)) == sorted(set(classes.values()))


def test_decontamination_keeps_the_clean(spark, docs, sf_dir):
    def words(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))

    windows = set()
    for row in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect():
        own = words(row.text)
        windows |= {tuple(own[i : i + 13]) for i in range(max(1, len(own) - 12))} if own else set()
    clean = []
    for row in docs.collect():
        own, hit = words(row.text), set()
        for size in {len(w) for w in windows}:
            for i in range(len(own) - size + 1):
                if tuple(own[i : i + size]) in windows:
                    hit |= set(range(i, i + size))
        if not hit or 20 * len(hit) < len(own):
            clean.append(row.doc_id)
    found = kept(pipeline.decontamination(spark, docs, sf_dir))
    assert found == sorted(clean) and len(found) < docs.count()


def test_the_whole_run(spark, sf_dir):
    pieces = pipeline.run(spark, sf_dir)
    whole = pieces.groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("tokens"))
    assert whole.count() > 50 and whole.where("n <> tokens").count() == 0


def test_odd_rows_pass_all_stages(spark, odd, sf_dir):
    left = odd
    for name, stage in pipeline.STAGES[:-1]:
        left = stage(spark, left, sf_dir)
        assert left.columns == odd.columns, name
    texts = Counter(re.sub(r"\s+", " ", row.text or "") for row in left.collect())
    assert texts and max(texts.values()) == 1
    assert pipeline.packing(spark, left, sf_dir).agg(F.sum("length")).first()[0] > 0


def test_an_empty_table_passes_all_stages(spark, nothing, sf_dir):
    left = nothing
    for _, stage in pipeline.STAGES:
        left = stage(spark, left, sf_dir)
    assert left.count() == 0


def test_an_empty_benchmark_keeps_everything(spark, odd, tmp_path):
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert pipeline.decontamination(spark, odd, str(tmp_path)).count() == odd.count()


@pytest.mark.parametrize(("block", "blocks"), [(3, 1000), (3, 1), (500_000, 8)], ids=["blocks", "merge", "one"])
def test_dropped_rows_go_whatever_their_number(spark, odd, monkeypatch, block, blocks):
    """The list of dropped rows in many blocks, by a shuffled join, and in one block."""
    monkeypatch.setattr(pipeline, "BLOCK", block)
    monkeypatch.setattr(pipeline, "BLOCKS", blocks)
    rows, row = pipeline._known(odd)
    gone = rows.where("text is null or length(text) % 2 = 0")
    left = pipeline._without(rows, row, gone)
    assert left.columns == odd.columns
    wanted = sorted(map(str, odd.where("length(text) % 2 = 1").collect()))
    assert sorted(map(str, left.collect())) == wanted


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_text_is_shuffled_to_drop_rows(spark, docs, sf_dir):
    assert "Exchange" not in plan_of(pipeline.quality(spark, docs, sf_dir))
    for stage in (pipeline.near_dedup, pipeline.decontamination):
        plan = plan_of(stage(spark, docs, sf_dir))
        assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_stages_leave_no_scratch_tables(spark, sf_dir):
    from isobar.storage import scratch_root

    folder = Path(scratch_root(spark).removeprefix("file://"))
    before = {path.name for path in folder.iterdir()}
    pipeline.run(spark, sf_dir)
    made = {path.name for path in folder.iterdir()} - before
    assert len(made) == len(pipeline.STAGES) and all(name.startswith("stage-") for name in made)
