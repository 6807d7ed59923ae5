"""The stages on edge cases and against what they are made of."""

import collections
import os

import corpus_pipeline as P
from pyspark.sql import functions as F


def test_stage_list():
    assert [name for name, _ in P.STAGES] == ["quality_rules", "line_dedup", "near_duplicates", "mixing", "packing"]


def test_stages_keep_the_columns_of_documents(spark, edge_docs, no_docs):
    for docs in (edge_docs, no_docs):
        for name, stage in P.STAGES[:-1]:
            out = stage(spark, docs, "")
            assert out.columns == docs.columns, name
            assert all((r["kept"], r["n_lines"], r["size"], r["score"]) == ("x", "y", 7, 0.5) for r in out.collect()), name
            assert out.count() <= 3 * docs.count()
        assert {"doc_id", "piece", "sequence_id", "offset"} <= set(P.STAGES[-1][1](spark, docs, "").columns)


def test_decisions_take_effect(spark, many_docs):
    good = P.keep_good(spark, many_docs, "")
    assert good.where(F.col("text").contains("###")).count() == 0 and good.count() > 150
    lines = P.drop_lines(spark, many_docs, "").collect()
    assert len(lines) == 240 and sum("This page was made for all of you." in r["text"] for r in lines) == 1
    assert all(r["n_chars"] == len(r["text"]) for r in lines)
    single = P.drop_near_duplicates(spark, many_docs, "")
    assert single.select("text").distinct().count() == single.count() < 240
    times = collections.Counter(r["doc_id"] for r in P.mix_sources(spark, many_docs, "").collect())
    assert set(times.values()) <= {1, 2, 3} and len(times) < 240


def test_whole_run_on_edges_and_nothing(spark, edge_docs, no_docs, tmp_path):
    for name, docs in (("edges", edge_docs), ("nothing", no_docs)):
        docs.write.parquet(str(tmp_path / name / "documents.parquet"))
        rows = P.run(spark, str(tmp_path / name)).collect()
        assert bool(rows) == (name == "edges") and all(0 < r["length"] <= 2048 for r in rows)
        folder = spark.sparkContext.getCheckpointDir()
        assert not [f for f in os.listdir(folder.removeprefix("file:")) if f.startswith("pipeline-")]


def test_whole_run(spark, many_docs, tmp_path):
    many_docs.write.parquet(str(tmp_path / "documents.parquet"))
    rows = P.run(spark, str(tmp_path)).collect()
    ends = collections.defaultdict(list)
    for r in rows:
        ends[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in ends.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
