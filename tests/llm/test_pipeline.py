"""The pipeline beside one written plainly, in memory."""

from __future__ import annotations

import os

import pytest

import corpus_pipeline
import test_lines
import test_packing
import test_quality
import test_simhash
from tallywright.llm import quality
from tallywright.sources.scratch import materialize, scratch_root


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_stages_equal_the_plain_ones(spark, folder):
    sf_dir = folder
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    stats = materialize(quality.with_statistics(docs).select("doc_id", "stats"), "statistics")
    rules = quality.fit(stats, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    first = sorted((d, t) for d, t in rows if test_quality.kept_of(rules, test_quality.slow(t)))
    out, seen = docs, []
    for name, stage in corpus_pipeline.STAGES[:3]:
        out = materialize(stage(spark, out, sf_dir), name)
        assert out.columns == docs.columns
        seen.append(sorted((r["doc_id"], r["text"]) for r in out.collect()))
    assert seen[0] == first
    kept = seen[0]
    assert seen[1] == sorted((d, t) for (d, _), t in zip(kept, test_lines.slow(kept)))
    groups = test_simhash.slow_groups(seen[1])
    assert [d for d, _ in seen[2]] == sorted(d for d, _, component in groups if d == component)
    last = corpus_pipeline.STAGES[3][1](spark, out, sf_dir).collect()
    ids = dict(zip((d for d, _ in seen[2]), test_packing.slow_ids([t for _, t in seen[2]])))
    used = test_packing.check(last, ids, 1024)
    assert used <= 1.01 * -(-sum(map(len, ids.values())) // 1024) + 2


def test_run_leaves_one_table(spark, sf_dir):
    """What stages have stored is deleted behind them, and the rows are those of the stages."""
    folder = f"{scratch_root(spark)}/tallywright"
    before = set(os.listdir(folder)) if os.path.exists(folder) else set()
    packed = corpus_pipeline.run(spark, sf_dir)
    assert [name.split("-")[0] for name in set(os.listdir(folder)) - before] == ["best_fit_packing"]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:3]:
        docs = materialize(stage(spark, docs, sf_dir), "again")
    again = corpus_pipeline.STAGES[3][1](spark, docs, sf_dir)
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(packed.select(columns).collect()) == sorted(again.select(columns).collect())
