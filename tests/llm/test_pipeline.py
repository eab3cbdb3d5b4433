"""The pipeline against its stages one by one in plain Python."""

import os
import subprocess
import sys

import corpus_pipeline
from skyrisk.llm import quality_gbt, quality_rules
from tests.llm.test_simhash import slow_components, slow_fingerprint

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def test_stages(spark, sf_small, docs, labels):
    out, frames = docs, []
    for name, stage in corpus_pipeline.STAGES:
        from skyrisk.session import scratch_path
        path = scratch_path(spark, "p")
        stage(spark, out, sf_small).write.parquet(path)
        out = spark.read.parquet(path)
        frames.append(out)
    passed, good, single, clean, packed = frames
    for f in frames[:-1]:
        assert f.dtypes == docs.dtypes
    judged = {r["doc_id"] for r in quality_rules.judged(docs, labels).where("kept").collect()}
    assert {r["doc_id"] for r in passed.collect()} == judged
    liked = {r["doc_id"] for r in quality_gbt.classified(passed, labels).where("predicted = 1").collect()}
    assert {r["doc_id"] for r in good.collect()} == liked
    rows = [(r["doc_id"], slow_fingerprint(r["text"])) for r in good.collect()]
    assert {r["doc_id"] for r in single.collect()} == set(slow_components(rows))
    before, after = ({r["doc_id"]: r for r in f.collect()} for f in (single, clean))
    assert before.keys() == after.keys()
    assert all(r["n_chars"] == len(r["text"]) for r in after.values())
    assert {r["doc_id"] for r in packed.collect()} == set(after)
    whole = corpus_pipeline.run(spark, sf_small).groupBy("doc_id").sum("length").collect()
    assert sorted(map(tuple, whole)) == sorted(map(tuple, packed.groupBy("doc_id").sum("length").collect()))


def test_odd_tables(spark, odd_docs, empty_docs, sf_small):
    for docs in (odd_docs, empty_docs):
        for _, stage in corpus_pipeline.STAGES:
            assert stage(spark, docs, sf_small).count() <= max(1, 40 * docs.count())


def test_entry_without_the_subpackage():
    code = ("import sys; sys.modules['skyrisk.llm'] = None\n"
            "import __spark_entry__ as e; q = e.queries(); assert 'kpi_summary' in q and not any(n.startswith('op') and n[2].isdigit() for n in q)\n"
            "assert set(e.oracle_sql()) <= set(q)")
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True)


def test_whole_run_on_odd_and_empty_tables(spark, tmp_path, odd_docs, empty_docs, odd_labels, no_labels):
    for name, docs, labels in (("odd", odd_docs, odd_labels), ("empty", empty_docs, no_labels)):
        at = tmp_path / name
        flat = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))]).selectExpr("c0 doc_id", "c1 text", "c2 lang", "c3 source", "c4 n_chars")
        flat.write.parquet(str(at / "documents.parquet"))
        labels.write.parquet(str(at / "labels.parquet"))
        pieces = corpus_pipeline.run(spark, str(at))
        assert {r["doc_id"] for r in pieces.collect()} <= {r["doc_id"] for r in flat.collect()}
        if name == "empty":
            assert pieces.count() == 0
