"""The pipeline over awkward documents, stage by stage and as a whole."""

import hashlib

import corpus_pipeline
from tests.llm.conftest import edge_rows
from tests.llm.test_operators import plain_groups


def test_stages(spark, edge, labels, empty, tmp_path):
    docs = edge.select("doc_id", "text", "lang", "source", "n_chars")
    for name, rows in (("full", docs), ("none", docs.limit(0))):
        d = str(tmp_path / name)
        rows.write.parquet(f"{d}/documents.parquet")
        labels.write.parquet(f"{d}/labels.parquet")
        out = corpus_pipeline.run(spark, d)
        assert {"doc_id", "n_tokens", "batch"} <= set(out.columns)
        assert (out.count() > 0) == (name == "full")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, str(tmp_path / "full")).columns == docs.columns, name


def test_one_document_of_each_group_stays(spark, edge):
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    docs = edge.select(*columns).union(spark.createDataFrame([(20, "a b c d e f g", "en", "s", 1), (20, "other words than those of the first", "en", "s", 1), (None, "a b c d e f g", None, None, 0), (None, "none has this text", None, None, 0), (-5, "none has this text", None, None, 0)], edge.select(*columns).schema))
    rows = sorted({(r.doc_id is None, r.doc_id or 0, r.text) for r in docs.collect()}, key=lambda r: (r[0], r[1], hashlib.sha256((r[2] or "").encode()).hexdigest() if r[2] is not None else ""))
    groups = plain_groups(dict(enumerate(r[2] for r in rows)).items(), 5, 80, 100)
    kept = [(r.doc_id, r.text) for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()]
    expected = [(None if rows[i][0] else rows[i][1], rows[i][2]) for i, (_, _, g) in groups.items() if g == i]
    assert sorted(kept, key=repr) == sorted(expected, key=repr)


def test_redaction_leaves_no_base_span(spark, edge):
    from quern.llm.pii import base_spans

    docs = edge.select("doc_id", "text", "lang", "source", "n_chars")
    out = corpus_pipeline.redaction(spark, docs, "").collect()
    assert len(out) == len(edge_rows()) and not any(base_spans(r.text or "") for r in out)
    assert all(r.n_chars == len(r.text) for r in out if r.text is not None)


def test_results_outlive_other_stages_and_other_runs(spark, edge, labels, tmp_path):
    docs, d = edge.select("doc_id", "text", "lang", "source", "n_chars"), str(tmp_path)
    docs.write.parquet(f"{d}/documents.parquet")
    labels.write.parquet(f"{d}/labels.parquet")
    docs = spark.read.parquet(f"{d}/documents.parquet")
    first = corpus_pipeline.quality(spark, docs, d)
    second = corpus_pipeline.near_duplicates(spark, docs, d)
    chained = corpus_pipeline.lines(spark, first, d)  # not written in between
    n = first.count()
    assert chained.count() == n and second.count() > 0
    path = str(tmp_path / "written")
    first.write.parquet(path)
    made = [x for x in corpus_pipeline._made_of[first.schema[0].metadata[corpus_pipeline.MARK]] if "/" in x]
    assert made
    assert corpus_pipeline.lines(spark, spark.read.parquet(path), d).count() == n
    assert first.schema[0].metadata[corpus_pipeline.MARK] not in corpus_pipeline._made_of and second.count() > 0
    one, two = corpus_pipeline.run(spark, d), corpus_pipeline.run(spark, d)
    assert one.count() == two.count() > 0
