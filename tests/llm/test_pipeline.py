"""The stages of the pipeline against plain versions on a small corpus."""

import re

import corpus_pipeline
import pytest

from tests.llm.test_operators import corpus, plain_components


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("sf"))
    rows = [(i, t, "en", f"src{i % 3}", len(t or "")) for i, t, *_ in corpus(8, 40)]
    junk = [(2000 + i, "| ".join(["THIS!!"] * (30 + i)), "en", "src0", 300) for i in range(40)]
    spark.createDataFrame(rows + junk, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{path}/documents.parquet")
    labels = [(r[0], 1, 0) for r in rows] + [(r[0], 0, 0) for r in junk]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(0, " ".join((rows[35][1] or "").split()[:30]))], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_stages_in_a_row(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    names, columns = [], docs.columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = {r.doc_id: r for r in docs.collect()}
        stage(spark, docs, sf_dir).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        after = {r.doc_id: r for r in docs.collect()}
        names.append(name)
        if name == "quality_classifier":
            assert max(after) < 2000 and len(after) == len(before) - 40
        if name == "exact_dedup":
            body = lambda r: re.sub(r"[\x20\x09-\x0D]", "", r.text or "")
            groups = {}
            for r in before.values():
                groups.setdefault(body(r), []).append((-len(r.text or ""), r.doc_id))
            assert set(after) == {min(g)[1] for g in groups.values()}
        if name == "ngram_jaccard_join":
            assert set(after) == {c for _, c in plain_components([(i, r.text) for i, r in before.items()]).values()}
        if name == "benchmark_decontamination":
            changed = {i for i in before if i not in after or after[i].text != before[i].text}
            assert changed and len(changed) < 6
        if name != "packing":
            assert docs.columns == columns
    assert names[-1] == "packing" and docs.groupBy("sequence_id").sum("length").where("`sum(length)` > 4096").count() == 0
    assert corpus_pipeline.run(spark, sf_dir).agg({"length": "sum"}).first()[0] == docs.agg({"length": "sum"}).first()[0]


@pytest.fixture(scope="module")
def clash_dir(spark, sf_dir, tmp_path_factory):
    """The same tables with columns named like those that the operators use, and repeated doc_ids."""
    from pyspark.sql import functions as F

    path = str(tmp_path_factory.mktemp("clash"))
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    docs = docs.union(docs.where("doc_id in (3, 4)").withColumn("text", F.concat("text", F.lit(" more words here for another row")))).union(docs.where("doc_id = 5"))
    for name in ("_node", "_digest", "_points", "_doc", "_set", "kept", "digest", "bits", "n"):
        docs = docs.withColumn(name, F.lit(name))
    docs.write.parquet(f"{path}/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{sf_dir}/{name}.parquet").write.parquet(f"{path}/{name}.parquet")
    return path


def test_columns_with_clashing_names_stay(spark, clash_dir):
    docs = spark.read.parquet(f"{clash_dir}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, clash_dir)
        assert kept.columns == docs.columns, name
        rows = kept.collect()
        assert rows and all(r[c] == c for r in rows for c in docs.columns[5:]), name


def test_empty_tables_give_no_pieces(spark, sf_dir, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{sf_dir}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).isEmpty()
