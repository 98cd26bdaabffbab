"""The pipeline's near-duplicate stage as one chain over one copy of the rows."""

import glob

import pyarrow.parquet as pq
from pyspark.sql import functions as F

import corpus_pipeline
from riskloom import session
from riskloom.llm.similar import common_shingles, lists_of, pairs_in_blocks, postings_of, without_similar
from riskloom.llm.simhash import without_near_duplicates


def test_stage_equals_its_two_steps_and_keeps_one_copy_of_the_texts(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    before = len(session._made.paths)
    kept = corpus_pipeline.simhash_near_dedup(spark, docs, sf)
    left = [p.rsplit("/", 1)[1].rsplit("-", 1)[0] for p in session._made.paths[before:]]
    assert left == ["rows", "leaving", "leaving"]
    want = without_similar(session.written_once(without_near_duplicates(docs), "first"))
    assert sorted(r.doc_id for r in kept.select("doc_id").collect()) == sorted(r.doc_id for r in want.select("doc_id").collect())
    assert kept.columns == docs.columns


def test_texts_are_not_shuffled_while_lists_meet(spark, tmp_path):
    """What meets carries marks that lie in a table of their own: the job that forms pairs reads no text."""
    words = [f"w{i}" for i in range(60)]
    spark.createDataFrame([(i, " ".join(words[:-1] + [f"x{i}"])) for i in range(9)], "node long, text string").write.parquet(f"{tmp_path}/texts")
    rows = spark.read.parquet(f"{tmp_path}/texts")
    sent = spark.sparkContext.broadcast(common_shingles(rows))
    lists = session.written_once(lists_of(postings_of(rows, sent)), "lists")
    rest = lists.select("gram", "node", "n", "p", "later", F.col("node").alias("root"), F.col("head").alias("top"))
    pairs = pairs_in_blocks(rest, rows, sent)
    assert pairs.count() == 36
    assert not set(pairs.inputFiles()) & set(rows.inputFiles())


def test_copies_of_whole_rows_are_packed(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for stage in (corpus_pipeline.exact_dedup, corpus_pipeline.simhash_near_dedup, corpus_pipeline.benchmark_decontamination):
        before = len(session._made.paths)
        stage(spark, docs, sf)
        copy = next(p for p in session._made.paths[before:] if p.rsplit("/", 1)[1].rsplit("-", 1)[0] in ("digests", "rows"))
        part = glob.glob(f"{copy.removeprefix('file:')}/*.parquet")[0]
        assert pq.ParquetFile(part).metadata.row_group(0).column(0).compression == "ZSTD"
