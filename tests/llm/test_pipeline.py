import shutil

import duckdb
import pytest

import __spark_entry__ as entry_points
import corpus_pipeline
from logtally.llm import decontamination, ngram_join, quality
from tests.conftest import TESTDATA
from tests.llm.cases import PASSAGE, documents


def test_stages_keep_columns_and_pieces_cover_what_is_left(spark):
    docs = spark.read.parquet(f"{TESTDATA}/documents.parquet")
    columns, sizes = docs.columns, [docs.count()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.saved(stage(spark, docs, TESTDATA), "test")
        assert docs.columns == columns
        sizes.append(docs.count())
    assert sizes == sorted(sizes, reverse=True) and 0 < sizes[-1] < sizes[0]
    texts = [r["text"] for r in docs.collect()]
    assert len(set(texts)) == len(texts)
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, TESTDATA)
    assert {r["doc_id"] for r in pieces.select("doc_id").collect()} == {r["doc_id"] for r in docs.collect()}


def test_an_empty_table_passes_through(spark, tmp_path):
    for table in ("labels", "benchmark"):
        shutil.copy(f"{TESTDATA}/{table}.parquet", tmp_path / f"{table}.parquet")
    spark.read.parquet(f"{TESTDATA}/documents.parquet").limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_an_awkward_table_passes_through(spark, tmp_path):
    """Of nulls, repeats, near copies, benchmark passages and long texts, the right rows are packed."""
    documents(spark).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, PASSAGE), (None, None)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in pieces} == {None, 2, 3, 5, 6, 10, 12, 13, 14, 15}
    assert sum(r["length"] for r in pieces) == sum({r["doc_id"]: r["doc_tokens"] for r in pieces}.values())


@pytest.mark.parametrize("name", ["op1_exact_dedup", "op2_chat_formatting", "op9_ngram_jaccard_join", "op11_centroid_clustering", "op12_conversation_repair"])
def test_sql_gives_the_same_rows(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "conversations", "embeddings"):
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{TESTDATA}/{table}.parquet'")
    want = connection.sql(entry_points.oracle_sql()[name])
    columns = sorted(want.columns)
    got = entry_points.queries()[name](spark, TESTDATA).select(*columns).collect()
    assert sorted(map(tuple, got)) == sorted(want.select(*columns).fetchall())


CLEAN = [(None, "clean words without any id at all"), (5, "clean words that share their id with other ones"), (7, "one more clean text of its own")]


def kept(df):
    return sorted(((r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()), key=repr)


def test_a_contaminated_row_takes_no_other_row_along(spark):
    rows = documents(spark, [(None, PASSAGE), (5, PASSAGE + " end"), (6, PASSAGE), *CLEAN])
    items = spark.createDataFrame([(1, PASSAGE)], "item_id long, text string")
    assert kept(decontamination.drop_contaminated(rows, items)) == sorted(CLEAN, key=repr)


def test_a_near_copy_takes_no_other_row_along(spark):
    rows = documents(spark, [(3, PASSAGE), (None, PASSAGE + " a"), (5, PASSAGE + " b"), (6, PASSAGE), *CLEAN])
    assert kept(ngram_join.keep_one(rows)) == sorted([(3, PASSAGE), *CLEAN], key=repr)


def test_a_rejected_row_takes_no_other_row_along(spark):
    bad = lambda i: " ".join(f"BUY{i}!! %%% $$$ X{i}!!" for _ in range(9))
    good = lambda i: f"This is text number {i}, and it says what there is to say, calmly and in order."
    rows = [(100 + i, good(i) if i % 2 else bad(i)) for i in range(60)]
    labels = spark.createDataFrame([(100 + i, i % 2) for i in range(60)], "doc_id long, quality int")
    rows = documents(spark, [*rows, (None, bad(61)), (5, bad(62)), (None, good(63)), (5, good(64))])
    assert kept(quality.keep_good(rows, labels).where("doc_id IS NULL OR doc_id < 100")) == sorted([(None, good(63)), (5, good(64))], key=repr)
