"""Steps the operators share: parking an intermediate table, looking up skewed keys, connected components."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logtally.storage import Files, fresh_dir

#: A key with more rows than this, and than its part of all rows, is looked up by broadcast.
HOT_ROWS = 10_000
#: So many keys at most can be hot, whatever the input.
HOT_KEYS = 20_000
#: A table of so many ids at most, some 20 MB, is broadcast.
BROADCAST_IDS = 500_000


#: Folders of the open scratches, the innermost last.
_scratches: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """Tables that are saved in here are removed at the end, but for those saved by the function that this gives.

    What leaves must be such a table, for it is whole by itself and needs none of the others.
    """
    own: list[str] = []
    outer = _scratches[-1] if _scratches else None
    _scratches.append(own)

    def keep(df: DataFrame, label: str) -> DataFrame:
        table = saved(df, label)
        path = own.pop()
        if outer is not None:
            outer.append(path)
        return table

    try:
        yield keep
    finally:
        _scratches.remove(own)
        for path in own:
            Files(spark, path).delete(path)


def saved(df: DataFrame, label: str) -> DataFrame:
    """The table written to the folder that all executors share, and read back: it cuts the lineage and is never redone."""
    path = fresh_dir(df.sparkSession, label)
    if _scratches:
        _scratches[-1].append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_of(documents: DataFrame) -> DataFrame:
    """Only doc_id and text, with null text as empty; other columns never get in the way."""
    return documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))


def look_up(rows: DataFrame, table: DataFrame, key: list[str], weight: str, how: str = "left") -> DataFrame:
    """Join rows to a table with one row per key, of which ``weight`` says how many rows ask for it.

    A key with more than total / HOT_KEYS rows is joined by broadcast. There are fewer than HOT_KEYS of these, by
    arithmetic. All others go through a shuffle in which no key is large. Both inputs are read twice: pass saved tables.
    """
    total = table.agg(F.sum(weight)).first()[0] or 0
    most = max(HOT_ROWS, math.ceil(total / HOT_KEYS))
    hot = F.broadcast(table.where(F.col(weight) > most))
    rest = table.where(F.col(weight) <= most)
    if total <= most:
        return rows.join(rest, key, how)
    return rows.join(hot, key).unionByName(rows.join(hot.select(*key), key, "left_anti").join(rest, key, how))


def _by_id(documents: DataFrame, ids: DataFrame, column: str, how: str) -> DataFrame:
    ids = saved(ids.select(F.col(column).alias("__id")), "ids")
    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    return documents.join(ids, documents["doc_id"].eqNullSafe(ids["__id"]), how)


def only(documents: DataFrame, ids: DataFrame, column: str) -> DataFrame:
    """The documents with one of these ids. So few that they fit a broadcast spare the texts a shuffle."""
    return _by_id(documents, ids, column, "left_semi")


def without(documents: DataFrame, ids: DataFrame, column: str) -> DataFrame:
    """The documents with none of these ids."""
    return _by_id(documents, ids, column, "left_anti")


def rows_with(documents: DataFrame, keep: Callable[[list[str]], list[bool]]) -> DataFrame:
    """The rows whose texts are kept, with all columns, each decided by its own text whatever its id. Null text counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(keep([t or "" for t in batch.column("text").to_pylist()]), pa.bool_()))

    return documents.mapInArrow(run, documents.schema)


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node of links (a, b), component being the smallest node it is connected with.

    Each round hangs every neighbour of a node on the smallest node around, first the larger ones, then the smaller
    ones; the number of rounds grows with the logarithm of the longest path. It ends when all that is left are stars. Minima
    are saved before they are joined, so that the joins are plain ones, whose large keys adaptive execution splits.
    """
    with scratch(links.sparkSession) as keep:
        edges = saved(links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
        while not _stars(edges):
            with scratch(links.sparkSession) as keep_round:
                both = edges.union(edges.select("b", "a"))
                least = saved(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low")), "least")
                larger = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
                larger = saved(larger.where("a != b").distinct(), "larger")
                least = saved(larger.groupBy("a").agg(F.min("b").alias("low")), "least")
                smaller = larger.join(least, "a")
                smaller = smaller.select("a", F.col("low").alias("b")).union(smaller.select(F.col("b").alias("a"), F.col("low").alias("b")))
                edges = keep_round(smaller.where("a != b").distinct(), "links")
        heads = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
        return keep(edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(heads), "components")


def _stars(edges: DataFrame) -> bool:
    """Whether every node hangs on one other node, on which it is not the other way round."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("hangs"), F.lit(0).alias("holds"))
    ends = ends.union(edges.select("b", F.lit(0), F.lit(1))).groupBy("node").agg(F.sum("hangs").alias("hangs"), F.max("holds").alias("holds"))
    return ends.where("hangs > 1 OR (hangs = 1 AND holds = 1)").isEmpty()


def training_row(doc_id: Column, parts: int) -> Column:
    """Whether a row may be learned from: the checksum of its id as text leaves a remainder. A null id counts as ''."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % parts != 0
