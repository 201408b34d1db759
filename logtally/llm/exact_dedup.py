"""Exact dedup of incoming batches against immutable snapshots.

A snapshot holds one row per different digest, in buckets, and a binary fuse filter of each bucket's digests. An incoming
batch is grouped by digest on its own first. Its digests then pass the filters, and those that pass are looked up in the
buckets. Only for digests that are in both are texts fetched, one of either side, and compared byte for byte.

Null text counts as empty. Repeated rows are members like any other, and one of them stays. Rows without an id never stay
where another one has one. An empty batch or snapshot gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logtally.llm import binary_fuse
from logtally.llm.tables import BROADCAST_IDS, look_up, only, saved, scratch, text_of, without

BUCKET_TEXTS = 250_000

_FILTER = "bucket long, seed string, segment long, starts long, cells binary"


class Snapshot(NamedTuple):
    """groups: digest, mark, bucket, keep_id, size; filters: one row per bucket; documents: where the texts are."""

    groups: DataFrame
    filters: DataFrame
    buckets: int
    documents: DataFrame


def digests(documents: DataFrame) -> DataFrame:
    """doc_id, text and the SHA-256 of its UTF-8 bytes."""
    return text_of(documents).withColumn("digest", F.unhex(F.sha2("text", 256)))


def _grouped(documents: DataFrame) -> DataFrame:
    """One row per different digest, added up before the shuffle; no text is moved."""
    groups = digests(documents).groupBy("digest").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("size"))
    return saved(groups.withColumn("mark", F.xxhash64("digest")), "dedup-groups")


def _texts(documents: DataFrame, wanted: DataFrame, name: str) -> DataFrame:
    """digest and the text, as ``name``, of the rows with these digests and ids (digest, keep_id), one of each digest."""
    wanted = saved(wanted.select(F.col("digest").alias("__digest"), F.col("keep_id").alias("__id")), "dedup-wanted")
    if wanted.count() <= BROADCAST_IDS:
        wanted = F.broadcast(wanted)
    rows = digests(documents)
    rows = rows.join(wanted, (rows["digest"] == wanted["__digest"]) & rows["doc_id"].eqNullSafe(wanted["__id"]), "left_semi")
    return rows.groupBy("digest").agg(F.first("text").alias(name))


def _filter_of(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
    f = binary_fuse.build(part["mark"].to_numpy())
    return pd.DataFrame({"bucket": [key[0]], "seed": [str(f.seed)], "segment": [f.segment], "starts": [f.starts], "cells": [f.cells.tobytes()]})


def build_snapshot(documents: DataFrame, bucket_texts: int = BUCKET_TEXTS) -> Snapshot:
    """Freeze these documents. The number of buckets follows the number of texts, so a bucket's filter stays small."""
    groups = _grouped(documents)
    buckets = max(1, math.ceil(groups.count() / bucket_texts))
    groups = groups.withColumn("bucket", F.pmod("mark", F.lit(buckets)))
    filters = groups.select("bucket", "mark").groupBy("bucket").applyInPandas(_filter_of, _FILTER)
    return Snapshot(groups, saved(filters, "dedup-filters"), buckets, documents)


def _screened(asked: pd.DataFrame, filters: pd.DataFrame) -> pd.DataFrame:
    if not len(filters):
        return asked[["digest"]].iloc[:0]
    f = filters.iloc[0]
    own = binary_fuse.Filter(int(f["seed"]), int(f["segment"]), int(f["starts"]), np.frombuffer(f["cells"], np.uint8))
    return asked.loc[binary_fuse.contains(own, asked["mark"].to_numpy()), ["digest"]]


def screen(batch: DataFrame, snapshot: Snapshot) -> DataFrame:
    """Digests of the batch's groups that may be in the snapshot; all that are in it are among them."""
    asked = batch.select("digest", "mark", F.pmod("mark", F.lit(snapshot.buckets)).alias("bucket"))
    return asked.groupBy("bucket").cogroup(snapshot.filters.groupBy("bucket")).applyInPandas(_screened, "digest binary")


def merge_batch(documents: DataFrame, snapshot: Snapshot) -> DataFrame:
    """One row per different text of snapshot and batch together: digest, keep_id (the largest), size."""
    batch = _grouped(documents)
    old = snapshot.groups.select("digest", F.col("keep_id").alias("old_id"), F.col("size").alias("old_size"))
    both = saved(batch.join(screen(batch, snapshot), "digest").join(old, "digest"), "dedup-both")
    new_texts = _texts(documents, both.select("digest", "keep_id"), "new_text")
    old_texts = _texts(snapshot.documents, both.select("digest", F.col("old_id").alias("keep_id")), "old_text")
    same = new_texts.join(old_texts, "digest").where(F.col("new_text") == F.col("old_text")).select("digest")
    added = both.join(same, "digest").select("digest", F.greatest("keep_id", "old_id").alias("keep_id"), (F.col("size") + F.col("old_size")).alias("size"))
    found = saved(added, "dedup-found")
    plain = batch.select("digest", "keep_id", "size").unionByName(snapshot.groups.select("digest", "keep_id", "size"))
    return found.unionByName(plain.join(found.select("digest"), "digest", "left_anti"))


def keepers(documents: DataFrame, bucket_texts: int = BUCKET_TEXTS) -> DataFrame:
    """One row per document: doc_id, digest, keep_id, group_size, kept.

    Half of the ids, by checksum, are frozen as the snapshot; the others come in as its batch.
    """
    with scratch(documents.sparkSession) as keep:
        old = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 2 == 0
        groups = saved(merge_batch(documents.where(~old), build_snapshot(documents.where(old), bucket_texts)), "dedup-merged")
        rows = saved(digests(documents).groupBy("doc_id", "digest").agg(F.count("*").alias("copies")), "dedup-rows")
        found = keep(look_up(rows, groups, ["digest"], "size"), "dedup-found")
    found = found.select("doc_id", "digest", "keep_id", F.col("size").alias("group_size"), F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy"))
    return found.select("doc_id", "digest", "keep_id", "group_size", (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"))


def drop_copies(documents: DataFrame) -> DataFrame:
    """The documents that stay, with all their columns. Repeats of a staying row (id and text alike) go too."""
    rows = saved(keepers(documents).groupBy("doc_id", "digest").agg(F.max("kept").alias("kept"), F.count("*").alias("n")), "keepers")
    # Ids that only stand for texts that go; then the few that occur more than once are looked at by their texts.
    by_id = rows.groupBy("doc_id").agg(F.max("kept").alias("kept"), F.sum("n").alias("n"))
    left = without(documents, by_id.where("NOT kept").select("doc_id"), "doc_id")
    twice = by_id.where("kept AND n > 1").select("doc_id")
    again = only(left, twice, "doc_id").withColumn("__digest", F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256)))
    kept = rows.where("kept").select(F.col("doc_id").alias("__kept"), F.col("digest").alias("__own"))
    again = again.join(kept, again["doc_id"].eqNullSafe(kept["__kept"]) & (again["__digest"] == kept["__own"]), "left_semi")
    again = again.dropDuplicates(["doc_id", "__digest"]).select(documents.columns)
    return without(left, twice, "doc_id").unionByName(again)


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = keepers(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return rows.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


OP1_SQL = """
WITH d AS (SELECT doc_id, sha256(coalesce(text, '')) AS h FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY h) AS keep_id, count(*) OVER (PARTITION BY h) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY h) AS kept, h AS text_sha256
FROM d
"""
