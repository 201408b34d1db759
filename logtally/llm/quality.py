"""A quality classifier by Bradley-Terry pairwise ranking.

A document is described by numbers of its whole text alone: shares of kinds of characters and words, repeats, lengths. From
labelled documents preference pairs (a good one, a bad one) are made, and a linear score is learned by logistic loss on the
differences of their features, so that P(good is preferred) = 1 / (1 + exp(-(score of good - score of bad))). Rejection
is a threshold on the score: the quantile of training scores at the share of bad documents, moved to the quantile near it
that tells the training rows apart best. The score is then given as a probability that is ``CUT`` at the threshold.

Features are computed in Spark, once for each document that is scored or fitted to. The fit uses every labelled training row: rows
are dealt into blocks of bounded size, pairs are made within a block, and the sums that a step of the fit needs are added up
over all blocks. A label that is rare has each of its rows in several blocks, so that none is without partners. The threshold's
quantiles are exact ones of all training scores. With one label only, nothing can be preferred and every score is 0.5.

Null text counts as empty; it gets a score like any other, as does a text of any length. Other columns are ignored. Where
training scores are even around the threshold, all of them are on the same side of it. Repeated labels count as often as they occur, null labels and
labels of no document not at all. Repeated rows get equal scores. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import ceil
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logtally.llm.tables import only, rows_with, saved, text_of, training_row

#: Labelled rows of a block, about.
BLOCK_ROWS = 10_000
#: Rows of either label that a block has, about, unless there are fewer in all.
BLOCK_LEAST = 200
#: Preference pairs per row of the larger class.
PARTNERS = 8
#: Scores from here on are good.
CUT = 0.3
HELD_OUT = 5

_KINDS = np.zeros(256, np.int64)
for _k, _chars in enumerate((b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t\r\v\f", b"\n", b".,;:'\"-()", b"!?", b"|#$%&*@+=<>[]{}\\/^_~`"), 1):
    _KINDS[list(_chars)] = _k
FEATURES = 22
_SCHEMA = "doc_id long, held_out boolean, features array<double>"


def describe(text: str) -> list[float]:
    """Numbers about a text, each of a few units at most."""
    raw = text.encode("utf-8", "surrogatepass")
    n = len(raw)
    counts = np.bincount(_KINDS[np.frombuffer(raw, np.uint8)], minlength=9) if n else np.zeros(9)
    words = text.split()
    w = max(1, len(words))
    different = len(set(words)) / w
    lines = text.split("\n")
    signs = [sum(1 for x in words if x[-1] in chars) / w for chars in ("!?", "|#$%&*@+=<>", ".,;:")]
    upper = sum(1 for x in words if len(x) > 1 and x.isupper()) / w
    pairs = len(set(zip(words, words[1:], strict=False))) / max(1, len(words) - 1)
    echoes = sum(a == b for a, b in zip(words, words[1:], strict=False)) / w
    share = counts / max(1, n)
    steep = [np.log1p(200 * x) for x in (share[2], share[7], share[8], signs[0], signs[1], upper, 1 - pairs, echoes)]
    return [
        *steep, *share[[1, 3, 4, 6]], signs[2], upper, signs[1], signs[0], different, pairs,
        np.log1p(n) / 10, np.log1p(len(words)) / 10, n / w / 20, len(lines) / w,
    ]


def features(documents: DataFrame, held_out_parts: int = HELD_OUT) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "held_out": batch["held_out"], "features": [np.array(describe(t), float) for t in batch["text"]]})

    rows = text_of(documents).withColumn("held_out", ~training_row(F.col("doc_id"), held_out_parts))
    return saved(rows.mapInPandas(run, _SCHEMA), "features")


class Ranking(NamedTuple):
    middle: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    threshold: float

    def probability(self, x: np.ndarray) -> np.ndarray:
        """1 where good is certain, CUT at the threshold."""
        s = ((x - self.middle) / self.scale) @ self.weights - self.threshold
        return 1 / (1 + np.exp(-np.clip(s + np.log(CUT / (1 - CUT)), -500, 500)))


_BLOCK = "block int, x binary, good binary, own binary"


def _block(rows: pd.DataFrame) -> pd.DataFrame:
    """The rows of a block as arrays, in an order that doesn't depend on how they came."""
    x = np.array(rows["features"].tolist(), float).reshape(-1, FEATURES)
    order = np.lexsort([*x.T, rows["doc_id"], rows["order"], rows["quality"]])
    good, own = (rows[c].to_numpy(bool)[order] for c in ("quality", "own"))
    return pd.DataFrame({"block": [rows["block"].iloc[0]], "x": [x[order].tobytes()], "good": [good.tobytes()], "own": [own.tobytes()]})


def blocks_of(rows: DataFrame, counts: dict[int, int]) -> DataFrame:
    """Labelled rows (doc_id, quality, features) in blocks; a row that stands in several is marked as ``own`` in one."""
    blocks = ceil(sum(counts.values()) / BLOCK_ROWS)
    copies = {q: min(blocks, ceil(blocks * BLOCK_LEAST / n)) for q, n in counts.items()}
    times = F.when(F.col("quality") == 1, copies[1]).otherwise(copies[0])
    # By the row and not by its id alone, which many rows may share.
    rows = rows.withColumn("at", F.xxhash64("doc_id", F.monotonically_increasing_id()))
    rows = rows.select("doc_id", "quality", "features", _order().alias("order"), "at", F.explode(F.sequence(F.lit(0), times - 1)).alias("copy"))
    rows = rows.withColumn("block", F.pmod(F.pmod("at", F.lit(blocks)) + F.col("copy"), F.lit(blocks)).cast("int")).withColumn("own", F.col("copy") == 0)
    return saved(rows.select("doc_id", "quality", "features", "order", "block", "own").groupBy("block").applyInPandas(_block, _BLOCK), "blocks")


def _arrays(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    for batch in batches:
        for block, x, good, own in zip(*(batch[c] for c in ("block", "x", "good", "own")), strict=True):
            yield block, np.frombuffer(x).reshape(-1, FEATURES), np.frombuffer(good, bool), np.frombuffer(own, bool)


def _total(blocks: DataFrame, function: Callable[[int, np.ndarray, np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum of what a function makes of each block; a task hands on one array."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for arrays in _arrays(batches):
            found = function(*arrays)
            total = found if total is None else total + found
        if total is not None:
            yield pd.DataFrame({"total": [total]})

    return np.sum([r["total"] for r in blocks.mapInPandas(run, "total array<double>").collect()], axis=0)


def _differences(block: int, z: np.ndarray, good: np.ndarray, partners: int) -> np.ndarray:
    """Good rows less bad ones, so many pairs for each row of the larger class of a block."""
    a, b = np.flatnonzero(good), np.flatnonzero(~good)
    n = max(len(a), len(b)) * partners if len(a) and len(b) else 0
    rng = np.random.default_rng(7 + block)
    return z[np.resize(rng.permutation(a), n)] - z[rng.choice(b, n)] if n else np.zeros((0, z.shape[1]))


def fit(blocks: DataFrame, counts: dict[int, int], partners: int = PARTNERS, turns: int = 25, penalty: float = 1e-3) -> Ranking:
    """Learn from all rows of the blocks, of which there are so many by label."""
    every = sum(counts.values())
    middle = _total(blocks, lambda _, x, good, own: x[own].sum(0)) / every
    scale = np.maximum(np.sqrt(_total(blocks, lambda _, x, good, own: ((x[own] - middle) ** 2).sum(0)) / every), 1e-6)
    w = np.zeros(FEATURES)
    for _ in range(turns):

        def sums(block: int, x: np.ndarray, good: np.ndarray, own: np.ndarray, w: np.ndarray = w) -> np.ndarray:
            d = _differences(block, (x - middle) / scale, good, partners)
            p = 1 / (1 + np.exp(np.clip(d @ w, -500, 500)))
            return np.concatenate([[len(d)], d.T @ p, ((d * (p * (1 - p))[:, None]).T @ d).ravel()])

        n, *found = np.split(_total(blocks, sums), [1, 1 + FEATURES])
        grad = found[0] / n - penalty * w
        bend = found[1].reshape(FEATURES, FEATURES) / n + penalty * np.eye(FEATURES)
        step = np.linalg.solve(bend, grad)
        w = w + step / max(1.0, np.linalg.norm(step) / 5)
        if np.abs(step).max() < 1e-6:
            break

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for _, x, good, own in _arrays(batches):
            yield pd.DataFrame({"score": (((x - middle) / scale) @ w)[own], "good": good[own]})

    return Ranking(middle, scale, w, best_threshold(blocks.mapInPandas(score, "score double, good boolean"), counts))


def best_threshold(scores: DataFrame, counts: dict[int, int]) -> float:
    """Of the quantiles of all scores near the share of bad ones, the one that tells (score, good) apart best."""
    every = sum(counts.values())
    share = counts[0] / every
    places = {min(int(q * every), every - 1) for q in np.unique(np.clip(share * np.linspace(0.5, 1.5, 201), 0, 1))}
    wanted = np.unique([p for k in places for p in (max(0, k - 1), k)])
    # Different scores in order, with the rows and the bad ones before each: those of the parts before, and in its own part.
    by = scores.groupBy("score").agg(F.count("*").alias("n"), F.count_if(~F.col("good")).alias("bad"))
    by = saved(by.orderBy("score").withColumn("part", F.spark_partition_id()), "scores")
    parts = by.groupBy("part").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    parts = parts.selectExpr("part", "sum(n) OVER (ORDER BY part) - n AS n_before", "sum(bad) OVER (ORDER BY part) - bad AS bad_before")
    own = "OVER (PARTITION BY part ORDER BY score)"
    by = by.join(F.broadcast(parts), "part").selectExpr("score", "n", f"n_before + sum(n) {own} - n AS first", f"bad_before + sum(bad) {own} - bad AS worse")

    def at_places(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch[np.searchsorted(wanted, batch["first"]) < np.searchsorted(wanted, batch["first"] + batch["n"])]

    found = by.mapInPandas(at_places, "score double, n long, first long, worse long").orderBy("score").collect()
    score, first, worse = (np.array([r[c] for r in found]) for c in ("score", "first", "worse"))
    best = (-1.0, 0.0)
    for k in places:
        low, high = np.searchsorted(first, [max(0, k - 1), k], "right") - 1
        # Between two neighbouring scores, so that no training row lies on the threshold.
        t = (score[low] + score[high]) / 2
        at = high if t > score[low] else low
        good_above = counts[1] - (first[at] - worse[at])
        best = max(best, (float(worse[at] + good_above) / every, float(t)))
    return best[1]


def _order() -> Column:
    """What rows are taken by."""
    return F.crc32(F.concat(F.lit("fit:"), F.col("doc_id").cast("string")))


def _first(rows: DataFrame, labelled: int | None) -> DataFrame:
    """All rows, or of either label so many at most, for a fit that is to be cheaper."""
    if labelled is None:
        return rows
    taken = [rows.where(F.col("quality") == q).orderBy(_order(), "doc_id").limit(labelled) for q in (0, 1)]
    return taken[0].union(taken[1])


def fit_rows(documents: DataFrame, labels: DataFrame, labelled: int | None = None) -> DataFrame:
    """The documents that ``learn`` takes rows of, so that no others need be described for it."""
    known = labels.where("quality IN (0, 1)").select(F.col("doc_id").alias("__labelled"), "quality")
    rows = documents.select("doc_id").where(training_row(F.col("doc_id"), HELD_OUT))
    rows = saved(rows.join(known, rows["doc_id"] == known["__labelled"]).select("doc_id", "quality"), "labelled")
    return only(documents, _first(rows, labelled).select("doc_id").distinct(), "doc_id")


def learn(described: DataFrame, labels: DataFrame, labelled: int | None = None) -> Ranking:
    """Fit to all labelled rows that aren't held out."""
    known = labels.where("quality IN (0, 1)").select(F.col("doc_id").alias("__labelled"), F.col("quality").cast("int").alias("quality"))
    rows = described.where("NOT held_out").join(known, described["doc_id"] == known["__labelled"])
    rows = saved(_first(rows.select("doc_id", "features", "quality"), labelled), "labelled")
    counts = {0: 0, 1: 0} | {r["quality"]: r["count"] for r in rows.groupBy("quality").count().collect()}
    if not all(counts.values()):
        return Ranking(np.zeros(FEATURES), np.ones(FEATURES), np.zeros(FEATURES), float(np.log(CUT / (1 - CUT))))
    return fit(blocks_of(rows, counts), counts)


def scored(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    described = features(documents)
    ranking = learn(described, labels)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = np.array(batch["features"].tolist(), float).reshape(-1, FEATURES)
            p = ranking.probability(x)
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "held_out": batch["held_out"], "score": p, "predicted": (p >= CUT).astype(np.int32)})

    return described.mapInPandas(run, "doc_id long, held_out boolean, score double, predicted int")


def keep_good(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the classifier doesn't reject, with all columns. Rows that share an id, or have none, are told apart."""
    ranking = learn(features(fit_rows(documents, labels)), labels)

    def keep(texts: list[str]) -> list[bool]:
        x = np.array([describe(t) for t in texts], float).reshape(-1, FEATURES)
        return (ranking.probability(x) >= CUT).tolist()

    return rows_with(documents, keep)


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
