import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from logtally.llm import quality
from tests.conftest import TESTDATA
from tests.llm.cases import ROWS, documents, empty, plain


def table(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int, score double")


def test_bad_texts_are_told_from_good_ones(spark):
    rng = random.Random(3)
    good = lambda: " ".join(rng.choice(["alpha", "beta", "gamma", "delta", "omega"]) + rng.choice(["", "", ".", ","]) for _ in range(rng.randrange(5, 60)))
    bad = lambda: " ".join(w.upper() + rng.choice(["!!", "%%%", "$$$"]) for w in good().split())
    rows = [(i, good() if i % 4 else bad()) for i in range(600)]
    labels = table(spark, [(i, int(i % 4 > 0), 0, None) for i in range(600)] + [(9999, 1, 0, None), (5, None, 0, None)])
    out = quality.scored(documents(spark, rows), labels).collect()
    assert len(out) == 600 and all((r["predicted"] == 1) == (r["score"] >= 0.3) for r in out)
    held = [r for r in out if r["held_out"]]
    assert 60 < len(held) < 180
    assert sum(r["predicted"] == int(r["doc_id"] % 4 > 0) for r in held) >= 0.97 * len(held)


def test_labels_of_held_out_rows_are_not_used(spark):
    docs = documents(spark, [(i, f"text {i} " * (i % 7 + 1)) for i in range(100)])
    labels = [(i, i % 2, 0, None) for i in range(100)]
    held = {r["doc_id"] for r in quality.features(docs).where("held_out").collect()}
    turned = [(i, 1 - q if i in held else q, 0, None) for i, q, *_ in labels]
    assert plain(quality.scored(docs, table(spark, labels))) == plain(quality.scored(docs, table(spark, turned)))


def test_only_rows_that_may_be_learned_from_are_described(spark):
    docs = documents(spark, [(i, f"text {i} " * (i % 7 + 1)) for i in range(300)] + [(3, "again"), (None, "none")])
    labels = table(spark, [(i, i % 2, 0, None) for i in range(200)] + [(900, 1, 0, None), (None, 1, 0, None), (5, None, 0, None)])
    few = quality.fit_rows(docs, labels, 20)
    assert few.columns == docs.columns and 38 <= few.count() <= 41
    for bound in (20, 10_000):
        one, other = (quality.learn(quality.features(d), labels, bound) for d in (docs, quality.fit_rows(docs, labels, bound)))
        assert one.threshold == pytest.approx(other.threshold) and one.weights == pytest.approx(other.weights)


@pytest.mark.parametrize("labels", [[], [(7, 1, 0, None), (8, 1, 0, None)]])
def test_without_two_labels_all_scores_are_even(spark, labels):
    out = quality.scored(documents(spark), table(spark, labels)).collect()
    assert len(out) == len(ROWS) and {r["score"] for r in out} == {0.5}
    assert quality.keep_good(documents(spark), table(spark, labels)).count() == len(ROWS)


def test_empty(spark):
    assert plain(quality.scored(empty(spark), table(spark, []))) == []


def test_given_data(spark):
    docs, labels = (spark.read.parquet(f"{TESTDATA}/{t}.parquet") for t in ("documents", "labels"))
    rows = quality.scored(docs, labels).where("held_out").join(labels, "doc_id").collect()
    assert sum(r["predicted"] == r["quality"] for r in rows) >= 0.8 * len(rows)


def described(spark, rows):
    """Rows with made-up features, every ninth one bad."""
    bad = (F.col("id") % 9 == 0).cast("double")
    parts = [F.sin(F.col("id") * (k + 1.7)) + bad * (k % 4) / 5 for k in range(quality.FEATURES)]
    docs = spark.range(rows).select(F.col("id").alias("doc_id"), F.lit(False).alias("held_out"), F.array(*parts).alias("features"))
    return docs, spark.range(rows).selectExpr("id AS doc_id", "cast(id % 9 > 0 AS int) AS quality")


def test_every_labelled_row_is_learned_from(spark):
    docs, labels = described(spark, 30_000)
    x = np.array([r["features"] for r in docs.collect()])
    ranking = quality.learn(docs, labels)
    assert ranking.middle == pytest.approx(x.mean(0), abs=1e-9) and ranking.scale == pytest.approx(x.std(0), abs=1e-9)


def test_blocks_learn_what_one_block_does(spark, monkeypatch):
    docs, labels = described(spark, 4_000)
    x = np.array([r["features"] for r in docs.orderBy("doc_id").collect()])
    good = np.arange(4_000) % 9 > 0
    whole = quality.learn(docs, labels)
    monkeypatch.setattr(quality, "BLOCK_ROWS", 150)
    monkeypatch.setattr(quality, "BLOCK_LEAST", 40)
    ranking = quality.learn(docs, labels)
    assert ranking.middle == pytest.approx(whole.middle) and np.corrcoef(ranking.weights, whole.weights)[0, 1] > 0.95
    right = [((r.probability(x) >= quality.CUT) == good).mean() for r in (whole, ranking)]
    assert right[1] >= right[0] - 0.01 and right[1] > 0.9


def test_threshold_is_the_best_quantile_of_all_scores(spark):
    rng = np.random.default_rng(5)
    good = rng.random(3_000) < 0.8
    scores = np.round(rng.normal(size=3_000) + 1.5 * good, 2)
    rows = spark.createDataFrame([(float(s), bool(g)) for s, g in zip(scores, good, strict=True)], "score double, good boolean").repartition(7)
    rank, best = np.sort(scores), (-1.0, 0.0)
    for q in np.unique(np.clip((~good).mean() * np.linspace(0.5, 1.5, 201), 0, 1)):
        k = min(int(q * len(rank)), len(rank) - 1)
        t = (rank[max(0, k - 1)] + rank[k]) / 2
        best = max(best, (((scores >= t) == good).mean(), float(t)))
    assert quality.best_threshold(rows, {0: int((~good).sum()), 1: int(good.sum())}) == pytest.approx(best[1])
