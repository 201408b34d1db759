import hashlib
import math
import random

import numpy as np
import pytest

from logtally.llm import centroids as c
from tests.llm.cases import plain


def table(spark, rows):
    """With columns whose names the operator uses inside."""
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 AS x", "2 AS cluster", "3 AS distance", "4 AS best", "5 AS own")


def by_hand(rows, clusters, rounds, parts):
    """(id, vector, cluster, distance) and the centroids, in plain loops."""
    kept = [(i, v) for i, v in rows if v is not None and len(v) == parts and all(x is not None and math.isfinite(x) for x in v)]
    kept = [(i, [min(max(math.floor(256 * x), -c.LARGEST), c.LARGEST) for x in v]) for i, v in kept]
    key = lambda r: (hashlib.sha256(f"2:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1])
    centers = [v for _, v in sorted(kept, key=key)[:clusters]]

    def assigned():
        return [min((sum((a - b) ** 2 for a, b in zip(v, center, strict=True)), k) for k, center in enumerate(centers)) for _, v in kept]

    for _ in range(rounds):
        groups = {}
        for (_, v), (_, k) in zip(kept, assigned(), strict=True):
            groups.setdefault(k, []).append(v)
        centers = [[sum(x) // len(groups[k]) for x in zip(*groups[k], strict=True)] if k in groups else center for k, center in enumerate(centers)]
    return [(i, k, d) for (i, _), (d, k) in zip(kept, assigned(), strict=True)], centers


@pytest.mark.parametrize("clusters", [1, 5, 400])
def test_against_plain_loops(spark, clusters):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(i % 4, 0.4, 6).round(3).tolist()) for i in range(120)]
    rows += [(i, rows[7][1]) for i in (200, 201, 201)] + [(None, [-0.001] * 6), (None, [0.5] * 6), (7, [1.0] * 6)]
    rows += [(300, None), (301, []), (302, [1.0] * 5), (303, [1.0] * 7), (304, [1.0, None, 1, 1, 1, 1.0]), (305, [math.nan] * 6), (306, [math.inf] * 6)]
    rows = [(i, v and [x if x is None else float(x) for x in v]) for i, v in rows]
    random.Random(1).shuffle(rows)
    found = c.cluster(c.whole_vectors(table(spark, rows).repartition(3), parts=6), clusters=clusters, rounds=3)
    want, centers = by_hand(rows, clusters, 3, 6)
    assert sorted(plain(found.assigned), key=repr) == sorted(want, key=repr)
    assert found.centroids == centers
    assert found.inertia == [sum(d for _, k, d in want if k == i) for i in range(len(centers))]


def test_the_largest_numbers_still_fit(spark):
    rows = [(1, [1e300] * 64), (2, [-1e300] * 64), (3, [5e-324] * 64)]
    found = c.cluster(c.whole_vectors(table(spark, rows)), clusters=1, rounds=0)
    want, _ = by_hand(rows, 1, 0, 64)
    assert plain(found.assigned) == sorted(want, key=repr)


def test_empty(spark):
    found = c.cluster(c.whole_vectors(table(spark, [])))
    assert plain(found.assigned) == [] and found.centroids == []


def test_the_plan_has_no_python_and_sums_before_the_shuffle(spark):
    vectors = c.whole_vectors(table(spark, [(1, [0.0] * 64)]))
    plan = vectors.select(c.nearest([[1] * 64])["cluster"].alias("k"), "x").groupBy("k").count()._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "partial_count" in plan
