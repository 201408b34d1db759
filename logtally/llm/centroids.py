"""Centroid clustering of vectors in whole numbers, as column expressions.

Components become integers once, ``floor(scale * x)``, so that every distance, sum and mean is exact and no result depends
on the order in which partitions are added up. The centroids are literals of the plan: a few dozen arrays, whose size does
not depend on the table. Each vector is set against them by ``zip_with`` and ``aggregate``, and ``array_min`` over
(distance, number) picks the nearest, ties going to the smaller number. An update is one aggregation, a sum per component and
cluster, added up before the shuffle: a cluster with most of the vectors is one row per task like any other. Per round the
driver gets those sums, ``clusters`` times ``parts`` numbers, and writes the next literals. Nothing else leaves the executors.

Vectors that are null, have another length, or a component that is null or not finite are left out. Components beyond
``LARGEST`` either way count as that, so that a squared distance fits a BIGINT; an inertia beyond the largest BIGINT is given
as that. Repeated rows count as often as they occur, and among rows with equal ids the smaller vector comes first as a start.
A null id hashes as the empty one. With fewer vectors than clusters there are fewer clusters; an empty table gives no rows.
Columns other than the id and the vector are ignored.
"""

from __future__ import annotations

import hashlib
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logtally.llm.tables import saved

PARTS = 64
SCALE = 256
CLUSTERS = 40
ROUNDS = 5
SEED = 2
#: 64 squares of the difference of two such numbers still fit a BIGINT.
LARGEST = 1 << 27
_MOST = (1 << 63) - 1


def whole_vectors(embeddings: DataFrame, parts: int = PARTS, scale: int = SCALE) -> DataFrame:
    """vec_id and the components as BIGINTs in ``x``, of the vectors that can be clustered."""
    usable = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    # Clipped while it is a double, for the largest doubles have no BIGINT.
    limit = lambda v: F.greatest(F.least(F.floor(v), F.lit(LARGEST)), F.lit(-LARGEST))
    clipped = lambda v: F.greatest(F.least(v, F.lit(LARGEST / scale * 2)), F.lit(-LARGEST / scale * 2))
    whole = F.transform("embedding", lambda v: limit(scale * clipped(v.cast("double"))))
    rows = embeddings.where(F.size("embedding") == parts).where(usable)
    return rows.select("vec_id", whole.alias("x"))


def starts(vectors: DataFrame, clusters: int = CLUSTERS, seed: int = SEED) -> list[list[int]]:
    """The vectors with the smallest hashes of ``seed:vec_id``, in that order."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    return [list(row["x"]) for row in vectors.select(key.alias("key"), "x").orderBy("key", "x").limit(clusters).collect()]


def nearest(centroids: list[list[int]], vector: str = "x") -> Column:
    """A struct (rest, cluster) of the centroid nearest to a vector column.

    The squared distance is written out, (x - c)^2 = x^2 + (c^2 - 2 x c). The second part, ``rest``, tells which is nearest; it
    takes one product and one sum per component. The first part, ``own_square``, is the same for all centroids.
    """
    arrays = ", ".join(f"named_struct('own', {sum(v * v for v in c)}L, 'twice', array({', '.join(f'{-2 * v}L' for v in c)}))" for c in centroids)
    add = lambda total, v: total + v
    rest = lambda c: F.aggregate(F.zip_with(vector, c["twice"], lambda a, b: a * b), c["own"], add)
    return F.array_min(F.transform(F.expr(f"array({arrays})"), lambda c, k: F.struct(rest(c).alias("rest"), k.alias("cluster"))))


def own_square(vector: str = "x") -> Column:
    return F.aggregate(vector, F.lit(0).cast("long"), lambda total, v: total + v * v)


def moved(vectors: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """The centroids after one round: each the floor of its vectors' means; one without vectors stays."""
    sums = [F.sum(F.col("x")[i]).alias(f"s{i}") for i in range(len(centroids[0]))]
    assigned = vectors.select(nearest(centroids)["cluster"].alias("cluster"), "x")
    after = list(centroids)
    for row in assigned.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), *sums).collect():
        after[row["cluster"]] = [row[f"s{i}"] // row["n"] for i in range(len(sums))]
    return after


class Clusters(NamedTuple):
    """``assigned`` has vec_id, cluster, distance; ``inertia`` the sums of distances per cluster, 0 for an empty one."""

    assigned: DataFrame
    centroids: list[list[int]]
    inertia: list[int]


def cluster(vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED) -> Clusters:
    """Cluster the rows of ``whole_vectors``."""
    vectors = saved(vectors, "vectors")
    centroids = starts(vectors, clusters, seed)
    if not centroids:
        return Clusters(vectors.selectExpr("vec_id", "0 AS cluster", "0L AS distance"), [], [])
    for _ in range(rounds):
        before, centroids = centroids, moved(vectors, centroids)
        if centroids == before:
            break  # Further rounds would find the same.
    found = vectors.select("vec_id", own_square().alias("own"), nearest(centroids).alias("best"))
    assigned = saved(found.select("vec_id", "best.cluster", (F.col("own") + F.col("best.rest")).alias("distance")), "assigned")
    sums = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("inertia")).collect()
    of = {row["cluster"]: int(row["inertia"]) for row in sums}
    return Clusters(assigned, centroids, [of.get(k, 0) for k in range(len(centroids))])


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = cluster(whole_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet")))
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in found.centroids]
    rows = [(k, min(found.inertia[k], _MOST), min(sum(found.inertia), _MOST), digests[k]) for k in range(len(digests))]
    # A row per centroid, so it is as small as the literals of the plan.
    facts = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    joined = found.assigned.join(F.broadcast(facts), "cluster")
    return joined.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _sql() -> str:
    """The rounds as one common table expression each."""
    vector = f"list_transform(embedding, lambda v: CAST(floor({SCALE} * CAST(v AS DOUBLE)) AS BIGINT))"
    finite = "len(list_filter(embedding, lambda v: isfinite(CAST(v AS DOUBLE))))"
    key = f"sha256('{SEED}:' || CAST(vec_id AS VARCHAR))"
    parts = [
        f"""v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, {vector} AS x FROM embeddings
  WHERE len(embedding) = {PARTS} AND {finite} = {PARTS})""",
        f"c0 AS MATERIALIZED (SELECT * FROM (SELECT row_number() OVER (ORDER BY {key}, x) - 1 AS k, x FROM v) WHERE k < {CLUSTERS})",
    ]
    for i in range(ROUNDS + 1):
        parts.append(
            f"""a{i} AS MATERIALIZED (SELECT r, min({{'d': d, 'k': k}}) AS best FROM (
  SELECT r, k, CAST(list_sum(list_transform(list_zip(v.x, c.x), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT) AS d
  FROM v, c{i} AS c) GROUP BY r)"""
        )
        if i < ROUNDS:
            parts.append(
                f"""c{i + 1} AS MATERIALIZED (
  SELECT c.k, coalesce(m.x, c.x) AS x FROM c{i} AS c LEFT JOIN (
    SELECT k, list(q ORDER BY j) AS x FROM (
      SELECT k, j, CAST((s - ((s % n) + n) % n) // n AS BIGINT) AS q FROM (
        SELECT k, j, sum(e) AS s, count(*) AS n FROM (
          SELECT a.best.k AS k, unnest(v.x) AS e, generate_subscripts(v.x, 1) AS j FROM v JOIN a{i} AS a USING (r))
        GROUP BY k, j)) GROUP BY k) AS m ON c.k = m.k)"""
            )
    return f"""WITH {', '.join(parts)}
SELECT v.vec_id, CAST(a.best.k AS INTEGER) AS cluster, a.best.d AS distance,
       CAST(sum(a.best.d) OVER (PARTITION BY a.best.k) AS BIGINT) AS cluster_inertia,
       CAST(sum(a.best.d) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(c.x, ',')) AS centroid_sha256
FROM v JOIN a{ROUNDS} AS a USING (r) JOIN c{ROUNDS} AS c ON c.k = a.best.k"""


OP11_SQL = _sql()
