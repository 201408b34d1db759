"""Secret scans: fixed patterns, and character Markov models of random strings and of ordinary identifiers.

The models are first-order: how likely is a character after another one. One is counted from values that the patterns
mark as secrets, the other from long words and identifiers outside of these (runs of letters in one case, of digits, and
signs between them), each different string once, over all documents. A token's log-likelihood ratio per character says which model it fits better. A token that no pattern
has is reported as ``random`` if its ratio is above zero and above that of all but one in ``FALSE_ONE_IN`` ordinary identifiers.

Learned from, and scored, are tokens of 16 characters and more: fewer say too little about where they come from, and what the
patterns find stays whatever its length. Added spans don't overlap with others, as tokens are taken from left to right.

Null text counts as empty. Texts may be of any length. Other columns are ignored. Documents without spans have counts of 0. Repeated rows are reported like any other. Without any
secret, or any ordinary token, to learn from, no span is added. An empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logtally.llm.spans import reported, scanned, spans_of
from logtally.llm.tables import saved

KINDS = ["assign", "access", "hex"]
#: Whole runs are taken and checked afterwards. A run that is too short at its start is too short further on as well,
#: so the least length of ``access`` and ``hex`` can stand in the pattern.
PATTERNS = {
    "assign": r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]{16,}+",
    "hex": r"(?<![0-9a-f])[0-9a-f]{24,}+",
    "token": r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{16,}+",
}
LEAST_ASSIGNED = 6
FALSE_ONE_IN = 20_000
#: What counts as an ordinary identifier when the models are learned.
ORDINARY = "^(?:[A-Z]?[a-z]{2,}+|[A-Z]{3,}+|[0-9]++|[_./=+-]++)++$"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-"


def base_spans(scan: DataFrame) -> DataFrame:
    """The spans that the patterns alone fix, with the secret's value."""
    value = F.regexp_extract("found", PATTERNS["assign"], 2)
    assign = spans_of(scan, "assign").withColumn("value", value).where(F.length("value") >= LEAST_ASSIGNED)
    rest = [spans_of(scan, k).withColumn("value", F.col("found")) for k in KINDS[1:]]
    return saved(assign.union(rest[0]).union(rest[1]).select("row", "kind", "start", "end", "value"), "secrets")


def _pairs(token: Column) -> Column:
    """Numbers of the character pairs of a token, -1 where a character is outside the alphabet."""
    chars = F.transform(F.split(token, ""), lambda c: F.instr(F.lit(ALPHABET), c) - 1)
    size = F.length(token)
    both = F.zip_with(F.slice(chars, F.lit(1), size - 1), F.slice(chars, F.lit(2), size - 1), lambda a, b: F.when((a >= 0) & (b >= 0), a * len(ALPHABET) + b).otherwise(-1))
    return F.when(size > 1, both).otherwise(F.array().cast("array<int>"))


def ratios(samples: DataFrame) -> list[float] | None:
    """log P(b | a, random) - log P(b | a, ordinary) of every pair, from (token, is_random) samples; None without both."""
    counted = samples.distinct().select("is_random", F.explode(_pairs(F.col("token"))).alias("pair"))
    n = len(ALPHABET)
    table = {True: [[0.5] * n for _ in range(n)], False: [[0.5] * n for _ in range(n)]}
    seen = set()
    for r in counted.where("pair >= 0").groupBy("is_random", "pair").count().collect():
        table[r["is_random"]][r["pair"] // n][r["pair"] % n] += r["count"]
        seen.add(r["is_random"])
    if len(seen) < 2:
        return None
    sums = {k: [sum(row) for row in rows] for k, rows in table.items()}
    return [math.log(table[True][a][b] / sums[True][a] * sums[False][a] / table[False][a][b]) for a in range(n) for b in range(n)]


def score(token: Column, weights: list[float]) -> Column:
    """The log-likelihood ratio per pair of a token, above 0 if it looks random."""
    table = F.expr(f"from_json('[{','.join(f'{w:.9g}' for w in weights)}]', 'array<double>')")
    total = F.aggregate(_pairs(token), F.lit(0.0), lambda t, p: t + F.when(p >= 0, F.element_at(table, p + 1)).otherwise(0.0))
    return total / F.greatest(F.length(token) - 1, F.lit(1))


def random_spans(scan: DataFrame, base: DataFrame) -> DataFrame:
    """Tokens outside the base spans that look random."""
    tokens = spans_of(scan, "token").select("row", "start", "end", "found")
    own = base.groupBy("row").agg(F.collect_list(F.struct("start", "end")).alias("own"))
    tokens = tokens.join(own, "row", "left")
    covered = F.exists(F.coalesce("own", F.array().cast("array<struct<start:bigint,end:bigint>>")), lambda s: (s["start"] < F.col("end")) & (s["end"] > F.col("start")))
    tokens = saved(tokens.withColumn("covered", covered).drop("own"), "tokens").where("NOT covered")
    secrets = base.where("length(value) >= 16").select(F.col("value").alias("token"), F.lit(True).alias("is_random"))
    weights = ratios(secrets.union(tokens.where(F.col("found").rlike(ORDINARY)).select("found", F.lit(False))))
    none = tokens.where("false").selectExpr("row", "'random' AS kind", "start", "end")
    if weights is None:
        return none
    scores = saved(tokens.select("row", "start", "end", "found", score(F.col("found"), weights).alias("score")), "scores")
    plain = scores.where(F.col("found").rlike(ORDINARY)).agg(F.percentile_approx("score", 1 - 1 / FALSE_ONE_IN, 100_000)).first()[0]
    return scores.where(F.col("score") > max(0.0, plain or 0.0)).selectExpr("row", "'random' AS kind", "start", "end")


def secrets(documents: DataFrame) -> DataFrame:
    scan = scanned(documents, PATTERNS)
    base = base_spans(scan)
    return reported(scan, base, random_spans(scan, base), KINDS, by_kind=False)


def op4_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets(spark.read.parquet(f"{sf_dir}/documents.parquet"))
