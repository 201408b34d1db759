"""Personal data: fixed patterns, and bootstrapped extraction of identifiers that they miss.

What the patterns find are seed entities, whole spans of any kind. A candidate is another word with a digit, ``@`` or ``_`` in
it. Both have a shape that their character kinds make (``a@a.a``) and stand in a context of words; lexical patterns are two words
before, the word before and the one behind, and either of these with the shape. Patterns and the strings that stand in them
form a graph. In rounds, a pattern's confidence is the confidence of its strings, averaged with a prior
of ``PRIOR`` strings that are none; a string's is that of its best pattern, and seeds stay certain. Candidates outside the
base spans are reported as ``found`` where a pattern of at least ``CONFIDENT``, learned from ``SUPPORT`` different seeds, has them.
A word that goes on beyond ``spans.CONTEXT`` characters away is no context. Candidates may touch each other, but don't overlap.

Null text counts as empty. Texts may be of any length. Other columns are ignored. Documents without spans have counts of 0. Repeated rows are reported like any other; they don't
make a pattern stronger, as a pattern counts different strings. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logtally.llm.spans import CONTEXT, reported, scanned, spans_of
from logtally.llm.tables import look_up, saved

KINDS = ["email", "ip", "card", "phone"]
#: The same matches as the plain forms give, without trying again what cannot match: a run of local or number characters
#: is entered at its start or where the last match has ended, and taken whole.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9]){12,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "candidate": r"(?<![^\x20\x09-\x0D])[^0-9@_\x20\x09-\x0D]*+[0-9@_][^\x20\x09-\x0D]*+",
}
#: Signs around a word that are not part of it.
EDGES = "\"'([{<>}]).,;:!?*%&#$"
PRIOR = 3
CONFIDENT = 0.75
SUPPORT = 5
ROUNDS = 3


def _digits(found: Column) -> Column:
    return F.regexp_replace(found, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the check digit fits: every second digit from the right counts double, its own digits added."""
    each = F.transform(F.split(F.reverse(digits), ""), lambda c, i: F.when(i % 2 == 0, c.try_cast("int")).otherwise(F.element_at(F.lit([0, 2, 4, 6, 8, 1, 3, 5, 7, 9]), c.try_cast("int") + 1)))
    return F.aggregate(each, F.lit(0), lambda a, d: a + F.coalesce(d, F.lit(0))) % 10 == 0


def base_spans(scan: DataFrame) -> DataFrame:
    """The spans that the patterns and their conditions fix, with what they have found and what stands around it."""
    at_most_255 = lambda p: (F.length(F.ltrim(p, F.lit("0"))) <= 3) & (F.coalesce(F.right(p, F.lit(3)).try_cast("int"), F.lit(0)) <= 255)
    digits = _digits(F.col("found"))
    size = F.length(digits)
    valid = {
        "email": F.lit(True),
        "ip": F.forall(F.split("found", r"\."), at_most_255),
        "card": size.between(13, 19) & luhn(digits),
        "phone": size.between(9, 15),
    }
    parts = [spans_of(scan, k).where(valid[k]).select("row", "kind", "start", "end", "found", "left", "right") for k in KINDS]
    return saved(parts[0].union(parts[1]).union(parts[2]).union(parts[3]), "private")


def _patterns() -> Column:
    """Hashes of the patterns that ``value`` stands in between ``left`` and ``right``; a side without a whole word has none."""
    space, word = r"[\x20\x09-\x0D]", r"[^\x20\x09-\x0D]++"
    # Where the context is shorter than it could be, the text or another match ends there, and so does a word.
    left = F.lower(F.when(F.length("left") < CONTEXT, F.concat(F.lit(" "), "left")).otherwise(F.col("left")))
    right = F.lower(F.when(F.length("right") < CONTEXT, F.concat("right", F.lit(" "))).otherwise(F.col("right")))
    one = F.regexp_extract(left, f"{space}({word}){space}*+$", 1)
    two = F.regexp_replace(F.regexp_extract(left, f"{space}({word}{space}++{word}){space}*+$", 1), f"{space}+", " ")
    next_ = F.regexp_extract(right, f"^{space}*+({word}){space}", 1)
    shape = F.regexp_replace(F.regexp_replace(F.lower("value"), r"\p{L}+", "a"), "[0-9]+", "9")
    key = lambda name, needs, *parts: F.when(needs, F.xxhash64(F.lit(name), *parts))
    return F.array_compact(
        F.array(
            key("two", two != "", two),
            key("both", (one != "") & (next_ != ""), one, next_),
            key("left", one != "", one, shape),
            key("right", next_ != "", next_, shape),
        )
    )


def candidates(scan: DataFrame, base: DataFrame) -> DataFrame:
    """row, start, end, value, seed, patterns of the base spans and of the candidates outside of them, outer punctuation taken off."""
    words = spans_of(scan, "candidate")
    lead = F.length("found") - F.length(F.ltrim("found", F.lit(EDGES)))
    words = words.withColumn("value", F.trim("found", F.lit(EDGES))).where("value RLIKE '[0-9@_]'")
    words = words.withColumn("start", F.col("start") + lead).withColumn("end", F.col("start") + F.length("value"))
    own = base.groupBy("row").agg(F.collect_list(F.struct("start", "end")).alias("own"))
    words = words.join(own, "row", "left")
    overlap = F.exists(F.coalesce("own", F.array().cast("array<struct<start:bigint,end:bigint>>")), lambda s: (s["start"] < F.col("end")) & (s["end"] > F.col("start")))
    columns = ["row", "start", "end", "value", "left", "right"]
    words = words.where(~overlap).select(*columns, F.lit(False).alias("seed"))
    seeds = base.withColumn("value", F.col("found")).select(*columns, F.lit(True).alias("seed"))
    return saved(seeds.union(words).select("row", "start", "end", "value", "seed", _patterns().alias("patterns")), "candidates")


def confident_patterns(found: DataFrame) -> DataFrame:
    """Patterns that are kept, from the graph of patterns and strings."""
    edges = found.select(F.explode("patterns").alias("pattern"), F.xxhash64("value").alias("node"), "seed")
    edges = saved(edges.groupBy("pattern", "node").agg(F.max("seed").alias("seed")), "edges")
    nodes = edges.groupBy("node").agg(F.max("seed").cast("double").alias("trust"), F.max("seed").alias("seed"), F.count("*").alias("w"))
    for _ in range(ROUNDS):
        nodes = saved(nodes, "nodes")
        seen = look_up(edges.select("pattern", "node"), nodes.select("node", "trust", "seed", "w"), ["node"], "w")
        patterns = seen.groupBy("pattern").agg(
            (F.sum("trust") / (F.count("*") + PRIOR)).alias("confidence"), F.count_if("seed").alias("seeds"), F.count("*").alias("w")
        )
        patterns = saved(patterns, "patterns")
        better = look_up(edges, patterns.withColumnRenamed("w", "asked"), ["pattern"], "asked")
        best = F.max(F.when(F.col("seeds") >= SUPPORT, F.col("confidence")).otherwise(0.0))
        nodes = better.groupBy("node").agg(F.greatest(best, F.max("seed").cast("double")).alias("trust"), F.max("seed").alias("seed"), F.count("*").alias("w"))
    return patterns.where((F.col("confidence") >= CONFIDENT) & (F.col("seeds") >= SUPPORT)).select("pattern", "w")


def private_data(documents: DataFrame) -> DataFrame:
    scan = scanned(documents, PATTERNS, frozenset(PATTERNS))
    base = base_spans(scan)
    found = candidates(scan, base)
    kept = saved(confident_patterns(found), "kept")
    unseen = saved(found.where("NOT seed").select("row", "start", "end", F.explode("patterns").alias("pattern")), "unseen")
    asked = saved(unseen.groupBy("pattern").agg(F.count("*").alias("w")).join(kept.select("pattern"), "pattern"), "asked")
    added = look_up(unseen, asked, ["pattern"], "w", "inner").select("row", F.lit("found").alias("kind"), "start", "end").distinct()
    return reported(scan, base, added, KINDS, by_kind=True)


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return private_data(spark.read.parquet(f"{sf_dir}/documents.parquet"))
