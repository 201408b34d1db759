"""Spans of regular expressions in whole texts, in code points, as column expressions and rows.

Spark's functions give the matches of a pattern and the text between them; a match begins behind all that stands before
it. Matches become rows, so a text with any number of them is one task's stream and not one huge cell.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logtally.llm.tables import saved, text_of

#: Characters around a match that its context words are looked for in.
CONTEXT = 60


def scanned(documents: DataFrame, patterns: dict[str, str], context_of: frozenset[str] = frozenset()) -> DataFrame:
    """row, doc_id, and per kind the matches with the text lengths before them; of some kinds also the text around them.

    Each row gets a number of its own; rows without a match stay, with empty arrays. A pattern is only applied in full where
    it matches at all.
    """
    columns = []
    for kind, pattern in patterns.items():
        around = kind in context_of
        gaps, found = F.split("text", pattern, -1), F.regexp_extract_all("text", F.lit(pattern), F.lit(0))
        length = F.transform(gaps, lambda g: F.length(g))
        parts = [length.alias("gap"), found.alias("found")]
        if around:
            parts.append(F.transform(gaps, lambda g: F.struct(F.left(g, F.lit(CONTEXT)).alias("head"), F.right(g, F.lit(CONTEXT)).alias("tail"))).alias("around"))
        columns.append(F.when(F.col("text").rlike(pattern), F.struct(*parts)).alias(kind))
    rows = text_of(documents).select("doc_id", F.length("text").alias("chars"), *columns)
    return saved(rows.withColumn("row", F.monotonically_increasing_id()), "scanned")


def spans_of(scan: DataFrame, kind: str) -> DataFrame:
    """row, kind, place (of the match among its row's), start, end, found; and left, right where the context was kept."""
    around = "around" in scan.schema[kind].dataType.fieldNames()
    rows = scan.where(F.col(kind).isNotNull())
    cells = rows.select("row", F.posexplode(F.arrays_zip(f"{kind}.gap", f"{kind}.found", *([f"{kind}.around"] * around))).alias("place", "m"))
    sums = "sum(m.gap + coalesce(length(m.found), 0)) OVER (PARTITION BY row ORDER BY place) - coalesce(length(m.found), 0)"
    more = ["m.around.tail AS left", "lead(m.around.head) OVER (PARTITION BY row ORDER BY place) AS right"] * around
    rows = cells.selectExpr("row", f"'{kind}' AS kind", "place", f"{sums} AS start", "m.found AS found", *more).where("found IS NOT NULL")
    return rows.withColumn("end", F.expr("start + length(found)"))


def reported(scan: DataFrame, base: DataFrame, added: DataFrame, kinds: list[str], by_kind: bool) -> DataFrame:
    """One row per document: doc_id, n_<kind> of the base spans, base_sha256, spans; in order of kind or of place first."""
    order = F.create_map(*[x for i, k in enumerate([*kinds, "added"]) for x in (F.lit(k), F.lit(i))])
    every = base.select("row", "kind", "start", "end", F.lit(True).alias("base")).union(added.select("row", "kind", "start", "end", F.lit(False)))
    rank = F.coalesce(order[F.col("kind")], F.lit(len(kinds)))
    key = F.struct(rank.alias("rank"), "start", "end", "kind", "base") if by_kind else F.struct("start", rank.alias("rank"), "end", "kind", "base")
    listed = every.groupBy("row").agg(F.sort_array(F.collect_list(key)).alias("spans"))
    written = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    rows = scan.select("row", "doc_id").join(listed, "row", "left").withColumn("spans", F.coalesce("spans", F.array()))
    own = F.filter("spans", lambda s: s["base"])
    of_kind = lambda kind: lambda s: s["base"] & (s["kind"] == kind)
    counts = [F.size(F.filter("spans", of_kind(k))).cast("long").alias(f"n_{k}") for k in kinds]
    return rows.select(
        "doc_id", *counts, F.sha2(F.array_join(F.transform(own, written), ","), 256).alias("base_sha256"), F.array_join(F.transform("spans", written), ",").alias("spans")
    )
