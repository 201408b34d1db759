"""Packing token sequences into windows: non-negative least squares over length combinations.

Every document is cut into whole windows and one rest. Rests are counted by length in steps of 16 tokens. All
combinations of two or three steps that fill a window exactly are enumerated, and their repeat counts are solved against
the histogram by non-negative least squares, rounded down. What is left is packed greedily, largest first, a piece being
cut where it fills a window's last gap. All this works on counts: the plan is a few thousand numbers however many
documents there are. Each document then finds its place from its rank among those of its step.

Ids of a piece stand in their document's order; windows hold no padding but the rounding to steps and the last windows.

A null text counts as empty and is one token, the end mark. Repeated rows and null ids are packed like any other row. An
empty table gives no pieces. Other columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logtally.llm.tables import saved, scratch, text_of
from logtally.llm.token_ids import WordIds, word_ids

WINDOW = 4096
END_ID = 2
STEP = 16
#: Rests that one task ranks, about.
RANKED_ROWS = 100_000
#: Characters of text that are looked up at a time, about.
ENCODED_CHARS = 1_000_000

_TOKENS = "doc_id long, doc_tokens long, ids binary"
_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence long, place int"


class Use(NamedTuple):
    """From rank ``rank`` on, items of a step go to windows of one pattern, in which they take ``steps`` steps.

    sequence: the first such window. left_step, left_rank: where the rest of a cut item goes on, or 0.
    """

    rank: int
    sequence: int
    place: int
    steps: int
    left_step: int
    left_rank: int


def combinations(slots: int) -> np.ndarray:
    """All combinations of two or three step counts that add up to ``slots``; a missing third is 0."""
    found = [(a, slots - a, 0) for a in range(1, slots // 2 + 1)]
    found += [(a, b, slots - a - b) for a in range(1, slots // 3 + 1) for b in range(a, (slots - a) // 2 + 1)]
    return np.array(found, np.int64).reshape(-1, 3)


def solve(items: np.ndarray, histogram: np.ndarray, turns: int = 400) -> np.ndarray:
    """Repeat counts x >= 0 that come near the histogram in least squares, by accelerated projected gradients."""
    cells = len(histogram)
    used = items.ravel()
    real = (items > 0).astype(float)

    def made(x: np.ndarray) -> np.ndarray:
        return np.bincount(used, weights=(x[:, None] * real).ravel(), minlength=cells)

    v = np.ones(len(items))
    for _ in range(30):
        v = (made(v)[items] * real).sum(1)
        v /= np.linalg.norm(v)
    rate = 1 / max(1e-9, (made(v) ** 2).sum() * 1.02)
    x = y = np.zeros(len(items))
    t = 1.0
    for _ in range(turns):
        grad = ((made(y) - histogram)[items] * real).sum(1)
        new = np.maximum(0, y - rate * grad)
        t_new = (1 + math.sqrt(1 + 4 * t * t)) / 2
        y, x, t = new + (t - 1) / t_new * (new - x), new, t_new
    return x


def plan(histogram: np.ndarray) -> tuple[dict[int, list[Use]], int]:
    """Uses of each step's items in order of rank, and the number of windows. histogram[s]: items of s steps."""
    slots = len(histogram) - 1
    have = histogram.astype(np.int64).copy()
    taken = np.zeros(slots + 1, np.int64)
    uses: dict[int, list[Use]] = {}
    windows = 0

    def use(pattern: list[int], times: int, cut: int = 0, gap: int = 0) -> None:
        """``times`` windows of these steps; their last ``gap`` steps come from items of ``cut`` steps."""
        nonlocal windows
        for place, s in enumerate([*pattern, *[cut] * bool(cut)]):
            at_cut = cut and place == len(pattern)
            left = (s - gap, int(taken[s - gap] + have[s - gap])) if at_cut else (0, 0)
            uses.setdefault(s, []).append(Use(int(taken[s]), windows, place, gap if at_cut else s, *left))
            taken[s] += times
            have[s] -= times
            if at_cut:
                have[s - gap] += times
        windows += times

    items = combinations(slots)
    items = items[((have[items] > 0) | (items == 0)).all(1)] if len(items) else items
    if len(items):
        for pattern, times in zip(items, np.floor(solve(items, have)).astype(np.int64), strict=True):
            steps, counts = np.unique(pattern[pattern > 0], return_counts=True)
            if times := int(min(times, *(have[steps] // counts))):
                use([int(s) for s in pattern if s], times)
    while have[1:].any():
        pattern: list[int] = []
        gap, free = slots, have.copy()
        for s in range(slots, 0, -1):
            n = min(int(free[s]), gap // s)
            pattern += [s] * n
            free[s] -= n
            gap -= n * s
        # Only a step larger than the gap is free now; the smallest one is cut.
        cut = next((s for s in range(gap + 1, slots + 1) if free[s]), 0) if gap else 0
        wanted = np.bincount(pattern + [cut] * bool(cut), minlength=slots + 1)
        times = int((have[wanted > 0] // wanted[wanted > 0]).min())
        use(pattern, times, cut, gap if cut else 0)
    return uses, windows


def tokenised(documents: DataFrame, tokenizer: str, end: int = END_ID) -> DataFrame:
    """doc_id, doc_tokens and ids (little-endian, 16 bits each) of every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_ids(tokenizer)
        try:
            for batch in batches:
                yield from _encoded(batch, encoder, end)
        finally:
            # The worker goes on to other tasks, and these words and Arrow's free memory would stay with it.
            encoder.clear()
            pa.default_memory_pool().release_unused()

    return text_of(documents).withColumn("doc_id", F.col("doc_id").cast("long")).mapInArrow(run, _TOKENS)


def _encoded(batch: pa.RecordBatch, encoder: WordIds, end: int) -> Iterator[pa.RecordBatch]:
    """Rows with their ids, so many texts at a time that their words are a bounded part of what is kept."""
    begin, chars = 0, pc.utf8_length(batch.column("text")).to_numpy(zero_copy_only=False).cumsum()
    while begin < batch.num_rows:
        stop = max(begin + 1, int(np.searchsorted(chars, (chars[begin - 1] if begin else 0) + ENCODED_CHARS, "right")))
        tokens, ids = encoder.encoded(batch.column("text").slice(begin, stop - begin), end)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(begin, stop - begin), pa.array(tokens, pa.int64()), ids], ["doc_id", "doc_tokens", "ids"])
        begin = stop


def _cut(uses: dict[int, list[Use]], window: int, step: int):
    """Pieces of each document; the plan is bounded by the window's length, not by the data."""
    starts = {s: np.array([u.rank for u in own]) for s, own in uses.items()}

    def pieces(tokens: int, rank: int) -> Iterator[tuple[int, int, int | None, int]]:
        whole = tokens // window * window
        yield from ((at, window, None, 0) for at in range(0, whole, window))
        at, left = whole, tokens - whole
        s = -(-left // step)
        while s:
            u = uses[s][int(np.searchsorted(starts[s], rank, "right")) - 1]
            sequence = u.sequence + rank - u.rank
            length = u.steps * step if u.left_step else left
            yield at, length, sequence, u.place
            s, rank, at, left = u.left_step, u.left_rank + rank - u.rank, at + length, left - length

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for doc, tokens, ids, rank in zip(*(batch[c] for c in ("doc_id", "doc_tokens", "ids", "rank")), strict=True):
                for at, length, sequence, place in pieces(tokens, rank):
                    crc = zlib.crc32(np.frombuffer(ids, np.uint16, length, 2 * at).astype("<u4").tobytes())
                    out.append((doc, at, length, crc, tokens, sequence, place))
            frame = pd.DataFrame(out, columns=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence", "place"])
            yield frame.astype({"doc_id": "Int64", "sequence": "Int64"})

    return run


def pack(tokens: DataFrame, window: int = WINDOW, step: int = STEP, ranked_rows: int = RANKED_ROWS) -> DataFrame:
    """Pieces of a table with doc_id, doc_tokens and ids: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    if window % step:
        raise ValueError("the window must be a whole number of steps")
    with scratch(tokens.sparkSession) as keep:
        tokens = saved(tokens.withColumn("row", F.monotonically_increasing_id()), "tokens")
        tokens = tokens.withColumn("steps", F.expr(f"cast(ceil((doc_tokens % {window}) / {step}) AS int)"))
        counted = {r["steps"]: r["n"] for r in tokens.groupBy("steps").agg(F.count("*").alias("n")).collect()}
        histogram = np.zeros(window // step + 1, np.int64)
        for s, n in counted.items():
            histogram[s] = n
        full = int(histogram[0])
        histogram[0] = 0
        uses, windows = plan(histogram)
        # Ranks within a step: places in chunks of rows, and the rows before each chunk.
        shares = max(1, math.ceil((int(histogram.sum()) + full) / ranked_rows))
        rows = tokens.withColumn("share", F.pmod(F.xxhash64("row"), F.lit(shares)))
        chunks = rows.groupBy("steps", "share").agg(F.count("*").alias("n"))
        chunks = chunks.selectExpr("steps", "share", "sum(n) OVER (PARTITION BY steps ORDER BY share) - n AS before")
        ranked = rows.select("row", "steps", "share").selectExpr("*", "row_number() OVER (PARTITION BY steps, share ORDER BY row) - 1 AS place")
        ranks = ranked.join(chunks, ["steps", "share"]).select("row", (F.col("before") + F.col("place")).alias("rank"))
        placed = tokens.select("row", "doc_id", "doc_tokens", "ids").join(ranks, "row")
        pieces = keep(placed.mapInPandas(_cut(uses, window, step), _PIECES), "pieces")
    # Whole windows are numbered behind the planned ones.
    planned = pieces.where("sequence IS NOT NULL").withColumnRenamed("sequence", "sequence_id")
    planned = planned.selectExpr(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id",
        "sum(length) OVER (PARTITION BY sequence_id ORDER BY place) - length AS offset",
    )
    whole = pieces.where("sequence IS NULL").withColumn("sequence_id", F.monotonically_increasing_id() + windows)
    return planned.union(whole.selectExpr("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "0L AS offset"))


def sequences(pieces: DataFrame, tokens: DataFrame) -> DataFrame:
    """The packed windows themselves: sequence_id, length and ids (little-endian, 16 bits each). Ids of documents must differ."""
    texts = tokens.select(F.col("doc_id").alias("__doc"), "ids")
    cut = pieces.join(texts, pieces["doc_id"].eqNullSafe(texts["__doc"])).selectExpr("sequence_id", "offset", "length", "substring(ids, cast(start * 2 + 1 AS int), cast(length * 2 AS int)) AS ids")
    grouped = cut.groupBy("sequence_id").agg(F.sum("length").alias("length"), F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return grouped.selectExpr("sequence_id", "length", "aggregate(parts, X'', (a, p) -> concat(a, p.ids)) AS ids")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def pack_documents(documents: DataFrame, tokenizer: str | None = None) -> DataFrame:
    return pack(tokenised(documents, tokenizer or default_tokenizer()))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
