"""Benchmark decontamination: shared word pairs find test items in training documents, Smith-Waterman alignment scores them.

In an alignment a match is 1, a different, missing or added word -1; the best local alignment over the item's length is the
score. An item counts as found from ``FOUND`` on, which a few edits in ten words do not hide, if that is ``LEAST_WORDS`` or
the whole of a shorter item.

The benchmark is taken in blocks of a bounded number of words; for each block one pass goes over the documents, and no text
is shuffled. Where an item is aligned follows from arithmetic and not from how frequent its words are: m matches with e
errors stand in e + 1 runs at most, so that an alignment worth t = m - e holds t - 1 pairs of neighbouring words of the
item, within 2 * length - t words of the text. Every place with so many pairs is aligned, and no other place can be found.

Words are what stands between ASCII white space, A-Z in lower case. Empty or null items and texts match nothing. Repeated rows are reported once per row, items once per row too.
A document is reported once for each item, with the best place. Empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logtally.llm.tables import rows_with, text_of
from logtally.llm.words import mixed, split_words

SEED_WORDS = 2
LEAST_WORDS = 3
FOUND = 0.5
BLOCK_WORDS = 200_000
#: Cells of one alignment step, at most; more windows go in several steps.
CELLS = 2_000_000

_HITS = "doc_id long, item_id long, score double, first_word long, last_word long"


class Block(NamedTuple):
    """Items as word numbers, and their word pairs: codes in order, and for each the items that have it in ``of``."""

    words: dict[bytes, int]
    ids: list
    items: list[np.ndarray]
    lengths: np.ndarray
    widths: np.ndarray
    codes: np.ndarray
    edges: np.ndarray
    of: np.ndarray


def _codes(numbers: np.ndarray, width: int) -> np.ndarray:
    """A code of the n-gram at each place but the last ones; 0 where a word is unknown."""
    count = len(numbers) - width + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    total, known = np.full(count, width, np.uint64), np.ones(count, bool)
    for i in range(width):
        part = numbers[i : i + count]
        known &= part >= 0
        total = total * np.uint64(0x9E3779B97F4A7C15) + part.astype(np.uint64)
    return np.where(known, mixed(total) | np.uint64(1), np.uint64(0))


def block_of(rows: list[tuple]) -> Block:
    """(item_id, text) rows to a block; items without words are left out."""
    words: dict[bytes, int] = {}
    ids, items, codes, of = [], [], [], []
    for item_id, text in rows:
        numbers = np.array([words.setdefault(w, len(words)) for w in split_words(text)], np.int64)
        if not len(numbers):
            continue
        own = np.unique(_codes(numbers, min(SEED_WORDS, len(numbers))))
        codes.append(own)
        of.append(np.full(len(own), len(items)))
        ids.append(item_id)
        items.append(numbers)
    if not items:
        none = np.zeros(0, np.int64)
        return Block(words, [], [], none, none, np.zeros(0, np.uint64), np.zeros(1, np.int64), none)
    every, places = np.concatenate(codes), np.concatenate(of)
    order = np.argsort(every, kind="stable")
    found, first = np.unique(every[order], return_index=True)
    lengths = np.array([len(x) for x in items])
    return Block(words, ids, items, lengths, np.unique(np.minimum(SEED_WORDS, lengths)), found, np.r_[first, len(every)], places[order])


def _found(block: Block, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word numbers of a text, and the places and code indexes of the block's word pairs in it."""
    get = block.words.get
    numbers = np.array([get(w, -1) for w in split_words(text)], np.int64)
    places, found = [], []
    for width in block.widths:
        codes = _codes(numbers, int(width))
        at = np.flatnonzero(codes)
        index = np.searchsorted(block.codes, codes[at])
        hit = (index < len(block.codes)) & (block.codes[np.minimum(index, len(block.codes) - 1)] == codes[at])
        places.append(at[hit])
        found.append(index[hit])
    return numbers, np.concatenate(places), np.concatenate(found)


def least_scores(lengths: np.ndarray, least: float) -> np.ndarray:
    """The score, in words, from which an item of each length counts as found."""
    return np.maximum(np.ceil(least * lengths - 1e-9).astype(np.int64), np.minimum(LEAST_WORDS, lengths))


def align(item: np.ndarray, windows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best local alignment of an item with each window: score, and the first and the end place in the window."""
    width = max(map(len, windows))
    text = np.full((len(windows), width), -2, np.int64)
    for i, w in enumerate(windows):
        text[i, : len(w)] = w
    shape = (len(windows), width + 1)
    score, start = np.zeros(shape, np.int64), np.tile(np.arange(width + 1), (len(windows), 1))
    best, first, last = (np.zeros(len(windows), np.int64) for _ in range(3))
    ramp, row = np.arange(width + 1), np.arange(len(windows))
    for word in item:
        diagonal = score[:, :-1] + np.where(text == word, 1, -1)
        above = score[:, 1:] - 1
        new, begun = np.zeros(shape, np.int64), np.tile(ramp, (len(windows), 1))
        take = np.maximum(diagonal, above)
        better = take > 0
        new[:, 1:] = np.where(better, take, 0)
        begun[:, 1:] = np.where(better, np.where(diagonal >= above, start[:, :-1], start[:, 1:]), ramp[1:])
        # A gap in the item costs one per skipped word: the best of all earlier places less their distance.
        lifted = new + ramp
        top = np.maximum.accumulate(lifted, 1)
        source = np.maximum.accumulate(np.where(lifted == top, ramp, 0), 1)
        new, start = np.maximum(top - ramp, 0), np.take_along_axis(begun, source, 1)
        start = np.where(new > 0, start, ramp)
        score = new
        at = score.argmax(1)
        more = score[row, at] > best
        best, first, last = np.where(more, score[row, at], best), np.where(more, start[row, at], first), np.where(more, at, last)
    return best, first, last


def _windows(block: Block, needed: np.ndarray, text: str) -> Iterator[tuple[int, int, np.ndarray]]:
    """(item, place of the window, its words) wherever a text has enough pairs of an item; windows that touch are one."""
    numbers, places, codes = _found(block, text)
    times = block.edges[codes + 1] - block.edges[codes]
    which = np.repeat(block.edges[codes] - np.cumsum(times) + times, times) + np.arange(times.sum())
    item, place = block.of[which], np.repeat(places, times)
    pairs = np.maximum(needed - 1, 1)
    enough = np.bincount(item, minlength=len(block.items)) >= pairs
    item, place = item[enough[item]], place[enough[item]]
    order = np.lexsort((place, item))
    item, place = item[order], place[order]
    # From each pair on, whether the last one that is needed is of the same item and near enough.
    last = np.arange(len(item)) + pairs[item] - 1
    near = np.flatnonzero(last < len(item))
    near = near[item[last[near]] == item[near]]
    span = 2 * block.lengths[item] - needed[item]
    near = near[place[last[near]] - place[near] + np.minimum(SEED_WORDS, block.lengths[item[near]]) <= span[near]]
    lows, highs = np.maximum(place[last[near]] + SEED_WORDS - span[near], 0), np.minimum(place[near] + span[near], len(numbers))
    held = None
    for i, a, b in zip(item[near].tolist(), np.minimum(lows, place[near]).tolist(), highs.tolist(), strict=True):
        if held and held[0] == i and a <= held[2]:
            held = (i, held[1], max(held[2], b))
            continue
        if held:
            yield held[0], held[1], numbers[held[1] : held[2]]
        held = (i, a, b)
    if held:
        yield held[0], held[1], numbers[held[1] : held[2]]


def _best(block: Block, needed: np.ndarray, texts: list[str]) -> dict[tuple[int, int], tuple[int, int, int]]:
    """Of each (text, item) that is found: the score in words, the first place, negative, and the end."""
    asked: dict[int, list[tuple[int, int, np.ndarray]]] = {}
    for row, text in enumerate(texts):
        for item, place, words in _windows(block, needed, text):
            asked.setdefault(item, []).append((row, place, words))
    best: dict[tuple[int, int], tuple[int, int, int]] = {}
    for item, own in asked.items():
        own.sort(key=lambda x: len(x[2]))
        while own:
            n = max(1, min(len(own), CELLS // max(1, len(own[min(len(own), 256) - 1][2]))))
            n = max(1, min(n, 256))
            part, own = own[:n], own[n:]
            for (row, place, _), s, a, b in zip(part, *align(block.items[item], [w for _, _, w in part]), strict=True):
                if s >= needed[item]:
                    found = (int(s), -(place + int(a)), place + int(b))
                    best[row, item] = max(found, best.get((row, item), found))
    return best


def _scorer(block: Block, least: float):
    needed = least_scores(block.lengths, least)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            best = _best(block, needed, batch["text"].tolist())
            out = [(batch["doc_id"].iloc[r], block.ids[i], s / len(block.items[i]), -a, b) for (r, i), (s, a, b) in best.items()]
            frame = pd.DataFrame(out, columns=["doc_id", "item_id", "score", "first_word", "last_word"])
            yield frame.astype({"doc_id": "Int64", "item_id": "Int64"})

    return run


def _blocks(benchmark: DataFrame, block_words: int) -> Iterator[Block]:
    items = benchmark.select("item_id", F.coalesce("text", F.lit("")).alias("text"))
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(chars / 4 / block_words))
    for k in range(blocks):
        block = block_of([tuple(r) for r in items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).collect()])
        if block.items:
            yield block


def contaminated(documents: DataFrame, benchmark: DataFrame, least: float = FOUND, block_words: int = BLOCK_WORDS) -> DataFrame:
    """doc_id, item_id, score, first_word, last_word (end excluded) of every item found in a document."""
    documents = text_of(documents)
    found = documents.sparkSession.createDataFrame([], _HITS)
    for block in _blocks(benchmark, block_words):
        found = found.union(documents.mapInPandas(_scorer(block, least), _HITS))
    return found


def _clean(block: Block, least: float):
    needed = least_scores(block.lengths, least)

    def keep(texts: list[str]) -> list[bool]:
        rows = {row for row, _ in _best(block, needed, texts)}
        return [row not in rows for row in range(len(texts))]

    return keep


def drop_contaminated(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents in which no item is found, with all columns. Rows that share an id, or have none, are told apart."""
    for block in _blocks(benchmark, BLOCK_WORDS):
        documents = rows_with(documents, _clean(block, FOUND))
    return documents


def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
