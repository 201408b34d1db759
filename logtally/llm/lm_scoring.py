"""Language-model scores: a smoothed word model, and online logistic context mixing over bytes.

Training texts are counted twice, over all of them: words and bytes, and the slots of the bit predictors of ``context_mixing``. Slot
counts are added up in Spark by pieces of the tables, whose size is fixed, apart for two halves of the training texts by
checksum. The mixing weights and the refinement are then learned online from every training text, each with the counts
of the other half, so that it is unseen text: each task goes through its texts, and what the tasks have learned is averaged in
Spark. The model is a few megabytes whatever the corpus. Scoring is one pass over all texts.

For the word model, the most frequent words, at most ``HEAD_WORDS``, are looked up where the text is; the other words are
joined with the whole table of counts.

A text is lower-cased in A-Z; its words stand between ASCII white space, and an end mark follows that is counted as a
word. Null text counts as empty: it is the end mark alone. Texts may be of any length. Other columns are ignored. A null id counts as '' for the split. Repeated rows count as often as
they occur and get equal scores. Without training rows all counts are 0. An empty table gives no rows.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logtally.llm import context_mixing as mixing
from logtally.llm.tables import saved, text_of, training_row

HELD_OUT = 10
ALPHA = 0.1
HEAD_WORDS = 200_000
#: Words that a task counts before it hands them on.
COUNTED_WORDS = 250_000
#: Bytes that are counted, learned from, and scored, at once.
COUNTED_BYTES = 500_000
LEARNED_BYTES = 500_000
SCORED_BYTES = 500_000
PIECES = 64

#: The end mark; no word is empty.
_END = ""
#: What stands before the number of a byte; no word has white space.
_BYTE = " "


def _parts(texts: Iterator, size: int) -> Iterator[list]:
    """Lists of items whose texts, the last entries, make up about so many bytes."""
    own, held = [], 0
    for item in texts:
        own.append(item)
        held += len(item[-1])
        if held >= size:
            yield own
            own, held = [], 0
    if own:
        yield own


def _bytes(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass")


def _counted(counts: Counter[bytes]) -> pd.DataFrame:
    return pd.DataFrame({"word": [w.decode("utf-8", "replace") for w in counts], "n": list(counts.values())})


def _count_words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    counts: Counter[bytes] = Counter()
    histogram = np.zeros(256, np.int64)
    for batch in batches:
        for text in batch["text"]:
            raw = _bytes(text)
            histogram += np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
            histogram[mixing.END] += 1
            counts.update(raw.lower().split())
            counts[b""] += 1
            if len(counts) > COUNTED_WORDS:
                yield _counted(counts)
                counts.clear()
    counts.update({f"{_BYTE}{b}".encode(): int(n) for b, n in enumerate(histogram) if n})
    if counts:
        yield _counted(counts)


def word_counts(training: DataFrame) -> tuple[DataFrame, np.ndarray]:
    """word, n of all words of the training texts, the end mark being ''; how often each byte occurs, with the ends of texts."""
    counts = saved(training.select("text").mapInPandas(_count_words, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")), "words")
    of_byte = F.col("word").startswith(_BYTE)
    histogram = np.zeros(256, np.int64)
    for r in counts.where(of_byte).collect():
        histogram[int(r["word"])] = r["n"]
    return counts.where(~of_byte), histogram


def _halves(batches: Iterator[pd.DataFrame], most: int, least: int | None = None) -> Iterator[tuple[int, list[bytes]]]:
    """Texts of one half or the other, about so many bytes at a time, or more and more from the least on."""
    size = least or most
    own: list[list[bytes]] = [[], []]
    held = [0, 0]
    for batch in batches:
        for half, text in zip(batch["half"], batch["text"], strict=True):
            own[half].append(_bytes(text))
            held[half] += len(own[half][-1])
            if held[half] >= size:
                yield half, own[half]
                own[half], held[half] = [], 0
                size = min(most, size + size // 4)
    for half in (0, 1):
        if own[half]:
            yield half, own[half]


#: Numbers as pieces: added up by piece and share, then by piece.
_PIECES = "piece int, share int, counts binary"


def _in_pieces(total: np.ndarray) -> pd.DataFrame:
    edges = np.linspace(0, len(total), PIECES + 1).astype(int)
    parts = [zlib.compress(total[a:b].tobytes(), 1) for a, b in zip(edges[:-1], edges[1:], strict=True)]
    return pd.DataFrame({"piece": range(PIECES), "share": int(total.sum()) % 64, "counts": parts})


def _slot_counter(code: mixing.Code):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counter = None
        for half, part in _halves(batches, COUNTED_BYTES):
            counter = counter or mixing.SlotCounter(code)
            counter.add(half, part)
        if counter:
            yield _in_pieces(counter.counts().ravel())

    return run


def _learner(models):  # noqa: ANN001
    """models is a broadcast: the model that hasn't seen the texts of each half."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        learner = None
        for half, part in _halves(batches, LEARNED_BYTES, LEARNED_BYTES // 32):
            learner = learner or mixing.Learner(models.value[half].weights)
            learner.add(models.value[half], part)
        if learner:
            yield _in_pieces(learner.sums())

    return run


def _added(parts: pd.DataFrame) -> pd.DataFrame:
    total = sum(np.frombuffer(zlib.decompress(c), np.int64) for c in parts["counts"])
    return pd.DataFrame({"piece": [parts["piece"].iloc[0]], "counts": [zlib.compress(total.tobytes(), 1)]})


def _sum_of(parts: DataFrame) -> np.ndarray | None:
    """All tasks' numbers added in two steps; nothing if there are none."""
    parts = parts.groupBy("piece", "share").applyInPandas(_added, "piece int, counts binary")
    parts = parts.groupBy("piece").applyInPandas(_added, "piece int, counts binary").collect()
    if not parts:
        return None
    return np.concatenate([np.frombuffer(zlib.decompress(r["counts"]), np.int64) for r in sorted(parts, key=lambda r: r["piece"])])


def slot_counts(training: DataFrame, code: mixing.Code) -> np.ndarray:
    """Counts of the predictors' slots over all training texts, one row for each half."""
    found = _sum_of(training.select("half", "text").mapInPandas(_slot_counter(code), _PIECES))
    return np.zeros((2, 2 * sum(mixing.SLOTS)), np.int64) if found is None else found.reshape(2, -1)


def train(training: DataFrame, histogram: np.ndarray) -> mixing.Model:
    """The mixing model of all training texts (id, text), in which each byte occurs so often."""
    training = training.withColumn("half", (F.crc32(F.concat(F.lit("mix:"), F.col("id"))) % 2).cast("int"))
    code = mixing.code_of(histogram)
    counts = slot_counts(training, code)
    model = mixing.start_model(counts[0] + counts[1], code)
    unseen = training.sparkSession.sparkContext.broadcast([mixing.start_model(counts[1 - half], code) for half in (0, 1)])
    sums = _sum_of(training.select("half", "text").mapInPandas(_learner(unseen), _PIECES))
    unseen.unpersist()
    return model if sums is None else mixing.learned(model, sums)


def _head(counts: DataFrame, most: int) -> dict[bytes, int]:
    """The most frequent words: all from some count on, at most so many."""
    grade = F.floor(F.log2("n") * 4).cast("int")
    held, least = 0, None
    for r in counts.groupBy(grade.alias("grade")).agg(F.count("*").alias("words")).orderBy(F.desc("grade")).collect():
        held += r["words"]
        if held > most:
            break
        least = r["grade"]
    if least is None:
        return {}
    return {r["word"].encode("utf-8", "surrogatepass"): r["n"] for r in counts.where(grade >= least).collect()}


_SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, base double, score double, bits_per_byte double, rare array<string>, times array<int>"


def _scorer(head, model):  # noqa: ANN001
    """head and model are broadcasts of bounded size."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        logs = {w: math.log10(n + ALPHA) for w, n in head.value.items()}
        scorer = mixing.Scorer(model.value)
        for batch in batches:
            for part in _parts(zip(batch["doc_id"], batch["held_out"], map(_bytes, batch["text"]), strict=True), SCORED_BYTES):
                scores = scorer.add([x[-1] for x in part])
                out = []
                for (doc_id, held_out, raw), score in zip(part, scores, strict=True):
                    words = raw.lower().split()
                    found = list(map(logs.get, words))
                    base = [x for x in found if x is not None]
                    rare = Counter(w for w, x in zip(words, found, strict=True) if x is None) if len(base) < len(words) else {}
                    rare[b""] = 1
                    bits = -score / math.log(2)
                    out.append((doc_id, held_out, len(words) + 1, len(base), math.fsum(base), score / math.log(10), bits / (len(raw) + 1), [w.decode("utf-8", "replace") for w in rare], list(rare.values())))
                frame = pd.DataFrame(out, columns=[c.split()[0] for c in _SCORED.split(", ")])
                yield frame.astype({"doc_id": "Int64"})

    return run


def scored(documents: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte of every document."""
    spark = documents.sparkSession
    rows = text_of(documents).select("doc_id", (~training_row(F.col("doc_id"), HELD_OUT)).alias("held_out"), "text")
    training = rows.where("NOT held_out").select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), "text")
    counts, histogram = word_counts(training)
    total, different, texts = counts.agg(F.sum("n"), F.count("*"), F.sum(F.when(F.col("word") == _END, F.col("n")))).first()
    total, different = total or 0, different or 0
    head = _head(counts.where(F.col("word") != _END), HEAD_WORDS)
    passed = rows.mapInPandas(_scorer(spark.sparkContext.broadcast(head), spark.sparkContext.broadcast(train(training, histogram))), _SCORED)
    passed = saved(passed.withColumn("row", F.monotonically_increasing_id()), "scored")
    # The end mark has a count like any other word, but as it is in every text it is added without a join.
    rare = passed.select("row", F.explode(F.arrays_zip("rare", "times")).alias("r")).select("row", F.col("r.rare").alias("word"), F.col("r.times").alias("times")).where(F.col("word") != _END)
    n = F.coalesce("n", F.lit(0))
    rare = rare.join(counts, "word", "left").groupBy("row").agg(F.sum(F.when(n > 0, F.col("times"))).alias("more"), F.sum(F.log10(n + ALPHA) * F.col("times")).alias("rest"))
    found = passed.join(rare, "row", "left")
    ends = texts or 0
    each = math.log10(total + ALPHA * (different + 1))
    base = F.col("base") + F.coalesce("rest", F.lit(0.0)) + math.log10(ends + ALPHA) - F.col("n_tokens") * each
    known = F.col("n_known") + F.coalesce("more", F.lit(0)) + (1 if ends else 0)
    return found.select("doc_id", "held_out", "n_tokens", known.cast("long").alias("n_known"), F.lit(total).cast("long").alias("train_tokens"), base.alias("base_score"), "score", "bits_per_byte")


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(spark.read.parquet(f"{sf_dir}/documents.parquet"))
