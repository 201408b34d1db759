"""Toxicity by gradient-boosted trees over a few dense features, with isotonic calibration.

A text is described by shares over its whole length: words of a lexicon, lexicon words near a second-person pronoun, capitals,
punctuation, and words that hide letters behind digits and signs. The lexicon has a few fixed words and those that toxic
training rows have and others don't: by documents that have a word, the log odds and how many standard errors they stand
above zero. A training row's own share in these counts is taken out before it is described, so that the trees don't learn
to trust words for the very rows they were found in.

Two ensembles of trees are fitted, each to one half of the training rows. The half that an ensemble hasn't seen is what the
calibration is fitted to: a monotone step from the ensembles' probability to the share of toxic rows. A document's score is
the calibrated mean of both; a thousandth of it is the mean itself, which keeps the order within a step.

The fit uses at most ``LABELLED`` labels of either kind, those with the smallest checksums of their ids, and one text per
id. Everything else works on all rows and whole texts. With labels of one kind only that kind's number is every score, without
any label 0. Null text counts as empty; it gets a score like any other, as does a text of any length. Rows with the same text
get the same score, rows with one id each their own. Where several rows have a labelled id, the smallest text is learned from;
repeated labels count once, contradicting ones both; null labels and labels of no document don't count. An empty table gives
no rows. Other columns are ignored.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections.abc import Iterator, Mapping
from typing import NamedTuple

import pandas as pd
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logtally.llm.tables import saved, text_of, training_row

HELD_OUT = 5
#: Labels of either kind that are learned from, at most.
LABELLED = 20_000
#: Words of the learned lexicon, at most: the ones that stand out most.
LEXICON = 2_000
CUT = 0.5
#: Standard errors by which a lexicon word's log odds lie above zero, and log odds from which it is a weak or a strong one.
CLEAR, WEAK, STRONG = 3.0, 0.8, 2.0
#: Words around a lexicon word that are searched for a second person.
NEAR = 4
TREES, DEPTH = 20, 3
#: The weight of the trees' own probability in the score.
ORDER = 1e-3

# Insults that need no label.
INSULTS = frozenset(
    "idiot moron imbecile stupid dumb fool loser pathetic worthless disgusting trash garbage scum clown pig jerk hate ugly vermin filth".split()
)
# Second persons in English, German, French and Spanish.
SECOND_PERSON = frozenset("you your yours yourself ur du dich dir dein deine ihr euch tu te toi ton ta vous votre tú usted ustedes vosotros tus".split())
# Signs that stand for letters.
_HIDDEN = str.maketrans("013457@$!", "oieastasi")

_WORD = re.compile(r"[^\W\d_]+")
_MASKED = re.compile(r"[^\W\d_][^\W_]*[0-9@$!*][^\s]*[^\W_]")
_LONG = re.compile(r"([^\W\d_])\1\1")
_SHOUT = re.compile(r"\b[^\W\d_a-zß-öø-ÿ]{3,}\b")
_SIGNS = re.compile(r"[!?]")
_RUNS = re.compile(r"[!?*#%&$]{2,}")
FEATURES = 15

Counts = Mapping[str, tuple[int, int]]


class Lexicon(NamedTuple):
    """Words with the toxic and the other training rows that have them, and how many rows of either kind there are."""

    words: Counts
    toxic: int
    other: int

    def odds(self, word: str, label: int | None = None) -> tuple[float, float]:
        """Log odds and their standard error; of a training row's label, that row left out."""
        t, o = self.words[word]
        t, o = t - (label == 1), o - (label == 0)
        toxic, other = self.toxic - (label == 1), self.other - (label == 0)
        odds = math.log((t + 0.5) / (toxic + 1)) - math.log((o + 0.5) / (other + 1))
        return odds, math.sqrt(1 / (t + 0.5) + 1 / (o + 0.5))


def describe(text: str, lexicon: Lexicon, label: int | None = None) -> list[float]:
    """Numbers about a text; ``label`` is given for a row that the lexicon was learned from."""
    words = _WORD.findall(text.lower())
    n = max(1, len(words))
    persons = [i for i, w in enumerate(words) if w in SECOND_PERSON]
    hits = [(i, w) for i, w in enumerate(words) if w in lexicon.words or w in INSULTS]
    masked = _MASKED.findall(text)
    unmasked = ["".join(_WORD.findall(w.lower().translate(_HIDDEN))) for w in masked]
    revealed = sum(w in lexicon.words or w in INSULTS for w in unmasked)
    fixed = weak = strong = close = 0
    most = total = 0.0
    for i, w in hits:
        odds, error = lexicon.odds(w, label) if w in lexicon.words else (0.0, 1.0)
        clear = odds >= CLEAR * error
        bad = w in INSULTS or clear and odds >= STRONG
        fixed += w in INSULTS
        strong += bad
        weak += clear and WEAK <= odds < STRONG
        if clear:
            most, total = max(most, odds), total + max(0.0, odds)
        if bad:
            k = bisect_left(persons, i - NEAR)
            close += k < len(persons) and persons[k] <= i + NEAR
    letters = sum(map(len, words))
    capitals = sum(map(str.isupper, text)) if not text.islower() else 0
    return [
        fixed / n, strong / n, weak / n, math.log1p(fixed), math.log1p(strong), most, total / n, close / n,
        len(persons) / n, capitals / max(1, letters), len(_SHOUT.findall(text)) / n,
        len(_SIGNS.findall(text)) / n, len(_RUNS.findall(text)) / n, len(masked) / n + len(_LONG.findall(text)) / n, float(revealed),
    ]


def sample(documents: DataFrame, labels: DataFrame, labelled: int = LABELLED, held_out_parts: int = HELD_OUT) -> DataFrame:
    """The rows that are learned from: doc_id, toxic, text."""
    order = F.crc32(F.concat(F.lit("fit:"), F.col("doc_id").cast("string")))
    known = labels.where("toxic IN (0, 1) AND doc_id IS NOT NULL").where(training_row(F.col("doc_id"), held_out_parts))
    known = known.select("doc_id", "toxic").distinct()
    taken = known.where("toxic = 1").orderBy(order, "doc_id").limit(labelled)
    taken = taken.union(known.where("toxic = 0").orderBy(order, "doc_id").limit(labelled))
    # Twice the bound at most, whatever the tables: an id and a number each.
    ids = F.broadcast(saved(taken, "labelled"))
    return saved(text_of(documents).join(ids, "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text")), "sample")


def learn_lexicon(rows: DataFrame, size: int = LEXICON) -> Lexicon:
    """The words that set the toxic rows apart, counted by rows that have them."""
    of = {row["toxic"]: row["count"] for row in rows.groupBy("toxic").count().collect()}
    toxic, other = of.get(1, 0), of.get(0, 0)
    words = F.explode(F.array_distinct(F.split(F.lower("text"), r"[^\p{L}]+"))).alias("word")
    counts = rows.select("toxic", words).where("word != ''").groupBy("word")
    counts = counts.agg(F.count_if(F.col("toxic") == 1).alias("t"), F.count_if(F.col("toxic") == 0).alias("o"))
    odds = F.log((F.col("t") + 0.5) / (toxic + 1)) - F.log((F.col("o") + 0.5) / (other + 1))
    clear = odds / F.sqrt(1 / (F.col("t") + 0.5) + 1 / (F.col("o") + 0.5))
    found = counts.where(odds >= WEAK).where(clear >= CLEAR).orderBy(clear.desc(), "word").limit(size).collect()
    return Lexicon({row["word"]: (row["t"], row["o"]) for row in found}, toxic, other)


def described(rows: DataFrame, lexicon: Lexicon, *kept: str) -> DataFrame:
    """The features of each row beside the kept columns; a column ``toxic`` among these says that the row was learned from."""
    fields = ", ".join(f"{name} {rows.schema[name].dataType.simpleString()}" for name in kept)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            labels = batch["toxic"] if "toxic" in kept else [None] * len(batch)
            found = [describe(t, lexicon, label) for t, label in zip(batch["text"], labels, strict=True)]
            # An id column with nulls comes as floats, which would not hold every id.
            yield batch[list(kept)].assign(features=found)

    ids = [F.col(name).cast("string").alias(name) if name == "doc_id" else F.col(name) for name in kept]
    schema = fields.replace("doc_id bigint", "doc_id string") + ", features array<double>"
    out = rows.select(*ids, "text").mapInPandas(run, schema)
    return out.withColumn("doc_id", F.col("doc_id").cast("long")) if "doc_id" in kept else out


class Model(NamedTuple):
    lexicon: Lexicon
    trees: tuple[GBTClassificationModel, ...]
    steps: IsotonicRegressionModel | None
    #: The score where there are no trees.
    flat: float = 0.0

    def score(self, rows: DataFrame) -> DataFrame:
        """The rows with ``features`` replaced by ``score``."""
        if not self.trees:
            return rows.drop("features").withColumn("score", F.lit(self.flat))
        out = rows.withColumn("features", array_to_vector("features"))
        for tree in self.trees:
            out = tree.transform(out)
        mean = sum((vector_to_array(tree.getProbabilityCol())[1] for tree in self.trees), F.lit(0.0)) / len(self.trees)
        out = self.steps.transform(out.withColumn("raw", mean))
        score = (1 - ORDER) * F.greatest(F.least(F.col("step"), F.lit(1.0)), F.lit(0.0)) + ORDER * F.col("raw")
        return out.select(*[c for c in rows.columns if c != "features"], score.alias("score"))


def _trees(rows: DataFrame, k: int) -> GBTClassificationModel:
    trees = GBTClassifier(labelCol="label", maxIter=TREES, maxDepth=DEPTH, stepSize=0.2, minInstancesPerNode=3, seed=7)
    trees = trees.setRawPredictionCol(f"margin{k}").setProbabilityCol(f"probability{k}").setPredictionCol(f"class{k}")
    return trees.fit(rows)


def learn(documents: DataFrame, labels: DataFrame, labelled: int = LABELLED) -> Model:
    rows = sample(documents, labels, labelled)
    lexicon = learn_lexicon(rows)
    if not (lexicon.toxic and lexicon.other):
        return Model(lexicon, (), None, float(lexicon.toxic > 0))
    # At most 2 * LABELLED rows of a few numbers: one partition in a fixed order makes the fit the same each time.
    half = F.crc32(F.concat(F.lit("half:"), F.col("doc_id"))) % 2
    rows = described(rows, lexicon, "doc_id", "toxic").select(
        "doc_id", F.col("toxic").cast("double").alias("label"), array_to_vector("features").alias("features"), half.alias("half")
    )
    rows = saved(rows.repartition(1).sortWithinPartitions("doc_id", "label"), "described").coalesce(1)
    counts = {(r["half"], r["label"]) for r in rows.select("half", "label").distinct().collect()}
    if len(counts) < 4:
        trees = (_trees(rows, 0),)
        unseen = [trees[0].transform(rows)]
    else:
        trees = tuple(_trees(rows.where(F.col("half") == k), k) for k in (0, 1))
        unseen = [tree.transform(rows.where(F.col("half") == 1 - k)) for k, tree in enumerate(trees)]
    seen = [df.select("label", vector_to_array(tree.getProbabilityCol())[1].alias("raw")) for df, tree in zip(unseen, trees, strict=True)]
    pairs = saved(seen[0] if len(seen) == 1 else seen[0].union(seen[1]), "unseen").coalesce(1)
    return Model(lexicon, trees, IsotonicRegression(featuresCol="raw", labelCol="label", predictionCol="step").fit(pairs))


def scored(documents: DataFrame, labels: DataFrame, labelled: int = LABELLED, held_out_parts: int = HELD_OUT) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    model = learn(documents, labels, labelled)
    rows = text_of(documents).withColumn("held_out", ~training_row(F.col("doc_id"), held_out_parts))
    found = model.score(described(rows, model.lexicon, "doc_id", "held_out"))
    return found.select("doc_id", "held_out", "score", (F.col("score") >= CUT).cast("int").alias("predicted"))


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
