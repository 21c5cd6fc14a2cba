"""Toxicity from dense features: gradient-boosted trees and isotonic calibration.

The features are densities of lexicon words, how many of them stand near a second
person, and rates of capitals, punctuation and obfuscation. Besides a fixed lexicon of
insults there is a learned one: words and word beginnings that mark toxic documents
in the labelled sample, so that other languages and word forms are covered.

Learning reads at most ``SAMPLE`` labelled documents; all that it makes has a fixed
bound. Scoring is one narrow pass over whole texts, without a shuffle.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .calibration import isotonic_points
from .shared import in_fold, stage, text_of

#: Most labelled documents that learning reads: those with the smallest hash of their number.
SAMPLE = 20_000

# Insults, and second-person words of four languages.
INSULTS = (
    "ass asshole bastard bitch clown coward creep crap cretin damn degenerate disgusting dumb "
    "dumbass failure filth fool fraud freak garbage hate hideous hypocrite idiot idiotic imbecile "
    "jerk joke kill lazy liar loathsome loser lunatic moron nasty parasite pathetic pig psycho "
    "rat repulsive revolting ridiculous rubbish scum shit shut sick stupid trash twisted ugly "
    "useless vermin vile weak weirdo worthless wretched"
).split()
SECOND_PERSON = frozenset(
    "you your yours yourself u ur du dich dir dein deine ihr euch sie tu te toi ton ta tes vous "
    "votre vos tú ti tus usted ustedes vosotros".split()
)
# Characters that stand for letters.
LOOKALIKES = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "*": "", "-": "", ".": "", "_": ""})

FEATURES = [
    "log_words",
    "insult_density",
    "log_insults",
    "learned_density",
    "log_learned",
    "learned_strength",
    "near_second_person",
    "second_person",
    "upper",
    "shouted_words",
    "marks",
    "shouts",
    "obfuscated_words",
    "obfuscated_insults",
    "symbols",
]

_WORD = re.compile(r"\w+")
_MIXED = re.compile(r"[^\W\d_]+(?:[0-9@$!*._-]+[^\W\d_]+)+")
_SHOUT = re.compile(r"\b[A-Z]{3,}\b")
_YOU = re.compile(r"\b(?:" + "|".join(sorted(SECOND_PERSON)) + r")\b")
_LETTER_OF_WORD = re.compile(r"\w")
_CLASS = np.zeros(256, dtype=np.int64)
_CLASS[65:91] = 1
_CLASS[list(b".,;:?'\"()-")] = 2
_CLASS[list(b"!")] = 3
_CLASS[list(b"#$%&*@^~<>{}[]\\/+=_`|")] = 4
#: Characters before and after a hit in which a second-person word counts as near.
_NEAR = 40


@dataclass
class Lexicons:
    """``learned`` maps a word beginning to the log odds of its documents."""

    learned: dict[str, float]

    def automaton(self):
        import ahocorasick

        found = ahocorasick.Automaton()
        entries: dict[str, tuple[str, bool, float]] = {
            word: (word, True, self.learned.get(word, 0.0)) for word in INSULTS
        }
        for start, strength in self.learned.items():
            fixed = start in entries
            entries[start] = (start, fixed, strength)
        for start, value in entries.items():
            found.add_word(start, value)
        found.make_automaton()
        return found

    def features(self, texts: pd.Series) -> list[list[float]]:
        automaton = self.automaton()
        insults = frozenset(INSULTS)
        return [_features(text, automaton, insults) for text in texts]


def _features(text: str, automaton, insults: frozenset[str]) -> list[float]:
    low = text.lower()
    raw = np.frombuffer(text.encode(), dtype=np.uint8)
    chars = max(len(raw), 1)
    held = np.bincount(_CLASS[raw], minlength=5) / chars
    n_words = max(len(text.split()), 1)
    strengths: dict[int, float] = {}
    insulting: set[int] = set()
    for end, (entry, fixed, strength) in automaton.iter(low):
        start = end - len(entry) + 1
        if start and _LETTER_OF_WORD.match(low[start - 1]):
            continue
        if fixed and (end + 1 == len(low) or not _LETTER_OF_WORD.match(low[end + 1])):
            insulting.add(start)
        if strength:
            strengths[start] = max(strength, strengths.get(start, 0.0))
    hits = insulting | strengths.keys()
    near = sum(bool(_YOU.search(low[max(at - _NEAR, 0) : at + 2 * _NEAR])) for at in hits)
    weight = sum(strengths.values())
    mixed = _MIXED.findall(low) if held[2] + held[3] + held[4] > 0 or any(map(low.count, "0134")) else []
    return [
        math.log1p(n_words),
        len(insulting) / n_words,
        math.log1p(len(insulting)),
        weight / n_words,
        math.log1p(weight),
        max(strengths.values(), default=0.0),
        near / max(len(hits), 1),
        sum(map(low.count, (" you ", " your ", " du ", " tu ", " vous "))) / n_words,
        held[1],
        len(_SHOUT.findall(text)) / n_words if held[1] > 0 else 0.0,
        held[2],
        held[3],
        len(mixed) / n_words,
        sum(word.translate(LOOKALIKES) in insults for word in mixed) / n_words,
        held[4],
    ]


def learn_lexicon(sample: DataFrame, least_documents: int = 8, least_odds: float = 1.5) -> Lexicons:
    """Words and word beginnings of four letters and more that mark label 1.

    ``sample`` has ``text`` and ``label``; equal texts count once. An entry occurs in
    ``least_documents`` texts of label 1 and in a share of them that is ``exp(least_odds)``
    times that of the others. All such entries are kept: their number is bounded by the
    sample, and both counts of every entry are made by Spark.
    """
    once = sample.groupBy(F.sha2("text", 256).alias("name")).agg(
        F.first("text").alias("text"), F.max("label").alias("label")
    )
    sizes = {r["label"]: r["n"] for r in once.groupBy("label").agg(F.count("*").alias("n")).collect()}
    ones, others = sizes.get(1.0, 0), sizes.get(0.0, 0)
    if not ones or not others:
        return Lexicons({})

    @F.pandas_udf("array<string>")
    def entries(texts: pd.Series) -> pd.Series:
        return texts.map(_entries)

    share = F.col("ones") / ones
    elsewhere = (F.col("others") + 0.5) / (others + 1)
    marking = (
        once.select("label", F.explode(entries("text")).alias("entry"))
        .groupBy("entry")
        .agg(F.sum("label").alias("ones"), F.sum(1 - F.col("label")).alias("others"))
        .filter(F.col("ones") >= least_documents)
        .select("entry", F.log(share / elsewhere).alias("odds"))
        .filter(F.col("odds") >= least_odds)
    )
    return Lexicons({r["entry"]: r["odds"] for r in marking.collect()})


def _entries(text: str) -> list[str]:
    found: set[str] = set()
    for word in set(_WORD.findall(text.lower())):
        found.update(word[:n] for n in range(4, min(len(word), 7) + 1))
        found.add(word)
    return [e for e in found if len(e) >= 4]


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, folds: int, held_out: int, rows: int
) -> DataFrame:
    """``text, label, doc_id`` of at most ``rows`` labelled documents outside the held-out fold.

    The labels with the smallest hashes of their numbers are taken; as these are at
    most ``rows`` numbers, they are sent to the tasks that read the texts.
    """
    known = (
        labels.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.col(label).cast("double").alias("label"),
        )
        .filter(F.col("label").isin(0.0, 1.0) & ~in_fold(F.col("doc_id"), folds, held_out))
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rows)
    )
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return stage(texts.join(F.broadcast(known), "doc_id"), "sample")


@dataclass
class ToxicityModel:
    """Lexicons, trees and calibration; of bounded size."""

    lexicons: Lexicons
    trees: object | None
    constant: float
    at: list[float]
    share: list[float]

    def dense(self, texts: Column) -> Column:
        lexicons = self.lexicons

        @F.pandas_udf("array<double>")
        def features(batch: pd.Series) -> pd.Series:
            return pd.Series(lexicons.features(batch))

        return features(texts)

    def raw(self, featured: DataFrame) -> DataFrame:
        """Adds ``raw``, the trees' probability of label 1, to rows with ``features``."""
        if self.trees is None:
            return featured.withColumn("raw", F.lit(self.constant))
        vectors = featured.withColumn("vector", array_to_vector("features"))
        names = ["vector", "rawPrediction", "probability", "prediction"]
        return (
            self.trees.transform(vectors)
            .withColumn("raw", vector_to_array("probability")[1])
            .drop(*names)
        )

    def calibrated(self, raw: Column) -> Column:
        """The calibration between its steps, as a built-in expression."""
        at, share = F.lit(self.at), F.lit(self.share)
        above = F.size(F.filter(at, lambda x: x < raw))
        n = len(self.at)
        low, high = F.greatest(above, F.lit(1)), F.least(above + 1, F.lit(n))
        x0, x1 = F.element_at(at, low), F.element_at(at, high)
        y0, y1 = F.element_at(share, low), F.element_at(share, high)
        between = y0 + (y1 - y0) * (raw - x0) / (x1 - x0)
        return F.when(x1 > x0, between).otherwise(F.when(raw <= at[0], share[0]).otherwise(y1))


def train(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "toxic",
    folds: int = 3,
    held_out: int = 1,
    sample_rows: int = SAMPLE,
    trees: int = 25,
    depth: int = 4,
) -> ToxicityModel:
    """Learns lexicon, trees and calibration from a bounded labelled sample.

    A quarter of the sample, by a hash of the text, is kept for the calibration. With no
    usable labels every score is 0.5; with one label only, every score is that label.
    """
    sample = labelled_sample(docs, labels, label, folds, held_out, sample_rows)
    kept = F.pmod(F.xxhash64("text"), F.lit(4)) == 0
    totals = sample.agg(F.count("*").alias("n"), F.avg("label").alias("share")).first()
    if not totals["n"] or totals["share"] in (0.0, 1.0):
        constant = 0.5 if not totals["n"] else totals["share"]
        return ToxicityModel(Lexicons({}), None, constant, [0.0, 1.0], [0.0, 1.0])
    model = ToxicityModel(learn_lexicon(sample.filter(~kept)), None, 0.5, [0.0, 1.0], [0.0, 1.0])
    featured = stage(
        sample.select(model.dense(F.col("text")).alias("features"), "label", kept.alias("kept")),
        "features",
    )
    fitted = featured.filter("NOT kept").withColumn("vector", array_to_vector("features"))
    if fitted.select("label").distinct().count() < 2:
        model.constant = totals["share"]
        return model
    booster = GBTClassifier(
        featuresCol="vector", labelCol="label", maxIter=trees, maxDepth=depth, stepSize=0.2, seed=1
    )
    model.trees = booster.fit(fitted.select("vector", "label").coalesce(6))
    held = model.raw(featured.filter("kept")).select(F.col("raw").alias("score"), "label")
    model.at, model.share = isotonic_points(held)
    return model


def score(
    docs: DataFrame,
    labels: DataFrame,
    threshold: float = 0.7,
    folds: int = 3,
    held_out: int = 1,
    sample_rows: int = SAMPLE,
) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for each row of ``docs``.

    ``docs`` has ``doc_id`` and ``text`` and ``labels`` has ``doc_id`` and ``toxic``; other
    columns are not read. A null text scores like an empty one, a very long one is scored whole;
    a null ``doc_id`` is in no fold. Of labels that clash the greatest counts. Repeated rows stay
    repeated. No rows give no rows.
    """
    model = train(docs, labels, folds=folds, held_out=held_out, sample_rows=sample_rows)
    featured = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), model.dense(text_of()).alias("features")
    )
    return model.raw(featured).select(
        "doc_id",
        in_fold(F.col("doc_id"), folds, held_out).alias("held_out"),
        model.calibrated(F.col("raw")).alias("score"),
    ).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
