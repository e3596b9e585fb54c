"""Operator 3: toxicity by gradient-boosted trees over dense features, calibrated isotonically."""

from __future__ import annotations

import re

import numpy as np
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockwatch.llm.labelled import FEATURES, SAMPLE_ROWS, fold, labelled_ids, with_features
from dockwatch.llm.shared import Scratch

FOLDS, HELD_OUT = 5, 0
LEXICON_STEMS = 200
#: Log odds from which a stem counts as strong.
STRONG = 3.0
#: Lengths of the word beginnings a lexicon is learnt from: inflected and compound forms share them.
STEM_LENGTHS = range(4, 11)
#: Second-person words of the four languages.
SECOND_PERSON = frozenset(
    "you your yours yourself u ur du dich dir dein deine deiner ihr euch euer tu te toi ton ta tes vous votre vos "
    "tú ti usted ustedes vosotros tus".split())
#: Characters written for letters.
LOOKALIKES = str.maketrans("013457@$!|€", "oieastasile")
EDGES = ".,;:!?\"'()[]{}<>*#%&$_-~`|/\\"
_DRAWN = re.compile(r"[^\W\d_]*?([^\W\d_])\1\1[^\W\d_]*")
_DOUBLE = re.compile(r"(.)\1+")
#: Characters in which marks count as one crowd, and over which the nearness of a person fades.
_CROWD, _NEAR = 400, 50


def learn_lexicon(sample: DataFrame, stems: int = LEXICON_STEMS, min_share: float = 0.01,
                  min_docs: int = 3, min_log_odds: float = 1.5) -> list[tuple[str, float]]:
    """Word beginnings that mark the positive class in a bounded sample (text, y): the most frequent ones
    with high log odds against the others, which a weak stem needs more texts to show. One is left out
    where a shorter one tells as much. Returns (stem, log odds)."""
    word = F.explode(F.array_distinct(F.split(F.lower(F.coalesce("text", F.lit(""))), r"[^\p{L}]+"))).alias("w")
    lengths = F.array(*(F.lit(n) for n in STEM_LENGTHS))
    cut = F.transform(F.filter(lengths, lambda n: n <= F.length("w")), lambda n: F.substring(F.col("w"), F.lit(1), n))
    each = sample.select("doc_id", "y", word).select("doc_id", "y", F.explode(cut).alias("w")).distinct()
    n1, n0 = sample.agg(F.count_if(F.col("y") == 1), F.count_if(F.col("y") == 0)).first()
    df = each.groupBy("w").agg(F.count_if(F.col("y") == 1).alias("a"), F.count_if(F.col("y") == 0).alias("b"))
    odds = F.log((F.col("a") + 0.5) / (n1 + 1)) - F.log((F.col("b") + 0.5) / (n0 + 1))
    top = (df.where(F.col("a") >= max(min_docs, min_share * n1)).withColumn("o", odds).where(
        (F.col("o") >= STRONG) | (F.col("o") >= min_log_odds) & (F.col("a") >= max(2 * min_docs, 3 * min_share * n1)))
           .orderBy(F.desc("a"), "w").limit(10 * stems))
    rows = [(r["w"], r["a"], r["o"]) for r in top.collect()]
    kept: dict[str, float] = {}
    for w, _, o in sorted(rows, key=lambda r: (len(r[0]), r[0])):
        if not any(kept.get(w[:n], -1.0) >= o - 0.5 for n in range(1, len(w))):
            kept[w] = o
    return [(w, o) for w, _, o in rows if w in kept][:stems]


class Finder:
    """Where in a lower-case text words begin with a stem of the lexicon or are second-person words."""

    def __init__(self, lexicon: tuple[tuple[str, float], ...]):
        import ahocorasick

        self.auto = ahocorasick.Automaton()
        for w in SECOND_PERSON:
            self.auto.add_word(w, (w, 0.0))
        for w, odds in lexicon:
            self.auto.add_word(w, (w, odds))
        self.auto.make_automaton()

    def __call__(self, low: str) -> tuple[dict[int, float], list[int], float]:
        """Places of marks with the log odds of the strongest stem there, places of second-person words,
        and the sum of the log odds of all different stems."""
        marks, people, stems = {}, [], {}
        for end, (w, odds) in self.auto.iter(low):
            at = end - len(w) + 1
            if at and low[at - 1].isalpha():
                continue
            if odds:
                marks[at] = max(odds, marks.get(at, 0.0))
                stems[w] = odds
            elif end + 1 == len(low) or not low[end + 1].isalpha():
                people.append(at)
        return marks, people, sum(stems.values())


_FINDERS: dict[tuple[tuple[str, float], ...], Finder] = {}


def _finder(lexicon: tuple[tuple[str, float], ...]) -> Finder:
    if lexicon not in _FINDERS:
        _FINDERS.clear()
        _FINDERS[lexicon] = Finder(lexicon)
    return _FINDERS[lexicon]


def _plain(word: str) -> str:
    """A word with look-alikes put back and signs between its letters gone."""
    return "".join(c for c in word.translate(LOOKALIKES) if c.isalpha())


def _disguised(low: str, words: list[str], find: Finder) -> tuple[int, int]:
    """Words that hold other signs than letters, and those among them (or written letter by letter, or with
    letters drawn out) that begin with a stem once made plain."""
    mixed = [w for w in (w.strip(EDGES) for w in words if not w.isalpha()) if w and not w.isalpha()]
    plain = [_plain(w) for w in mixed]
    ones, run = [i for i, w in enumerate(words) if len(w) == 1], []
    if any(b - a == 2 for a, b in zip(ones, ones[2:])):
        for i in [*ones, -9]:
            if run and i != run[-1] + 1:
                if len(run) > 2:
                    plain.append(_plain("".join(words[k] for k in run)))
                run = []
            run.append(i)
    plain += [_DOUBLE.sub(r"\1", m.group()) for m in _DRAWN.finditer(low)]
    return len(mixed), len(find(" ".join(plain))[0]) if plain else 0


def text_features(text: str, find: Finder) -> list[float]:
    low = text.lower()
    words = low.split()
    n, size = max(1, len(words)), max(1, len(text))
    marks, people, odds = find(low)
    mixed, hidden = _disguised(low, words, find)
    near = crowd = 0.0
    if marks:
        m = np.array(sorted(marks))
        crowd = float((np.searchsorted(m, m + _CROWD) - np.arange(len(m))).max())
        if people:
            p = np.array(people)
            at = np.searchsorted(p, m)
            gap = np.minimum(np.abs(p[np.minimum(at, len(p) - 1)] - m), np.abs(p[np.maximum(at - 1, 0)] - m))
            near = float(np.exp(-gap.min() / _NEAR))
    capitals = sum(map(str.isupper, text.split())) / n
    strong = sum(o >= STRONG for o in marks.values())
    return [(len(marks) + hidden) / n, np.log1p(strong), np.log1p(odds), sum(marks.values()) / n, crowd, near, len(people) / n, capitals,
            text.count("!") / size, (text.count("?") + text.count("*") + text.count("#")) / size,
            mixed / n, np.log1p(hidden), np.log1p(n)]


def _features(lexicon: list[tuple[str, float]]):
    key = tuple(lexicon)

    def make(texts):
        find = _finder(key)
        return np.array([text_features(t, find) for t in texts]).reshape(len(texts), 13)

    return make


class ToxicityModel:
    """Lexicon, trees and calibration; without both classes among the training rows, a constant."""

    def __init__(self, lexicon, trees=None, calibration=None, constant=0.0):
        self.lexicon, self.trees, self.calibration, self.constant = lexicon, trees, calibration, constant

    def score(self, docs: DataFrame, keep: list[str]) -> DataFrame:
        """Columns ``keep`` and ``_tox_score`` (0 to 1) of each whole text."""
        if self.trees is None:
            return docs.select(*keep, F.lit(float(self.constant)).alias("_tox_score"))
        x = with_features(docs, "text", _features(self.lexicon), keep)
        x = x.withColumn("_tox_vec", array_to_vector(FEATURES))
        y = self.calibration.transform(_margin(self.trees, x))
        bounded = F.least(F.greatest(F.col("_tox_score"), F.lit(0.0)), F.lit(1.0))
        return y.select(*keep, bounded.alias("_tox_score"))


def _margin(trees, x: DataFrame) -> DataFrame:
    return trees.transform(x).withColumn("_tox_margin", vector_to_array("_tox_raw")[1])


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, trees: int = 20, depth: int = 3,
        seed: int = 42) -> ToxicityModel:
    """Learn from at most ``rows`` labelled documents outside the held-out fold: three quarters of them
    for lexicon and trees, the rest for the calibration."""
    scratch = Scratch(docs.sparkSession, "toxicity")
    ids = scratch.table(labelled_ids(labels, "toxic", FOLDS, HELD_OUT, rows))
    sample = scratch.table(docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").dropDuplicates(["doc_id"])
                           .withColumn("part", F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(4))))
    n1, n0 = sample.agg(F.count_if(F.col("y") == 1), F.count_if(F.col("y") == 0)).first()
    if not n1 or not n0:
        return ToxicityModel([], constant=float(n1 > 0))
    lexicon = learn_lexicon(sample.where("part > 0"))
    x = with_features(sample, "text", _features(lexicon), ["y", "part"])
    x = scratch.table(x).coalesce(6).withColumn("_tox_vec", array_to_vector(FEATURES))
    gbt = GBTClassifier(featuresCol="_tox_vec", labelCol="y", predictionCol="_tox_pred",
                        maxIter=trees, maxDepth=depth, seed=seed)
    gbt.setRawPredictionCol("_tox_raw").setProbabilityCol("_tox_prob")
    model = gbt.fit(x.where("part > 0"))
    iso = IsotonicRegression(featuresCol="_tox_margin", labelCol="y", predictionCol="_tox_score")
    held = x.where("part = 0")
    if len(held.select("y").distinct().take(2)) < 2:  # too few rows to hold any back
        held = x
    return ToxicityModel(lexicon, model, iso.fit(_margin(model, held)))


def held_out() -> Column:
    return F.coalesce(fold("doc_id", FOLDS) == HELD_OUT, F.lit(False))


def score_documents(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, **options) -> DataFrame:
    """doc_id, held_out, score, predicted of every document.

    Null and empty texts are scored as texts without words. Repeated rows are scored alike. A null doc_id
    is never held out. Without labels of both classes the score is the constant 0 or 1 of the one there
    is (0 without any). No documents: no rows. Other columns are ignored.
    """
    s = fit(docs, labels, **options).score(docs, ["doc_id"])
    return s.select("doc_id", held_out().alias("held_out"), F.col("_tox_score").alias("score"),
                    (F.col("_tox_score") >= threshold).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, **options) -> DataFrame:
    """``docs``, all columns, without those that score ``threshold`` or more."""
    whole = docs.select(F.struct("*").alias("row"), "text")  # no column can clash with the operator's
    return fit(docs, labels, **options).score(whole, ["row"]).where(F.col("_tox_score") < threshold).select("row.*")
