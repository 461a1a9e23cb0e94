"""Toxicity by cumulative-link ordinal regression on words.

Severity grades are ordered. One weight per word is shared by all thresholds: P(grade <= j) is the logistic function of
threshold j less the weighted sum of the words present. The expected severity is the mean of the grade's distribution.

The model is fitted on a sample of labelled documents of bounded expected size (`SAMPLE`), chosen by a hash of the id, on
at most `FEATURES` words and word beginnings, chosen by their chi-square with a positive grade. Everything labelled below that bound takes part.
Scoring runs over all documents and whole texts.

Grades from the labels: 0 without toxicity, 1 toxic, 2 toxic and of low quality.

Defined results: a null text counts as empty and has no words; labels without toxicity value are left out, a null quality
counts as good; of several labels of an id the gravest counts; without labels, or with one grade only, no word weighs and
the grades' smoothed shares are all there is; every document gives one row, repeated ones too; an empty table gives an
empty result. Other columns of the input are not read, whatever their names.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.llm.common import bounded, text_of

GRADES = 3
SAMPLE = 8_000
FEATURES = 512
#: Documents of the sample a word must occur in.
LEAST_DOCUMENTS = 4
RIDGE = 2e-4
STEPS = 400
TOXIC_FROM = 0.5


@dataclass(frozen=True)
class Model:
    words: list[str]
    weights: list[float]
    thresholds: list[float]


#: Beside whole words, their beginnings of these lengths are features, so that inflected and compound forms share weight.
STEMS = (5, 7)


def words_of(text: Column) -> Column:
    """Distinct words (runs of letters and digits, lower case) and, starred, their beginnings."""
    words = F.array_distinct(F.split(F.lower(text), r"[^\p{L}\p{N}]+"))
    stems = lambda w, n: F.transform(w, lambda x: F.concat(F.substring(x, 1, n), F.lit("*")))
    bound = F.transform(F.array(words), lambda w: F.concat(w, *[stems(w, n) for n in STEMS]))  # splits the text once
    return F.array_distinct(F.flatten(bound))


def grades(labels: DataFrame) -> DataFrame:
    """label_id, grade of every labelled document."""
    grade = F.when(F.col("toxic") == 0, 0).when(F.coalesce("quality", F.lit(1)) == 0, 2).otherwise(1)
    return labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy(F.col("doc_id").alias("label_id")).agg(F.max(grade).alias("grade"))


def _logistic(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1.0 + np.tanh(0.5 * x))


def probabilities(scores: np.ndarray, thresholds: np.ndarray) -> np.ndarray:
    """Of each grade, one row per score."""
    below = _logistic(thresholds[None, :] - scores[:, None])
    return np.diff(np.hstack([np.zeros((len(scores), 1)), below, np.ones((len(scores), 1))]), axis=1)


def chosen_words(documents: list[list[str]], positive: np.ndarray, most: int, least: int) -> list[str]:
    """The words with the largest chi-square between presence and a positive grade; ties by the word."""
    found: dict[str, list[int]] = {}
    for words, is_positive in zip(documents, positive.tolist()):
        for word in words:
            found.setdefault(word, [0, 0])[is_positive] += 1
    n, p = len(positive), int(positive.sum())
    if not 0 < p < n:
        return []
    ranked = []
    for word, (without, having) in found.items():
        total = without + having
        if word and total >= least and total < n:
            gap = having * n - total * p
            ranked.append((-(gap * gap) / (total * (n - total)), word))
    return [word for _, word in sorted(ranked)[:most]]


def fit(documents: list[list[str]], grade: np.ndarray, grades: int = GRADES, features: int = FEATURES, least: int = LEAST_DOCUMENTS) -> Model:
    """Maximum likelihood with a ridge, by Adam over the whole sample. Thresholds stay ordered: the first and log gaps are fitted."""
    shares = (np.bincount(grade, minlength=grades) + 0.5) / (len(grade) + 0.5 * grades)
    cumulative = np.cumsum(shares)[:-1]
    thresholds = np.log(cumulative / (1 - cumulative))
    words = chosen_words(documents, grade > 0, features, least)
    if not words:
        return Model([], [], thresholds.tolist())
    place = {word: i for i, word in enumerate(words)}
    present = [[place[w] for w in words_ if w in place] for words_ in documents]
    x = np.zeros((len(documents), len(words)), dtype=np.float64)
    for row, columns in enumerate(present):
        x[row, columns] = 1.0
    raw = np.concatenate([np.zeros(len(words)), thresholds[:1], np.log(np.maximum(np.diff(thresholds), 1e-3))])
    mean, square = np.zeros_like(raw), np.zeros_like(raw)
    d, n = len(words), len(grade)
    for step in range(1, STEPS + 1):
        theta = raw[d] + np.concatenate([[0.0], np.cumsum(np.exp(raw[d + 1 :]))])
        bounds = np.concatenate([[-np.inf], theta, [np.inf]])
        s = x @ raw[:d]
        upper, lower = _logistic(bounds[grade + 1] - s), _logistic(bounds[grade] - s)
        p = np.maximum(upper - lower, 1e-12)
        up, low = upper * (1 - upper) / p, lower * (1 - lower) / p
        by_theta = np.array([(up[grade == j].sum() - low[grade == j + 1].sum()) / n for j in range(grades - 1)])
        gaps = np.exp(raw[d + 1 :]) * np.cumsum(by_theta[::-1])[::-1][1:]
        slope = np.concatenate([x.T @ (low - up) / n - RIDGE * raw[:d], [by_theta.sum()], gaps])
        mean, square = 0.9 * mean + 0.1 * slope, 0.999 * square + 0.001 * slope * slope
        raw = raw + 0.05 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    theta = raw[d] + np.concatenate([[0.0], np.cumsum(np.exp(raw[d + 1 :]))])
    return Model(words, raw[:d].tolist(), theta.tolist())


def fitted(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """The sample's words go to one task, which is bounded by the sample; the model comes back as one row."""
    graded = grades(labels)
    labelled = max(graded.count(), 1)
    share = min(1.0, sample / labelled)
    taken = bounded(graded.where(F.pmod(F.xxhash64(F.lit("sample"), "label_id"), F.lit(1 << 20)) < int(share * (1 << 20))))
    rows = (
        documents.select("doc_id", text_of().alias("t"))
        .join(taken, F.col("doc_id") == F.col("label_id"))
        .select("doc_id", "grade", words_of(F.col("t")).alias("words"))
        .repartition(1)
    )

    def run(batches):
        found = []
        for batch in batches:
            found += zip(batch.column("doc_id").to_pylist(), batch.column("grade").to_pylist(), batch.column("words").to_pylist())
        found.sort(key=lambda row: row[:2])
        model = fit([row[2] for row in found], np.array([row[1] for row in found], dtype=np.int64))
        yield pa.RecordBatch.from_pydict({"model": [json.dumps(model.__dict__)]})

    got = rows.mapInArrow(run, "model string").collect()
    return Model(**json.loads(got[0]["model"])) if got else fit_nothing()


def fit_nothing() -> Model:
    return fit([], np.zeros(0, dtype=np.int64))


def scored(documents: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """`keep`, severity (the likeliest grade), expected_severity, p_toxic, toxic of every document."""
    known = F.array(*[F.lit(word) for word in model.words]) if model.words else F.array().cast("array<string>")
    weights, thresholds = dict(zip(model.words, model.weights)), np.array(model.thresholds)

    def run(batches):
        for batch in batches:
            scores = np.array([sum(map(weights.__getitem__, words)) for words in batch.column("present").to_pylist()], dtype=np.float64)
            p = probabilities(scores, thresholds)
            toxic = 1.0 - p[:, 0]
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(i) for i in range(len(keep))],
                    pa.array(p.argmax(axis=1).astype(np.int64)),
                    pa.array(p @ np.arange(p.shape[1])),
                    pa.array(toxic),
                    pa.array(toxic >= TOXIC_FROM),
                ],
                names=names,
            )

    rows = documents.select(*keep, F.array_intersect(known, words_of(text_of())).alias("present"))
    kinds = [f.dataType.simpleString() for f in rows.schema.fields[:-1]]
    names = [*keep, "severity", "expected_severity", "p_toxic", "toxic"]
    schema = ", ".join(f"`{k}` {kind}" for k, kind in zip(keep, kinds)) + ", severity bigint, expected_severity double, p_toxic double, toxic boolean"
    return rows.mapInArrow(run, schema)
