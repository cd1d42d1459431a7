"""Operator 7, a quality classifier by positive-unlabelled learning.

Trusted positives are rows labelled good, the unlabelled sample is all web text; labels that are not good are not looked at.
The class prior is estimated from both, on the scores of a draft. With the logistic loss the unbiased risk
of a linear score g is  -prior * mean_P(g) + mean_U(log(1 + exp(g))) : the positives enter by one mean vector, and every
Newton step is one aggregation over the features of all rows. The part of the risk that stands for negatives,
mean_U(log(1 + exp(g))) - prior * mean_P(log(1 + exp(g))), must not fall below zero: a step that takes it there is halved
until it does not.
"""

from __future__ import annotations

import math
import operator
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barpath.llm.common import batches, crc32_mod, small_batches, table
from barpath.session import materialise

THRESHOLD = 0.7
FOLDS, HELD_OUT = 4, 2
STEPS = 15
RIDGE = 1e-4
#: The clamp of a standardised feature: long tails do not decide a score.
CLAMP = 6.0

_UPPER, _DIGIT = np.zeros(256), np.zeros(256)
_UPPER[65:91] = 1
_DIGIT[48:58] = 1
_LETTER = np.array([float(65 <= b <= 90 or 97 <= b <= 122 or b >= 128) for b in range(256)])
_SPACE = np.array([float(b == 32 or 9 <= b <= 13) for b in range(256)])
_PLAIN = np.array([float(chr(b) in ".,;:'-()\"?") for b in range(256)])
FEATURES = (
    "log_words", "word_length", "upper", "digits", "plain_marks", "other_marks", "bars", "shouts", "marked_words",
    "same_as_last", "distinct", "commonest", "lines", "short_lines", "same_lines", "ended_lines",
)


def features(text: str | None) -> list[float]:
    """Numbers that describe a whole text, in the order of FEATURES; shares enter by their square root."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    words, lines = raw.split(), [x for x in raw.split(b"\n") if x.strip()]
    n, m = max(1, len(words)), max(1, len(lines))
    letters, seen = max(1.0, float(counts @ _LETTER)), max(1.0, float(counts @ (1 - _SPACE)))
    common: dict[bytes, int] = {}
    for w in words:
        common[w] = common.get(w, 0) + 1
    plain, marks = float(counts @ _PLAIN), float(counts @ (1 - _LETTER - _DIGIT - _SPACE))
    shares = [
        float(counts @ _UPPER) / letters, float(counts @ _DIGIT) / seen, plain / seen, (marks - plain) / seen, counts[124] / n, counts[33] / n,
        sum(w[-1] in b"!#$%&*" for w in words) / n, sum(map(operator.eq, words, words[1:])) / n, len(common) / n, max(common.values(), default=0) / n,
    ]
    by_line = [sum(len(x) < 40 for x in lines) / m, 1 - len(set(lines)) / m, sum(x.rstrip()[-1] in b".!?" for x in lines) / m]
    return [math.log1p(len(words)), math.sqrt(seen / n), *map(math.sqrt, shares), math.log1p(len(lines)), *map(math.sqrt, by_line)]


def with_features(docs: DataFrame, text: str = "text") -> DataFrame:
    """All columns but the text, and ``__x`` (array of float)."""
    small_batches(docs.sparkSession)
    keep = [f for f in docs.schema.fields if f.name not in (text, "__x")]
    names = [f.name for f in keep]

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(it):
            x = [features(t) for t in batch.column(text).to_pylist()]
            yield pa.RecordBatch.from_pydict({n: batch.column(n) for n in names} | {"__x": pa.array(x, pa.list_(pa.float32()))})

    return docs.select(*names, text).mapInArrow(run, T.StructType([*keep, T.StructField("__x", T.ArrayType(T.FloatType()))]))


class Model:
    """A linear score over standardised features; the last weight is the constant."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, weights: np.ndarray, prior: float):
        self.mean, self.scale, self.weights, self.prior = mean, scale, weights, prior

    def design(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -CLAMP, CLAMP)
        return np.column_stack([z, np.ones(len(z))])

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.design(x) @ self.weights, -500, 500)))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _sums(sample: DataFrame, numbers) -> np.ndarray:
    """The sum over all tasks of ``numbers(unlabelled matrix, positive matrix)`` (a vector): one job, partial sums of tasks."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0
        for b in batches(it):
            x, good = _matrix(b.column("__x")), b.column("__good").to_numpy(zero_copy_only=False)
            total = total + numbers(x[~good], x[good])
        if not np.isscalar(total):
            yield pa.RecordBatch.from_pydict({"k": pa.array(range(len(total)), pa.int32()), "v": pa.array(total, pa.float64())})

    got = sample.select("__x", "__good").mapInArrow(run, "k int, v double").groupBy("k").agg(F.sum("v").alias("v")).collect()
    return np.array([r["v"] for r in sorted(got, key=lambda r: r["k"])])


def fit(sample: DataFrame, prior: float, steps: int = STEPS) -> Model:
    """The classifier of least non-negative risk. ``sample`` holds ``__x`` and ``__good``: false for the unlabelled rows, true
    for the positives; all of them count. Without rows of either kind every score is the prior."""
    d = len(FEATURES)
    first = _sums(sample, lambda u, p: np.concatenate([[len(u), len(p)], u.sum(0), (u * u).sum(0)]))
    flat = Model(np.zeros(d), np.ones(d), np.append(np.zeros(d), math.log(max(prior, 1e-6) / max(1 - prior, 1e-6))), prior)
    if not len(first) or not first[0] or not first[1]:
        return flat
    n, n_p, mean = first[0], first[1], first[2 : d + 2] / first[0]
    scale = np.sqrt(np.maximum(first[d + 2 :] / n - mean**2, 0))
    model = Model(mean, np.where(scale > 1e-9, scale, 1.0), flat.weights, prior)
    mean_p = _sums(sample, lambda u, p: model.design(p).sum(0)) / n_p

    def risks(w: np.ndarray) -> tuple[float, float, np.ndarray, np.ndarray]:
        """The risk, its negative part, gradient and Hessian at w, from one pass."""

        def numbers(u: np.ndarray, p: np.ndarray) -> np.ndarray:
            z = model.design(u)
            g = z @ w
            q = 1 / (1 + np.exp(-np.clip(g, -500, 500)))
            return np.concatenate([[np.logaddexp(0, g).sum(), np.logaddexp(0, model.design(p) @ w).sum()], z.T @ q, ((z * (q * (1 - q))[:, None]).T @ z).ravel()])

        got = _sums(sample, numbers)
        u = got[2:] / n
        risk = got[0] / n - prior * mean_p @ w + RIDGE / 2 * w @ w
        return risk, got[0] / n - prior * got[1] / n_p, u[: d + 1] - prior * mean_p + RIDGE * w, u[d + 1 :].reshape(d + 1, d + 1) + RIDGE * np.eye(d + 1)

    w = model.weights
    risk, _, gradient, hessian = risks(w)
    for _ in range(steps):
        direction = np.linalg.solve(hessian, gradient)
        for halved in range(6):
            new = w - direction * 0.5**halved
            got = risks(new)
            if got[0] <= risk + 1e-12 and got[1] >= 0:
                break
        else:
            break
        done = risk - got[0] < 1e-5
        w, (risk, _, gradient, hessian) = new, got
        if done:
            break
    model.weights = w
    return model


def estimated_prior(sample: DataFrame, draft: Model, bins: int = 1000, delta: float = 0.1, gamma: float = 0.01) -> float | None:
    """The share of good rows among the unlabelled, from positives and unlabelled rows alone: of all thresholds on the draft's
    score, the ratio of unlabelled to positive rows above the one whose upper confidence bound is least (best bin estimation).
    None without rows of either kind."""

    def numbers(u: np.ndarray, p: np.ndarray) -> np.ndarray:
        return np.concatenate([np.histogram(draft.score(x), bins, (0, 1))[0][::-1].astype(float) if len(x) else np.zeros(bins) for x in (u, p)])

    got = _sums(sample, numbers)
    if not len(got) or not got[:bins].sum() or not got[bins:].sum():
        return None
    n_u, n_p = got[:bins].sum(), got[bins:].sum()
    u, p = got[:bins].cumsum() / n_u, got[bins:].cumsum() / n_p
    width = (1 + gamma) * (math.sqrt(math.log(4 / delta) / (2 * n_u)) + math.sqrt(math.log(4 / delta) / (2 * n_p)))
    bound = np.where(p > 0, (u + width) / np.maximum(p, 1e-12), np.inf)
    at = int(bound.argmin())
    return float(min(max(u[at] / p[at], 0.01), 0.99))


def _featured(docs: DataFrame, key: str, text: str) -> DataFrame:
    added = ("held_out", "score", "predicted")
    rows = with_features(docs.select(*[c for c in docs.columns if c not in added]), text)
    return materialise(rows.withColumn("held_out", crc32_mod(key, FOLDS) == HELD_OUT), "features")


def _fitted(rows: DataFrame, labels: DataFrame, key: str, quality: str) -> Model:
    known = labels.where(F.col(quality).isin(0, 1) & F.col(key).isNotNull() & (crc32_mod(key, FOLDS) != HELD_OUT))
    good = known.groupBy(key).agg(F.min(quality).alias("__least")).where("__least = 1")
    positives = rows.join(good, key, "left_semi").select("__x", F.lit(True).alias("__good"))
    sample = materialise(rows.where("not held_out").select("__x", F.lit(False).alias("__good")).unionByName(positives), "sample")
    prior = estimated_prior(sample, fit(sample, 0.5))
    return fit(sample, 1.0 if prior is None else prior)


def classify(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", quality: str = "quality") -> DataFrame:
    """All columns but the text, ``held_out``, ``score`` (0 to 1) and ``predicted`` (1 from a score of THRESHOLD).

    Labels count only from rows whose crc32(key as text) mod 4 is not 2, and the model never sees another column than the
    text. A key that is labelled both ways is no trusted positive. The class prior is estimated from the positives and the
    unlabelled rows (``estimated_prior``); without positives it is 1, and every row is kept. Null texts are empty and get a
    score as any other; very long ones are described whole. Every row stays, repeated ones too; rows of a null key are never
    labelled; an empty table gives an empty table. Columns of the names added are replaced.
    """
    rows = _featured(docs, key, text)
    model = _fitted(rows, labels, key, quality)
    names = [c for c in rows.columns if c != "__x"]

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(it):
            score = model.score(_matrix(batch.column("__x")))
            columns = {n: batch.column(n) for n in names}
            yield pa.RecordBatch.from_pydict(columns | {"score": pa.array(score), "predicted": pa.array((score >= THRESHOLD).astype(np.int32))})

    schema = T.StructType([*(f for f in rows.schema.fields if f.name != "__x"), T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    return rows.mapInArrow(run, schema)


def keep_good(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", quality: str = "quality") -> DataFrame:
    """The rows of ``docs`` that ``classify`` predicts good, with their columns. Each text is described again where it is
    kept, so that no text is shuffled and rows that share a key are judged by themselves."""
    model = _fitted(_featured(docs.select(key, text), key, text), labels, key, quality)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(it):
            x = np.array([features(t) for t in batch.column(text).to_pylist()], dtype=np.float32).astype(np.float64)
            yield batch.filter(pa.array(model.score(x) >= THRESHOLD))

    return docs.mapInArrow(run, docs.schema)


def op7_quality(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return classify(docs, table(spark, sf_dir, "labels")).select("doc_id", "held_out", "score", "predicted")
