"""Quality scores learned from preference pairs (Bradley-Terry)."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from halfstar.llm.common import utf8
from halfstar.session import discard, materialise

FEATURES = (
    "log_words word_length upper digit symbol stop_mark bang bar distinct_words distinct_pairs "
    "top_word repeated_next symbol_words caps_words line_length short_lines distinct_lines non_ascii"
).split()
#: Rows of the rarer label that meet the other label in one group, about, and rows of a group at most, about.
GROUP, LARGE_GROUP = 32, 4096
#: Weight of the squared penalty.
RIDGE = 1e-3
#: The decision point of a score.
CUT = 0.7

_PUNCT = np.zeros(256, bool)
_PUNCT[list(b"#$%&*+/<=>@\\^_`{|}~")] = True
_MARKS = np.zeros(256, bool)
_MARKS[list(b".,;:?")] = True
_KINDS = np.zeros((256, 6))
for _b in range(256):
    _KINDS[_b] = (65 <= _b <= 90, 48 <= _b <= 57, _PUNCT[_b], _MARKS[_b], _b == 33, _b >= 128)


def features(text: bytes) -> list[float]:
    """Shape of a whole text; an empty one has all zeros."""
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    size = len(text)
    upper, digit, symbol, mark, bang, high = np.bincount(np.frombuffer(text, np.uint8), minlength=256) @ _KINDS / size
    seen = Counter(words)
    pairs = len(set(zip(words, words[1:]))) / (n - 1) if n > 1 else 1.0
    again = sum(map(bytes.__eq__, words, words[1:])) / n
    lines = text.split(b"\n")
    return [
        math.log1p(n),
        sum(map(len, words)) / n,
        upper,
        digit,
        symbol,
        mark,
        bang,
        text.count(b"|") / n,
        len(seen) / n ** 0.8,
        pairs,
        max(seen.values()) / n,
        again,
        sum(w[-3:] in _TAILS for w in seen) / len(seen),
        sum(map(bytes.isupper, seen)) / len(seen),
        math.log1p(size / len(lines)),
        sum(len(x) < 20 for x in lines) / len(lines),
        len(set(lines)) / len(lines),
        high,
    ]


_TAILS = frozenset(bytes([c]) * 3 for c in b"#$%&*!?-=_~+")


def feature_table(docs: DataFrame, *keep: str) -> DataFrame:
    """``keep`` columns and ``x``, the features of the whole text."""
    source = docs.select(*keep, F.col("text").alias("__text"))
    schema = ", ".join(f"`{c}` {source.schema[c].dataType.simpleString()}" for c in keep)

    def run(batches):
        for batch in batches:
            x = pa.array([features(t) for t in utf8(batch.column("__text"))], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), x], [*keep, "x"])

    return source.mapInArrow(run, f"{schema}, x array<double>")


def pair_sums(z: np.ndarray, good: int, w: np.ndarray) -> np.ndarray:
    """Number, gradient and curvature of the logistic loss over the pairs of a group.

    The first ``good`` rows have label 1; every one of them is preferred to every other row.
    """
    d = z.shape[1]
    total = np.zeros(1 + d + d * d)
    step = max(1, 65_536 // max(good, 1))
    for at in range(good, len(z), step):
        diff = (z[:good, None] - z[None, at : at + step]).reshape(-1, d)
        p = 1 / (1 + np.exp(np.clip(diff @ w, -30, 30)))
        total[0] += len(diff)
        total[1 : 1 + d] += diff.T @ p
        total[1 + d :] += ((diff * (p * (1 - p))[:, None]).T @ diff).ravel()
    return total


def newton(sums: Callable[[np.ndarray], np.ndarray], d: int) -> np.ndarray:
    """Weights of the least penalised loss; ``sums(w)`` adds ``pair_sums`` over all groups."""
    w = np.zeros(d)
    for _ in range(30):  # Newton steps on a convex loss
        total = sums(w)
        n = max(total[0], 1.0)
        gradient = RIDGE * w - total[1 : 1 + d] / n
        if np.abs(gradient).max() < 1e-7:
            break
        w -= np.linalg.solve(total[1 + d :].reshape(d, d) / n + RIDGE * np.eye(d), gradient)
    return w


def fit(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    """``fit_model`` for rows in memory, all of them in one group."""
    mean, scale = x.mean(0), x.std(0)
    scale[scale < 1e-9] = 1.0
    z = np.clip((x - mean) / scale, -8, 8)
    order = np.argsort(-y, kind="stable")
    good = int((y == 1).sum())
    w = newton(lambda w: pair_sums(z[order], good, w), x.shape[1])
    score = np.sort(z @ w)
    k = min(max(len(y) - good, 1), len(score) - 1)
    return _scaled(mean, scale, w, (score[k - 1] + score[k]) / 2, score[k:].mean() - score[:k].mean())


def _scaled(mean: np.ndarray, scale: np.ndarray, w: np.ndarray, cut: float, spread: float) -> tuple[np.ndarray, float]:
    gain = 8 / (spread or 1.0)  # the two sides lie about four units off the cut
    return np.stack([mean, scale, w * gain]), float(cut * gain)


class QualityModel:
    """A fitted score; ``None`` weights (no pair to learn from) accept every text."""

    def __init__(self, weights: np.ndarray | None, cut: float):
        self.weights, self.cut = weights, cut

    def score(self, x: Column) -> Column:
        """Score in 0..1 out of the feature array; the threshold lies at 0.7."""
        if self.weights is None:
            return F.lit(CUT)
        total = weighted(x, *self.weights)
        at_cut = math.log(CUT / (1 - CUT))
        return 1 / (1 + F.exp(-(total - self.cut + at_cut)))


def weighted(x: Column, mean: np.ndarray, scale: np.ndarray, w: np.ndarray) -> Column:
    return sum(
        (
            F.greatest(F.lit(-8.0), F.least(F.lit(8.0), (x[i] - float(mean[i])) / float(scale[i]))) * float(w[i])
            for i in range(len(w))
        ),
        F.lit(0.0),
    )


def ranked(values: DataFrame, place: int) -> float:
    """The value at ``place`` (from 0) of the sorted column ``s``, by counts in ever smaller bins."""
    while True:
        found = values.agg(F.count("s").alias("n"), F.min("s").alias("low"), F.max("s").alias("high")).first()
        if found["n"] <= 2 * BINS or found["low"] == found["high"]:
            break
        width = found["high"] - found["low"]
        bin_of = F.least(F.floor((F.col("s") - found["low"]) / width * BINS), F.lit(BINS - 1))
        for number, n in values.groupBy(bin_of.alias("b")).agg(F.count("*").alias("n")).orderBy("b").collect():
            if place < n:
                break
            place -= n
        values = values.where(bin_of == number)
    if found["low"] == found["high"]:
        return found["low"]
    return values.orderBy("s").collect()[place]["s"]


#: Bins of one round of ``ranked``.
BINS = 1024


def grouped(marked: DataFrame, counts: dict[int, int], mean: np.ndarray, scale: np.ndarray) -> DataFrame:
    """Written groups ``(good, z)`` of scaled rows, those of label 1 first.

    A row lies in the group of its id's hash. Where one label is rare, each of
    its rows lies in as many groups as it takes for every group to hold some.
    """
    rare = min(counts, key=counts.get)
    groups = max(1, ceil(counts[rare] / GROUP), ceil(counts[1 - rare] / LARGE_GROUP))
    copies = min(groups, ceil(GROUP * groups / counts[rare] / 2))
    copy = F.when(F.col("__y") == rare, F.sequence(F.lit(0), F.lit(copies - 1))).otherwise(F.array(F.lit(0)))
    dealt = marked.select("doc_id", "__y", "x", F.explode(copy).alias("__c")).select(
        F.pmod(F.xxhash64("doc_id") + F.col("__c"), F.lit(groups)).alias("g"), "doc_id", F.col("__y").alias("y"), "x"
    )

    def pack(table: pa.Table) -> pa.Table:
        table = table.sort_by([("y", "descending"), ("doc_id", "ascending")])
        x = np.array(table.column("x").to_pylist(), float)
        z = np.clip((x - mean) / scale, -8, 8)
        good = int(np.count_nonzero(table.column("y").to_numpy() == 1))
        return pa.table({"good": pa.array([good], pa.int32()), "z": pa.array([z.tobytes()], pa.binary())})

    return materialise(dealt.groupBy("g").applyInArrow(pack, "good int, z binary"), "quality-groups")


def fit_model(table: DataFrame, labels: DataFrame) -> QualityModel:
    """Fit on all rows of ``table(doc_id, x)`` that ``labels(doc_id, quality)`` marks.

    Only labels 0 and 1 count; an id marked both ways counts as 0. A pair is a
    row of label 1 and one of label 0 of the same group, the loss the logistic
    loss of the difference of their scores; every row takes part in all pairs
    of its group. The threshold is the quantile of all scores below which the
    share of label 0 lies, midway to the next score.
    """
    d = len(FEATURES)
    marks = (
        labels.filter("quality in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("__y"))
    )
    marked = materialise(table.join(marks, "doc_id"), "quality-labelled")
    counts = {r["__y"]: r["n"] for r in marked.groupBy("__y").agg(F.count("*").alias("n")).collect()}
    if len(counts) < 2:
        return QualityModel(None, 0.0)
    moments = marked.agg(*[f(F.col("x")[i]) for f in (F.avg, F.stddev_pop) for i in range(d)]).first()
    mean, scale = np.round(np.array(moments, float).reshape(2, d), 12)
    scale[scale < 1e-9] = 1.0
    groups = grouped(marked, counts, mean, scale)

    def sums(w: np.ndarray) -> np.ndarray:
        def run(batches):
            total = np.zeros(1 + d + d * d)
            for batch in batches:
                for good, z in zip(batch.column("good").to_pylist(), batch.column("z").to_pylist()):
                    total += pair_sums(np.frombuffer(z, np.float64).reshape(-1, d), good, w)
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array(total)], ["at", "v"])

        added = groups.mapInArrow(run, "at int, v double").groupBy("at").agg(F.sum("v").alias("v"))
        return np.array([r["v"] for r in added.orderBy("at").collect()])

    w = np.round(newton(sums, d), 9)  # the order of the sums leaves the last digits open
    scores = materialise(marked.select(weighted(F.col("x"), mean, scale, w).alias("s")), "quality-scores")
    n = sum(counts.values())
    k = min(max(counts[0], 1), n - 1)
    below, above = ranked(scores, k - 1), ranked(scores, k)
    under = F.col("s") < below
    s = scores.agg(F.sum("s").alias("all"), F.count_if(under).alias("n"), F.coalesce(F.sum(F.when(under, F.col("s"))), F.lit(0.0)).alias("low")).first()
    low = s["low"] + (k - s["n"]) * below
    weights, cut = _scaled(mean, scale, w, (below + above) / 2, round((s["all"] - low) / (n - k) - low / k, 9))
    discard(marked, groups, scores)
    return QualityModel(weights, cut)


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def trained(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, QualityModel]:
    """The written feature table ``(doc_id, x)`` of ``docs``, and the model fitted on its labelled rows."""
    table = materialise(feature_table(docs, "doc_id"), "quality-features")
    return table, fit_model(table.filter(~held_out() & F.col("doc_id").isNotNull()), labels)


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` per row of ``docs(doc_id, text)``.

    Labels of rows held out (crc32 of the id, modulo 4, is 2) are never read,
    and only the text enters a score. ``predicted`` is 1 from 0.7, which is
    where the learned score quantile lies. Empty and null texts are scored by
    their zero features. Where either label is missing there is nothing to
    learn: every row gets 0.7 and is kept. Null ids are scored, not learned from.
    """
    table, model = trained(docs, labels)
    score = model.score(F.col("x"))
    return table.select(
        "doc_id", held_out().alias("held_out"), score.alias("score"), (score >= CUT).cast("int").alias("predicted")
    )


def keep_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that ``quality_scores`` predicts 1 for, with all their columns.

    Texts are read a second time rather than written beside their features.
    """
    _, model = trained(docs, labels)
    names = [f"c{i}" for i in range(len(docs.columns))]
    inner = docs.select(*(F.col(c).alias(n) for c, n in zip(docs.columns, names)), "text")
    kept = feature_table(inner, *names).filter(model.score(F.col("x")) >= CUT)
    return kept.select(*(F.col(n).alias(c) for c, n in zip(docs.columns, names)))
