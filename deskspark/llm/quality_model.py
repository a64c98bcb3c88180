"""Quality classifier: ridge regression on random Fourier features, calibrated by isotonic regression.

Statistics of a text (STATISTICS) are standardised and mapped by z(x) = sqrt(2/D) cos(Wx + b), whose
inner products approximate a Gaussian kernel. Every partition adds up its share of Z'Z and Z'y; the
sums are added in Spark, so what reaches the driver depends on D alone. Raw scores of a quarter of
the labelled rows, kept from the fit and counted in bins, are calibrated by pooling adjacent
violators.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deskspark.llm.common import checkpoint, giving_back

FEATURES, BANDWIDTH, RIDGE, SEED = 192, 3.0, 1e-3, 20
#: Raw scores are counted in bins of this width between these bounds before calibration.
BIN, LOW, HIGH = 0.002, -1.0, 2.0
CALIBRATION_PART = 4
STATISTICS = (
    "bytes", "words", "word_bytes", "upper", "digits", "symbols", "shouts", "stops", "commas", "non_ascii",
    "newlines", "distinct_words", "same_as_before", "distinct_lines",
)


def statistics(text: str | None) -> list[float]:
    """The statistics of one whole text; those of an empty one if it is None."""
    raw = (text or "").encode("utf-8", "replace")
    n = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    words, lines = raw.split(), raw.split(b"\n")
    size, count = max(1, len(raw)), max(1, len(words))
    letters = max(1, int(n[65:91].sum() + n[97:123].sum()))
    same = sum(map(bytes.__eq__, words[1:], words))
    return [
        np.log1p(len(raw)), np.log1p(len(words)), sum(map(len, words)) / count, n[65:91].sum() / letters,
        n[48:58].sum() / size, n[[35, 36, 37, 38, 42, 60, 62, 124, 64, 94, 95, 126]].sum() / size, n[33] / size,
        (n[46] + n[63]) / count, n[44] / count, n[128:].sum() / size, n[10] / count,
        len(set(words)) / count, same / count, len(set(lines)) / len(lines),
    ]


def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            rows = np.array([statistics(t) for t in batch.column("text").to_pylist()])
            columns = [batch.column("doc_id"), *(pa.array(rows[:, i], pa.float64()) for i in range(rows.shape[1]))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", *STATISTICS])


@dataclasses.dataclass
class QualityModel:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    offsets: np.ndarray
    ridge: np.ndarray
    at: np.ndarray
    calibrated: np.ndarray

    def features(self, rows: np.ndarray) -> np.ndarray:
        x = np.clip((rows - self.mean) / self.scale, -6, 6)
        z = np.sqrt(2 / len(self.offsets)) * np.cos(x @ self.weights + self.offsets)
        return np.hstack([np.ones((len(x), 1)), z])

    def raw(self, rows: np.ndarray) -> np.ndarray:
        return np.clip(self.features(rows) @ self.ridge, LOW, HIGH)

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Between 0 and 1, and rising with the raw score also where calibration is flat."""
        raw = self.raw(rows)
        return 0.98 * np.interp(raw, self.at, self.calibrated) + 0.02 * (raw - LOW) / (HIGH - LOW)


def isotonic(values: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The rising sequence nearest to `values`: adjacent violators are pooled."""
    blocks: list[list[float]] = []
    for v, w in zip(values, weights):
        blocks.append([v, w, 1])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            b, a = blocks.pop(), blocks.pop()
            blocks.append([(a[0] * a[1] + b[0] * b[1]) / (a[1] + b[1]), a[1] + b[1], a[2] + b[2]])
    return np.repeat([b[0] for b in blocks], [int(b[2]) for b in blocks])


def partial_sums(model: QualityModel):
    """A function from rows to the upper triangle of Z'Z, and Z'y in the column after the last."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = len(model.offsets) + 1
        total = np.zeros((width, width + 1))
        for batch in batches:
            if batch.num_rows:
                rows = np.column_stack([batch.column(c).to_numpy(zero_copy_only=False) for c in STATISTICS])
                z = model.features(rows)
                y = batch.column("y").to_numpy(zero_copy_only=False)
                total += z.T @ np.column_stack([z, y])
        i, j = np.nonzero(np.triu(np.ones_like(total)))
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total[i, j])], names=["i", "j", "v"])

    return add


def fit(docs: DataFrame, labels: DataFrame, features: int = FEATURES) -> QualityModel | None:
    """A model of `labels` (doc_id, quality) from the texts of `docs`, or None without labelled rows.

    Ids are not inputs: they join the two tables and part the labelled rows. A NULL quality or id is
    no label; several labels of an id count as their mean. All labelled rows are used.
    """
    marks = (labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id")
             .agg(F.avg(F.col("quality").cast("double")).alias("y")))
    fields = ", ".join(f"{c} double" for c in STATISTICS)
    rows = docs.select("doc_id", "text").mapInArrow(giving_back(measured), f"doc_id long, {fields}")
    known = checkpoint(rows.join(marks, "doc_id"))
    moments = known.agg(F.count("*").alias("n"), *(f(c).alias(f"{f.__name__}_{c}") for c in STATISTICS for f in (F.avg, F.stddev_pop))).first()
    if not moments.n:
        return None
    random = np.random.default_rng(SEED)
    mean, scale = (np.array([moments[f"{f}_{c}"] for c in STATISTICS]) for f in ("avg", "stddev_pop"))
    model = QualityModel(
        mean, np.where(scale > 1e-9, scale, 1.0), random.normal(0, 1 / BANDWIDTH, (len(STATISTICS), features)),
        random.uniform(0, 2 * np.pi, features), np.zeros(features + 1), np.array([LOW, HIGH]), np.zeros(2))
    held = F.pmod(F.xxhash64("doc_id"), F.lit(CALIBRATION_PART)) == 0

    sums = known.filter(~held).mapInArrow(partial_sums(model), "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v"))
    table = np.zeros((features + 1, features + 2))
    for r in sums.collect():  # (features + 1)(features + 4) / 2 rows, however many documents
        table[r.i, r.j] = r.v
    gram, moment = table[:, :-1], table[:, -1]
    gram = gram + np.triu(gram, 1).T
    model.ridge = np.linalg.solve(gram + RIDGE * max(1.0, gram[0, 0]) * np.eye(len(gram)), moment)

    @F.pandas_udf("int")
    def bin_of(*columns: pd.Series) -> pd.Series:
        return pd.Series(np.floor((model.raw(np.column_stack(columns)) - LOW) / BIN).astype("int32"))

    bins = known.filter(held).select(bin_of(*STATISTICS).alias("bin"), "y").groupBy("bin").agg(F.avg("y").alias("y"), F.count("*").alias("n"))
    found = sorted((r.bin, r.y, r.n) for r in bins.collect())  # at most (HIGH - LOW) / BIN + 1 rows
    if found:
        at, y, n = (np.array(x, float) for x in zip(*found))
        model.at, model.calibrated = LOW + (at + 0.5) * BIN, np.clip(isotonic(y, n), 0, 1)
    else:
        model.at, model.calibrated = np.array([0.0, 1.0]), np.array([0.0, 1.0])
    return model


def score_of(text: Column, model: QualityModel | None) -> Column:
    """The score of a text; 0.5 for all without a model."""
    if model is None:
        return F.lit(0.5)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(model.score(np.array([statistics(t) for t in texts])) if len(texts) else [], dtype=float)

    return score(text)


def score_documents(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """`docs` with score and predicted (1 from `threshold` on).

    NULL and empty texts get the score of an empty text; repeated rows get equal scores; columns
    of the input with these names are replaced; an empty table gives an empty result.
    """
    score = score_of(F.col("text"), fit(docs, labels))
    return docs.drop("score", "predicted").withColumn("score", score).withColumn(
        "predicted", (F.col("score") >= threshold).cast("int"))
