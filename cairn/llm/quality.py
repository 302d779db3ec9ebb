"""Quality scores: quadratic discriminant analysis with shrinkage covariances.

Each text becomes a vector of transformed statistics (logarithms of lengths and
of rates).  Each class has a mean and a covariance, shrunk towards its diagonal
and kept positive definite; their Cholesky factors are computed once.  The score
is the logistic of the Mahalanobis log-density difference, whose slope and offset
are fitted on the learning rows.

Learning reads at most `sample` labelled rows, those whose ids hash lowest, never
a row held out; labels, ids, languages and sources are no inputs.  Null texts
count as empty and are scored like any text.  Every text is read whole.  With no
labelled rows of both classes every score is 0.5.
"""
from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, released, slices, text_bytes, text_or_empty, worker_state
from .toxicity import CAPITALS, CHUNK, CRIES, DIGITS, LETTERS, MARKS, SYMBOLS, byte_counts, labelled_sample

SAMPLE, CUT, SHRINK, RIDGE = 20_000, 0.3, 0.1, 1e-2


def statistics(texts: list[str], data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Transformed statistics, a row for each text."""
    n = len(texts)
    out = np.zeros((n, 14))
    size = np.maximum(1, offsets[1:] - offsets[:-1])
    letters = byte_counts(data, offsets, LETTERS)
    rate = lambda x, over, floor: np.log((x + floor) / (over + 2 * floor))
    out[:, 0] = np.log1p(offsets[1:] - offsets[:-1])
    out[:, 1] = rate(byte_counts(data, offsets, CAPITALS), letters, 1)
    for col, table in ((2, CRIES), (3, MARKS), (4, DIGITS), (5, SYMBOLS)):
        out[:, col] = rate(byte_counts(data, offsets, table), size, 1)
    for i, text in enumerate(texts):
        words = text.split()
        lines = [x for x in text.split("\n") if x]
        row, k = out[i], max(1, len(words))
        counts = Counter(words)
        top = counts.most_common(1)[0][1] if words else 0
        chars = sum(map(len, words))
        row[6] = np.log((chars + 5) / (k + 1))
        row[7] = np.log((len(counts) + 1) / (k + 1))
        row[8] = np.log((top + 1) / (k + 2))
        row[9] = np.log((len(set(lines)) + 1) / (len(lines) + 1))
        row[10] = np.log((k + 5) / (len(lines) + 1))
        row[11] = np.log((sum(n for w, n in counts.items() if not w[-1].isalnum()) + 1) / (k + 2))
        row[12] = np.log((sum(n for w, n in counts.items() if len(w) <= 2) + 1) / (k + 2))
        row[13] = np.log((sum(n for w, n in counts.items() if w.isupper()) + 1) / (k + 2))
    return out


@dataclass
class Discriminant:
    """Cached Cholesky factors (inverse), means and log terms of both classes."""

    centre: np.ndarray
    scale: np.ndarray
    means: list
    inverse: list
    logs: list
    slope: float = 1.0
    offset: float = 0.0

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray) -> Discriminant:
        centre, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-3)
        z = (x - centre) / scale
        means, inverse, logs = [], [], []
        for k in (0, 1):
            own = z[y == k]
            mean = own.mean(axis=0)
            cov = (own - mean).T @ (own - mean) / max(1, len(own) - 1)
            weight = max(SHRINK, min(1.0, z.shape[1] / max(1, len(own))))
            cov = (1 - weight) * cov + weight * np.diag(np.diag(cov)) + RIDGE * np.eye(len(cov))
            factor = np.linalg.cholesky(cov)
            means.append(mean)
            inverse.append(np.linalg.inv(factor))
            logs.append(-np.log(np.diag(factor)).sum() + np.log(len(own) / len(z)))
        out = cls(centre, scale, means, inverse, logs)
        d = out.difference(x)
        # slope and offset by Newton steps on the squashed difference
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(out.slope * d + out.offset, -35, 35)))
            w = np.maximum(p * (1 - p), 1e-6)
            g = np.array([((y - p) * d).sum() - 1e-2 * (out.slope - 1), (y - p).sum() - 1e-2 * out.offset])
            h = np.array([[(w * d * d).sum() + 1e-2, (w * d).sum()], [(w * d).sum(), w.sum() + 1e-2]])
            step = np.linalg.solve(h, g)
            step *= min(1.0, 0.5 / np.abs(step).max())
            out.slope, out.offset = max(1e-3, out.slope + step[0]), out.offset + step[1]
            if np.abs(step).max() < 1e-8:
                break
        return out

    def difference(self, x: np.ndarray) -> np.ndarray:
        """Squashed log-density difference, class 1 less class 0."""
        z = (x - self.centre) / self.scale
        side = [log - 0.5 * (((z - m) @ inv.T) ** 2).sum(axis=1) for m, inv, log in zip(self.means, self.inverse, self.logs, strict=True)]
        d = side[1] - side[0]
        return np.sign(d) * np.log1p(np.abs(d))

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.difference(x) + self.offset, -35, 35)))


def _measured(batches: Iterator) -> Iterator:
    import pyarrow as pa

    for batch in batches:
        data, offsets = text_bytes(batch.column("text"))
        for a, b in slices(offsets, CHUNK):
            part = batch.slice(a, b - a)
            x = statistics(part.column("text").to_pylist(), data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
            yield pa.RecordBatch.from_arrays([part.column("id"), part.column("y"), pa.array(list(x), pa.list_(pa.float64()))], ["id", "y", "x"])


def fit(docs: DataFrame, labels: DataFrame, learn: Column, sample: int = SAMPLE) -> Discriminant | None:
    bound_batches(docs.sparkSession)
    rows = labelled_sample(docs, labels, "quality", learn, sample)
    table = rows.mapInArrow(released(_measured), f"id {dict(rows.dtypes)['id']}, y int, x array<double>").orderBy("id", "x").collect()
    y = np.array([r["y"] for r in table], dtype=float)
    if min((y == 0).sum(), (y == 1).sum()) < 2:
        return None
    return Discriminant.fit(np.array([r["x"] for r in table]), y)


def score_column(model: Discriminant | None, text: Column) -> Column:
    @F.arrow_udf("double")
    def score(texts):
        import pyarrow as pa

        worker_state().clear()  # what other operators left in the worker
        if model is None:
            return pa.array(np.full(len(texts), 0.5))
        data, offsets = text_bytes(texts)
        out = [model.score(statistics(texts.slice(a, b - a).to_pylist(), data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])) for a, b in slices(offsets, CHUNK)]
        return pa.array(np.concatenate(out) if out else np.zeros(0))

    return score(text)


def op6_quality(spark, sf_dir: str) -> DataFrame:
    """Score of every document; rows with crc32(id) mod 5 = 0 are never learned from."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    fifth = F.crc32(F.col("id").cast("string").cast("binary")) % 5
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), fifth != 0)
    scored = docs.select("doc_id", score_column(model, text_or_empty()).alias("score"))
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))
