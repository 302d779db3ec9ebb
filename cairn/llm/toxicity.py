"""Toxicity scores: gradient-boosted trees over dense features, calibrated by isotonic regression.

Learning reads a bounded sample of labelled rows: at most `sample` of them, those
whose ids hash lowest, never a row that the caller holds out.  From it come, in
turn, a lexicon (words and four-letter word beginnings that mark toxic texts, by
smoothed log odds less 1.5 standard errors; at most `ENTRIES`, those of largest weight), the trees and the calibration.  The
features of a training row use the lexicon of the other half of the sample, and
the calibration uses out-of-fold scores, so neither sees its own labels.

Features: density, count, sum and peak of lexicon weights; the same for a short
list of English insults; closeness of second-person words to hits; rates of
capitals, exclamation and question marks, other punctuation, digits, symbols and
obfuscated words (letters around digits or symbols); length.
Labels, ids, languages and sources are no inputs.

Null texts count as empty.  Every text is read whole.  Empty texts get the score
of a text without any hit.  With no labelled row of both kinds the score falls
back on the insult list alone.
"""
from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, released, slices, text_bytes, text_or_empty, worker_state

SAMPLE, ENTRIES, CUT, CHUNK = 20_000, 3_000, 0.7, 1 << 18
TREES, DEPTH, RATE, BINS, LEAF, FOLDS = 60, 3, 0.2, 32, 5, 3
#: Gradients are whole numbers of this fraction, so that their sums are exact and ties between splits fall alike on every machine.
UNIT = 1 << 24
INSULTS = frozenset("idiot idiots moron morons stupid dumb pathetic disgusting worthless trash scum loser losers clown clowns filth garbage imbecile retard bastard vermin".split())
SECOND = frozenset("you your yours yourself u ur du dich dir dein deine ihr euch tu te toi ton ta vous votre vos tú ti usted ustedes tus vosotros".split())
_WORD = re.compile(r"\w+")
_OBFUSCATED = re.compile(r"[A-Za-z][*@$#!+0-9]+[A-Za-z]")
STEM, NEAR = 4, 5


def _is(chars: str) -> np.ndarray:
    out = np.zeros(256, dtype=np.uint8)
    out[list(chars.encode())] = 1
    return out


CAPITALS = _is("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
LETTERS = _is("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")
CRIES, MARKS, DIGITS, SYMBOLS = _is("!?"), _is(".,;:'\"()-"), _is("0123456789"), _is("*@$#%&^~|<>{}[]\\/+=_")


def byte_counts(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> np.ndarray:
    """For each row, how many of its bytes the table marks."""
    sums = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum(table[data], out=sums[1:])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def tokens(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def dense_features(texts: list[str], data: np.ndarray, offsets: np.ndarray, lexicon: dict[str, float]) -> np.ndarray:
    out = np.zeros((len(texts), 15))
    size = np.maximum(1, offsets[1:] - offsets[:-1])
    letters = np.maximum(1, byte_counts(data, offsets, LETTERS))
    for col, table, over in ((0, CAPITALS, letters), (1, CRIES, size), (2, MARKS, size), (3, DIGITS, size), (4, SYMBOLS, size)):
        out[:, col] = byte_counts(data, offsets, table) / over
    get = lexicon.get
    for i, text in enumerate(texts):
        words = tokens(text)
        n = max(1, len(words))
        row = out[i]
        row[5] = np.log1p(len(words))
        row[6] = len(_OBFUSCATED.findall(text)) / n
        found = {w: max(get(w, 0.0), get(w[:STEM], 0.0)) for w in set(words)}
        hot = {w for w, x in found.items() if x > 0}
        plain = INSULTS.intersection(found)
        if hot or plain:
            weights = [found[w] for w in words if w in hot]
            bad = [k for k, w in enumerate(words) if w in plain]
            row[7], row[8], row[9] = sum(weights), max(weights, default=0), len(weights)
            row[10], row[11] = sum(weights) / n, len(hot)
            row[12], row[13] = len(bad), len(bad) / n
            at = [k for k, w in enumerate(words) if w in hot or w in plain]
            row[14] = sum(any(w in SECOND for w in words[max(0, k - NEAR) : k + NEAR + 1]) for k in at) / len(at)
    return out


@dataclass
class Trees:
    """Depth-limited regression trees in arrays, boosted on the logistic loss."""

    edges: list = field(default_factory=list)
    base: float = 0.0
    trees: list = field(default_factory=list)

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, k], side="right") for k, e in enumerate(self.edges)], axis=1)

    def fit(self, x: np.ndarray, y: np.ndarray) -> Trees:
        self.edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
        self.edges = [np.unique(np.append(e, [c[c > c.min()].min()] if (c > c.min()).any() else [])) for e, c in zip(self.edges, x.T, strict=True)]
        b = self.bins(x)
        p = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        self.base = float(np.log(p / (1 - p)))
        raw = np.full(len(y), self.base)
        for _ in range(TREES):
            p = 1 / (1 + np.exp(-raw))
            grad, hess = np.rint((y - p) * UNIT), np.maximum(np.rint(p * (1 - p) * UNIT), 1.0)
            node = np.zeros(len(y), dtype=np.int64)
            tree = []
            for _ in range(DEPTH):
                level = []
                for k in range(int(node.max()) + 1 if not tree else 2 ** len(tree)):
                    level.append(self._split(b, grad, hess, np.flatnonzero(node == k), UNIT))
                f, t = (np.array(v) for v in zip(*level, strict=True))
                tree.append((f, t))
                node = 2 * node + (b[np.arange(len(y)), f[node]] >= t[node])
            leaves = 2**DEPTH
            g = np.bincount(node, grad, leaves)
            h = np.bincount(node, hess, leaves)
            value = RATE * g / (h + UNIT)
            raw += value[node]
            self.trees.append((tree, value))
        return self

    @staticmethod
    def _split(b: np.ndarray, grad: np.ndarray, hess: np.ndarray, rows: np.ndarray, unit: float = 1.0) -> tuple[int, int]:
        """(feature, bin) of the best split; gradients are multiples of 1 / unit, given times `unit`."""
        best, at = 1e-9 * unit, (0, 1 << 30)
        if len(rows) < 2 * LEAF:
            return at
        g, h = grad[rows], hess[rows]
        whole = g.sum() ** 2 / (h.sum() + unit)
        for f in range(b.shape[1]):
            v = b[rows, f]
            n = int(v.max()) + 1
            cg, ch, cn = (np.cumsum(np.bincount(v, w, n))[:-1] for w in (g, h, None))
            if not len(cg):
                continue
            gain = cg**2 / (ch + unit) + (g.sum() - cg) ** 2 / (h.sum() - ch + unit) - whole
            gain[(cn < LEAF) | (len(rows) - cn < LEAF)] = -1
            k = int(gain.argmax())
            if gain[k] > best:
                best, at = gain[k], (f, k + 1)
        return at

    def raw(self, x: np.ndarray) -> np.ndarray:
        b, rows = self.bins(x), np.arange(len(x))
        out = np.full(len(x), self.base)
        for tree, value in self.trees:
            node = np.zeros(len(x), dtype=np.int64)
            for f, t in tree:
                node = 2 * node + (b[rows, f[node]] >= t[node])
            out += value[node]
        return out


def isotonic(raw: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the monotone fit, by pooling adjacent violators."""
    order = np.argsort(raw, kind="stable")
    blocks: list[list[float]] = []
    for s, v in zip(raw[order], y[order], strict=True):
        blocks.append([float(s), float(v), 1.0])
        while len(blocks) > 1 and blocks[-2][1] >= blocks[-1][1]:
            s2, v2, n2 = blocks.pop()
            s1, v1, n1 = blocks[-1]
            n = n1 + n2
            blocks[-1] = [(s1 * n1 + s2 * n2) / n, (v1 * n1 + v2 * n2) / n, n]
    return np.array([b[0] for b in blocks]), np.array([b[1] for b in blocks])


@dataclass
class Model:
    lexicon: dict[str, float]
    trees: Trees | None
    knots: tuple[np.ndarray, np.ndarray] | None

    def score(self, texts: list[str], data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        x = dense_features(texts, data, offsets, self.lexicon)
        if self.trees is None:
            return x[:, 12] / (1 + x[:, 12])
        raw = self.trees.raw(x)
        level = np.interp(raw, *self.knots)
        return np.clip(0.98 * level + 0.02 / (1 + np.exp(-raw)), 0, 1)  # the calibrated level; ties keep the trees' order


def _count_terms(batches: Iterator) -> Iterator:
    import pyarrow as pa

    counts: dict[tuple[str, int], list[int]] = {}
    for batch in batches:
        for text, toxic, half in zip(*(batch.column(k).to_pylist() for k in ("text", "y", "half")), strict=True):
            words = set(tokens(text))
            for term in words | {w[:STEM] for w in words if len(w) >= STEM}:
                counts.setdefault((term, half), [0, 0])[toxic] += 1
    rows = [(t, h, n[1], n[0]) for (t, h), n in counts.items()]
    for a in range(0, len(rows), 50_000):
        z = list(zip(*rows[a : a + 50_000], strict=True))
        yield pa.RecordBatch.from_arrays([pa.array(z[0], pa.string()), *(pa.array(c, pa.int64()) for c in z[1:])], ["term", "half", "n1", "n0"])


def _lexicon(terms: DataFrame, name: str, n1: int, n0: int) -> dict[str, float]:
    a, b = F.col(f"{name}1"), F.col(f"{name}0")
    odds = F.log((a + 0.5) / (n1 - a + 0.5)) - F.log((b + 0.5) / (n0 - b + 0.5))
    error = F.sqrt(1 / (a + 0.5) + 1 / (n1 - a + 0.5) + 1 / (b + 0.5) + 1 / (n0 - b + 0.5))
    weight = odds - 1.5 * error
    best = terms.where((a >= 3) & (weight > 0.7)).select("term", weight.alias("w")).orderBy(F.desc("w"), "term").limit(ENTRIES)
    return {r["term"]: float(r["w"]) for r in best.collect()}


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, learn: Column, sample: int, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, text, y) of at most `sample` labelled rows, those whose ids hash lowest; `learn` says which ids may be read."""
    chosen = (
        labels.select(F.col(id_column).alias("id"), F.col(label).cast("int").alias("y")).where(F.col("id").isNotNull() & F.col("y").isin(0, 1) & learn)
        .groupBy("id").agg(F.max("y").alias("y")).orderBy(F.xxhash64("id"), "id").limit(sample)
    )
    texts = docs.select(F.col(id_column).alias("id2"), text_or_empty(text).alias("text"))
    return texts.join(F.broadcast(chosen), F.col("id2") == F.col("id")).select("id", "text", "y")  # at most `sample` rows are broadcast


def fit(docs: DataFrame, labels: DataFrame, learn: Column, sample: int = SAMPLE) -> Model:
    bound_batches(docs.sparkSession)
    rows = labelled_sample(docs, labels, "toxic", learn, sample).withColumn("half", F.pmod(F.xxhash64(F.col("id"), F.lit("half")), F.lit(2)).cast("int"))
    rows = rows.persist()
    try:
        sizes = {(r["half"], r["y"]): r["n"] for r in rows.groupBy("half", "y").agg(F.count("*").alias("n")).collect()}
        if any(sum(sizes.get((h, y), 0) for h in (0, 1)) < 4 for y in (0, 1)):
            return Model({}, None, None)
        pick = lambda h, y: F.sum(F.when(F.col("half") == h, F.col(f"n{y}")).otherwise(0))
        terms = rows.mapInArrow(released(_count_terms), "term string, half long, n1 long, n0 long").groupBy("term").agg(
            *(pick(h, y).alias(f"h{h}{y}") for h in (0, 1) for y in (0, 1)), F.sum("n1").alias("all1"), F.sum("n0").alias("all0")
        ).persist()
        lexicons = [_lexicon(terms, f"h{h}", sizes.get((h, 1), 0), sizes.get((h, 0), 0)) for h in (0, 1)]
        full = _lexicon(terms, "all", sum(sizes.get((h, 1), 0) for h in (0, 1)), sum(sizes.get((h, 0), 0) for h in (0, 1)))
        terms.unpersist()

        def featured(batches: Iterator) -> Iterator:
            import pyarrow as pa

            for batch in batches:
                data, offsets = text_bytes(batch.column("text"))
                for a, b in slices(offsets, CHUNK):
                    part = batch.slice(a, b - a)
                    texts, half = part.column("text").to_pylist(), np.array(part.column("half").to_pylist())
                    both = [dense_features(texts, data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], x) for x in lexicons]
                    x = np.where(half[:, None] == 0, both[1], both[0])
                    yield pa.RecordBatch.from_arrays([part.column("id"), part.column("y"), pa.array(list(x), pa.list_(pa.float64()))], ["id", "y", "x"])

        kind = dict(rows.dtypes)["id"]
        table = rows.mapInArrow(released(featured), f"id {kind}, y int, x array<double>").orderBy("id", "x").collect()
    finally:
        rows.unpersist()
    x, y = np.array([r["x"] for r in table]), np.array([r["y"] for r in table], dtype=float)
    fold = np.arange(len(y)) % FOLDS
    raw = np.zeros(len(y))
    for k in range(FOLDS):
        raw[fold == k] = Trees().fit(x[fold != k], y[fold != k]).raw(x[fold == k])
    return Model(full, Trees().fit(x, y), isotonic(raw, y))


def score_column(model: Model, text: Column) -> Column:
    @F.arrow_udf("double")
    def score(texts):
        import pyarrow as pa

        worker_state().clear()  # what other operators left in the worker
        data, offsets = text_bytes(texts)
        out = [model.score(texts.slice(a, b - a).to_pylist(), data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]) for a, b in slices(offsets, CHUNK)]
        return pa.array(np.concatenate(out) if out else np.zeros(0))

    return score(text)


def _third() -> Column:
    return F.crc32(F.col("id").cast("string").cast("binary")) % 3


def op3_toxicity(spark, sf_dir: str) -> DataFrame:
    """Score of every document; rows with crc32(id) mod 3 = 1 are never learned from."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), _third() != 1)
    scored = docs.select("doc_id", score_column(model, text_or_empty()).alias("score"))
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))


def not_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows that score below the cut; columns stay as they are."""
    model = fit(docs, labels, _third() != 1)
    return docs.where(score_column(model, text_or_empty()) < CUT)
