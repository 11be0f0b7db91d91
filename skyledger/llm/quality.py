"""Quality of whole texts: a generalised additive model with pairwise interactions.

Every feature is cut into bins. Shallow trees on one feature at a time are
boosted in turn, round after round, and summed into one lookup table per
feature; then trees on the pairs of features that explain most of what is left,
into one table per pair. A score is a sum of looked-up values.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import coded_words, for_tasks, hash_share, in_rows, sums_by_row, text_slices

FEATURES = (
    "log_chars",
    "log_words",
    "upper_share",
    "digit_share",
    "symbol_share",
    "stop_share",
    "exclaim_share",
    "line_share",
    "mean_word",
    "bare_words",
    "distinct_words",
    "repeated_words",
    "capital_words",
    "non_latin_share",
)
_UPPER, _LOWER, _DIGIT, _SPACE, _LINE, _STOP, _EXCLAIM, _SYMBOL, _FAR = range(9)
_KNOWN = 0x3000


def character_classes() -> np.ndarray:
    table = np.full(_KNOWN + 1, _FAR, np.int8)
    for code in range(_KNOWN):
        kind, char = unicodedata.category(chr(code)), chr(code)
        table[code] = (
            _LINE if char == "\n" else _SPACE if char.isspace() else _STOP if char in ".,;:'\"-" else _EXCLAIM if char in "!?"
            else _DIGIT if kind[0] == "N" else _UPPER if kind == "Lu" else _LOWER if kind[0] in "LM" else _SYMBOL
        )
    return table


def features(texts: pa.Array, classes: np.ndarray) -> np.ndarray:
    """One row of ``FEATURES`` per text; shares of nothing are 0, a null text is empty."""
    texts = pc.fill_null(texts, "")
    n = len(texts)
    chars = pc.utf8_length(texts).to_numpy().astype(np.int64)
    bounds = np.concatenate([[0], np.cumsum(chars)])
    codes = np.frombuffer("".join(texts.to_numpy(zero_copy_only=False).tolist()).encode("utf-32-le", "surrogatepass"), "<u4")
    kind = classes[np.minimum(codes, _KNOWN)]
    row = np.repeat(np.arange(n, dtype=np.int64), chars)
    count = np.bincount(row * 9 + kind, minlength=9 * n).reshape(n, 9)[:, :9].astype(np.float64)
    distinct, words, at = coded_words(texts)
    sizes = np.diff(at)
    owner = np.repeat(np.arange(n, dtype=np.int64), sizes)
    if len(distinct):
        bare = (~pc.match_substring_regex(distinct, r"[\p{L}\p{N}]").to_numpy(zero_copy_only=False))[words]
        capital = pc.match_substring_regex(distinct, r"^\p{Lu}").to_numpy(zero_copy_only=False)[words]
        pairs = np.unique(owner * len(distinct) + words)
        kinds = np.bincount(pairs // len(distinct), minlength=n)
        repeated = np.zeros(len(words), bool)
        repeated[1:] = (words[1:] == words[:-1]) & (owner[1:] == owner[:-1])
    else:
        bare = capital = repeated = np.zeros(0, bool)
        kinds = np.zeros(n)
    over = lambda a, b: a / np.maximum(b, 1)
    letters = count[:, _UPPER] + count[:, _LOWER]
    found = {
        "log_chars": np.log1p(chars),
        "log_words": np.log1p(sizes),
        "upper_share": over(count[:, _UPPER], letters),
        "digit_share": over(count[:, _DIGIT], chars),
        "symbol_share": over(count[:, _SYMBOL], chars),
        "stop_share": over(count[:, _STOP], chars),
        "exclaim_share": over(count[:, _EXCLAIM], chars),
        "line_share": over(count[:, _LINE], chars),
        "mean_word": over(chars - count[:, _SPACE] - count[:, _LINE], sizes),
        "bare_words": over(sums_by_row(bare, at), sizes),
        "distinct_words": over(kinds, sizes),
        "repeated_words": over(sums_by_row(repeated, at), sizes),
        "capital_words": over(sums_by_row(capital, at), sizes),
        "non_latin_share": over(count[:, _FAR], chars),
    }
    return np.stack([found[name] for name in FEATURES], axis=1)


@dataclass(frozen=True)
class QualitySettings:
    """``sample``: about so many documents of each class are learnt from, all of them where there are fewer."""

    sample: int = 4000
    bins: int = 32
    coarse: int = 8
    rounds: int = 200
    pair_rounds: int = 60
    pairs: int = 6
    leaves: int = 4
    rate: float = 0.1
    least: float = 5.0


@dataclass
class QualityModel:
    edges: list[np.ndarray]
    bias: float
    tables: list[np.ndarray]
    pairs: list[tuple[int, int]]
    pair_tables: list[np.ndarray]

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, k], side="right") for k, e in enumerate(self.edges)], axis=1)

    def logits(self, x: np.ndarray) -> np.ndarray:
        b = self.bins(x)
        total = np.full(len(x), self.bias)
        for k, table in enumerate(self.tables):
            total += table[b[:, k]]
        for (i, j), table in zip(self.pairs, self.pair_tables, strict=True):
            total += table[b[:, i], b[:, j]]
        return total

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x), -30, 30)))


def _leaf(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g / (h + 1.0)


def _gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + 1.0)


def shallow_tree(g: np.ndarray, h: np.ndarray, n: np.ndarray, leaves: int, least: float) -> np.ndarray:
    """The value of each bin in a tree of a few leaves, grown by the best cut at a time."""
    cuts = [0, len(g)]
    cg, ch, cn = (np.concatenate([[0.0], np.cumsum(v)]) for v in (g, h, n))
    while len(cuts) <= leaves:
        best = (1e-9, 0)
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            k = np.arange(a + 1, b)
            k = k[(cn[k] - cn[a] >= least) & (cn[b] - cn[k] >= least)]
            if len(k):
                won = _gain(cg[k] - cg[a], ch[k] - ch[a]) + _gain(cg[b] - cg[k], ch[b] - ch[k]) - _gain(cg[b] - cg[a], ch[b] - ch[a])
                best = max(best, (float(won.max()), int(k[won.argmax()])))
        if not best[1]:
            break
        cuts = sorted([*cuts, best[1]])
    values = np.zeros(len(g))
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        values[a:b] = _leaf(cg[b] - cg[a], ch[b] - ch[a])
    return values


def quadrants(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """The best tree that cuts both features of a pair once: its gain and the value of each cell."""
    corner = lambda m: np.pad(m.cumsum(0).cumsum(1), ((1, 0), (1, 0)))
    cg, ch = corner(g), corner(h)
    inner = (slice(1, -1), slice(1, -1))
    parts = []
    for c in (cg, ch):
        low, left, top, whole = c[inner], c[1:-1, -1:], c[-1:, 1:-1], c[-1, -1]
        parts.append((low, left - low, top - low, whole - left - top + low))
    won = sum(_gain(a, b) for a, b in zip(*parts, strict=True)) - _gain(cg[-1, -1], ch[-1, -1])
    if not won.size:
        return 0.0, np.zeros_like(g)
    i, j = np.unravel_index(won.argmax(), won.shape)
    values = np.zeros_like(g)
    for k, (rows, columns) in enumerate(((slice(0, i + 1), slice(0, j + 1)), (slice(0, i + 1), slice(j + 1, None)), (slice(i + 1, None), slice(0, j + 1)), (slice(i + 1, None), slice(j + 1, None)))):
        values[rows, columns] = _leaf(parts[0][k][i, j], parts[1][k][i, j])
    return float(won[i, j]), values


def train(x: np.ndarray, y: np.ndarray, weight: np.ndarray, s: QualitySettings = QualitySettings()) -> QualityModel:
    """Boost tables for the weighted logistic loss; the order of rows does not matter."""
    order = np.lexsort((y, *x.T))
    x, y, weight = x[order], y[order].astype(np.float64), weight[order]
    share = (float(weight @ y) + 0.5) / (float(weight.sum()) + 1.0)
    edges = [np.unique(np.quantile(column, np.linspace(0, 1, s.bins + 1)[1:-1])) for column in x.T] if len(x) else [np.zeros(0)] * x.shape[1]
    model = QualityModel(edges, float(np.log(share / (1 - share))), [np.zeros(len(e) + 1) for e in edges], [], [])
    if not len(x) or y.min() == y.max():
        return model
    b = model.bins(x)
    total = np.full(len(x), model.bias)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return weight * (y - p), weight * p * (1 - p)

    for _ in range(s.rounds):
        for k, table in enumerate(model.tables):
            g, h = slopes()
            size = len(table)
            step = s.rate * shallow_tree(*(np.bincount(b[:, k], v, size) for v in (g, h, np.ones(len(x)))), s.leaves, s.least)
            table += step
            total += step[b[:, k]]
    g, h = slopes()
    coarse = np.stack([b[:, k] * s.coarse // len(t) for k, t in enumerate(model.tables)], axis=1)
    cells = lambda i, j, v: np.bincount(coarse[:, i] * s.coarse + coarse[:, j], v, s.coarse**2).reshape(s.coarse, s.coarse)
    gains = {(i, j): quadrants(cells(i, j, g), cells(i, j, h))[0] for i, j in combinations(range(x.shape[1]), 2)}
    model.pairs = sorted(gains, key=lambda p: (-gains[p], p))[: s.pairs]
    model.pair_tables = [np.zeros((len(model.tables[i]), len(model.tables[j]))) for i, j in model.pairs]
    for _ in range(s.pair_rounds):
        for (i, j), table in zip(model.pairs, model.pair_tables, strict=True):
            g, h = slopes()
            cell = b[:, i] * table.shape[1] + b[:, j]
            step = s.rate * quadrants(*(np.bincount(cell, v, table.size).reshape(table.shape) for v in (g, h)))[1]
            table += step
            total += step[b[:, i], b[:, j]]
    return model


def fit(docs: DataFrame, labels: DataFrame, settings: QualitySettings = QualitySettings()) -> QualityModel:
    """Learn ``quality`` from a sample of the labelled documents, about as many of either class.

    Classes are weighted back to their shares among all labels. Of several
    labels of one document the lowest counts; null labels do not. Of several texts
    under one id, that with the lowest features is learnt from.
    """
    truth = labels.filter(F.col("quality").isNotNull()).groupBy("doc_id").agg((F.min("quality") > 0).cast("int").alias("quality"))
    sizes = {r.quality: r["count"] for r in truth.groupBy("quality").count().collect()}
    shares = {k: min(1.0, settings.sample / max(1, sizes.get(k, 0))) for k in (0, 1)}
    chosen = truth.filter(hash_share(F.when(F.col("quality") == 1, shares[1]).otherwise(shares[0]), F.col("doc_id")))
    schema = pa.schema([("doc_id", pa.int64()), ("quality", pa.int32()), ("x", pa.list_(pa.float64()))])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = character_classes()
        for batch in text_slices(batches):
            yield in_rows({"doc_id": batch.column("doc_id"), "quality": batch.column("quality"), "x": list(features(batch.column("text"), classes))}, schema)

    # The sample bounds what is broadcast and what comes to the driver.
    sampled = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(F.broadcast(chosen), "doc_id").select("doc_id", "quality", "text")
    rows = sampled.mapInArrow(work, "doc_id long, quality int, x array<double>").groupBy("doc_id", "quality").agg(F.min("x").alias("x")).collect()
    rows.sort(key=lambda r: r.doc_id)
    x = np.array([r.x for r in rows], np.float64).reshape(-1, len(FEATURES))
    y = np.array([r.quality for r in rows], np.int64)
    return train(x, y, np.where(y == 1, 1 / shares[1], 1 / shares[0]) * min(shares.values()), settings)


def score_quality(docs: DataFrame, model: QualityModel) -> DataFrame:
    """``doc_id, score`` for every row, from its whole text alone.

    A null text is empty, and an empty text has a score as any other. Repeated
    rows are each scored; other columns are ignored.
    """
    shipped = for_tasks(docs.sparkSession, model)
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, classes = shipped(), character_classes()
        for batch in text_slices(batches):
            yield in_rows({"doc_id": batch.column("doc_id"), "score": own.score(features(batch.column("text"), classes))}, schema)

    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return chosen.mapInArrow(work, "doc_id long, score double")


def accepted(docs: DataFrame, model: QualityModel, least: float) -> DataFrame:
    """The rows of ``docs`` that score ``least`` or more, with all their columns."""
    shipped = for_tasks(docs.sparkSession, model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, classes = shipped(), character_classes()
        for batch in text_slices(batches):
            yield batch.filter(pa.array(own.score(features(batch.column("text"), classes)) >= least))

    return docs.mapInArrow(work, docs.schema)
