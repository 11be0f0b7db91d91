"""Toxicity of whole texts: a bag of subwords under a linear softmax.

A word is the mean of the vectors of its character n-grams and of itself, all
hashed into one table; a passage of a few words is the mean of its words, and a
softmax over two classes reads it. Table and softmax are trained together.
A misspelt word shares most n-grams with the word that was learnt. What has no
spaces between words is cut into short pieces that overlap, each a word of its own.

Labels are for whole documents, which may hold one bad word among thousands, so
a document is as toxic as its worst passage. Training goes the same way: all
passages take the label of their document first; then, of each document, only
those that the model takes for the worst.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import coded_words, for_tasks, hash_share, in_rows, ragged, text_slices
from .subwords import IDEOGRAPHS, UNSPACED, BoundedWords, overlapping

_IDEOGRAPH, _UNSPACED = re.compile(f"[{IDEOGRAPHS}]"), re.compile(f"[{UNSPACED}]")


@dataclass(frozen=True)
class ToxicitySettings:
    """``sample``: about so many documents of each class are learnt from, all of them where there are fewer.
    Those with over ``longest_text`` characters are not in the sample, so at most 2 * sample * longest_text come to the driver.

    ``passages``: so many passages, chosen at random, warm the vectors up; refinement reads them all.
    Words of fewer than ``least_documents`` of these are not learnt. Of tokens with more letters than
    ``longest_word`` each run of letters is a word, and a run that is longer still is cut into pieces.
    ``prior``: the share of toxic documents that scores are calibrated to.
    """

    sample: int = 600
    longest_text: int = 50_000
    prior: float = 0.25
    least_documents: int = 4
    buckets: int = 1 << 16
    width: int = 8
    passage: int = 2
    shortest: int = 3
    longest: int = 5
    longest_word: int = 30
    passages: int = 20_000
    warm_up: int = 30
    refinements: int = 6
    steps: int = 30
    worst: int = 3
    rate: float = 0.05
    seed: int = 7


def subwords(words: pa.Array, s: ToxicitySettings) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of each word and its n-grams, and how many they are.

    A word is lower-cased and only its letters and digits count; without any it has no bucket.
    """
    bounded = BoundedWords(pc.replace_substring_regex(pc.utf8_lower(words), r"[^\p{L}\p{N}]+", ""), s.longest_word)
    parts = [(bounded.whole(), np.arange(len(words))), *(bounded.grams(n) for n in range(s.shortest, s.longest + 1))]
    bucket = (np.concatenate([h for h, _ in parts]) >> np.uint64(33)).astype(np.int64) % s.buckets
    owner = np.concatenate([o for _, o in parts])
    kept = bounded.lengths[owner] > 0
    bucket, owner = bucket[kept], owner[kept]
    return bucket[np.argsort(owner, kind="stable")], np.bincount(owner, minlength=len(words))


def pieces(token: str, s: ToxicitySettings) -> list[str]:
    """The words of a token whose runs of letters and digits are spaced, every letter in one of them at least.

    Single letters in a row ('a.b.c') are one run. Of ideographs two are a word, of other letters the longest n-gram.
    """
    runs: list[str] = []
    single = False
    for run in token.split():
        joins, single = single and len(run) == 1, len(run) == 1
        if joins:
            runs[-1] += run
        else:
            runs.append(run)
    out: list[str] = []
    for run in runs:
        if _IDEOGRAPH.match(run):
            out.extend(overlapping(run, 2, 1))
        elif len(run) > s.longest_word or _UNSPACED.search(run):
            out.extend(overlapping(run, s.longest, s.longest - 1))
        else:
            out.append(run)
    return out


def cut_words(texts: pa.Array, s: ToxicitySettings) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """As ``coded_words``, but with tokens that are no single word cut into the words they hold."""
    distinct, codes, bounds = coded_words(texts)
    letters = pc.utf8_length(distinct)
    cut = pc.or_(pc.greater(letters, s.longest_word), pc.greater(pc.binary_length(distinct), letters)).to_numpy(zero_copy_only=False)
    bare = pc.replace_substring_regex(distinct.filter(pa.array(cut)), r"[^\p{L}\p{N}]+", "")
    cut[cut] = pc.or_(pc.greater(pc.utf8_length(bare), s.longest_word), pc.match_substring_regex(bare, f"[{UNSPACED}]")).to_numpy(zero_copy_only=False)
    if not cut.any():
        return distinct, codes, bounds
    spaced = pc.replace_substring_regex(pc.replace_substring_regex(pc.utf8_lower(distinct.filter(pa.array(cut))), r"\p{M}+", ""), r"[^\p{L}\p{N}]+", " ")
    spaced = pc.replace_substring_regex(spaced, f"[{IDEOGRAPHS}]+", r" \0 ")
    words = [pieces(t, s) for t in spaced.to_pylist()]
    sizes = np.ones(len(distinct), np.int64)
    sizes[cut] = [len(w) for w in words]
    all_words = pc.dictionary_encode(pa.concat_arrays([distinct.filter(pa.array(~cut)), pa.array([w for ws in words for w in ws], distinct.type)]))
    # Where the words of each token are: first those that are not cut, then the pieces.
    first = np.empty(len(distinct), np.int64)
    first[~cut] = np.arange((~cut).sum())
    first[cut] = (~cut).sum() + np.cumsum(sizes[cut]) - sizes[cut]
    places = ragged(first[codes], sizes[codes])
    ends = np.concatenate([[0], np.cumsum(sizes[codes])])
    return all_words.dictionary, all_words.indices.to_numpy(zero_copy_only=False)[places], ends[bounds]


class Summed:
    """Sums rows by their group; the order of the groups is found once."""

    def __init__(self, group: np.ndarray, n: int):
        self._order = np.argsort(group, kind="stable")
        self._present, self._starts = np.unique(group[self._order], return_index=True)
        self._n = n

    def __call__(self, values: np.ndarray) -> np.ndarray:
        out = np.zeros((self._n, values.shape[1]), np.float32)
        if len(self._starts):
            out[self._present] = np.add.reduceat(values[self._order], self._starts, axis=0)
        return out


@dataclass
class ToxicityModel:
    settings: ToxicitySettings
    weights: np.ndarray  # of each bucket, its vector read by the softmax
    bias: float
    slope: float = 1.0
    shift: float = 0.0

    def words(self, words: pa.Array) -> np.ndarray:
        """How each word moves the log odds of a passage of one word."""
        bucket, sizes = subwords(words, self.settings)
        total = np.concatenate([[0.0], np.cumsum(self.weights[bucket], dtype=np.float64)])
        ends = np.cumsum(sizes)
        return (total[ends] - total[ends - sizes]) / np.maximum(sizes, 1)

    def worst(self, texts: pa.Array) -> np.ndarray:
        """The log odds of each text's worst passage; those of the bias alone for a text without words."""
        distinct, codes, bounds = cut_words(texts, self.settings)
        values = self.words(distinct)[codes] if len(distinct) else np.zeros(0)
        total = np.concatenate([[0.0], np.cumsum(values)])
        span = self.settings.passage
        out = np.full(len(texts), self.bias)
        for i, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
            if b > a:
                n = min(span, b - a)
                out[i] = (total[a + n : b + 1] - total[a : b + 1 - n]).max() / span + self.bias
        return out

    def score(self, texts: pa.Array) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.worst(texts) + self.shift, -30, 30)))


def train(texts: list[str], labels: np.ndarray, s: ToxicitySettings = ToxicitySettings()) -> ToxicityModel:
    """Fit table and softmax by full-batch Adam; calibrate to the labels of these documents."""
    model = ToxicityModel(s, np.zeros(s.buckets), 0.0)
    if not len(labels) or labels.min() == labels.max():
        # Nothing to tell apart: everything has the share of the one class, smoothed.
        share = (labels.sum() + 1) / (len(labels) + 2)
        model.slope, model.shift = 0.0, float(np.log(share / (1 - share)))
        return model
    distinct, codes, bounds = cut_words(pa.array(texts, pa.string()), s)
    bucket, sizes = subwords(distinct, s)
    # Words of few documents can only be learnt by heart, so they train nothing.
    pairs = np.unique(np.repeat(np.arange(len(labels)), np.diff(bounds)) * max(1, len(distinct)) + codes)
    common = np.bincount(pairs % max(1, len(distinct)), minlength=len(distinct)) >= s.least_documents
    bucket, sizes = bucket[np.repeat(common, sizes)], np.where(common, sizes, 0)
    first_part = np.cumsum(sizes) - sizes
    rows = np.repeat(np.arange(len(labels)), np.diff(bounds))
    within = np.arange(len(codes)) - bounds[rows]
    # A passage has a fixed number of places; words are counted in as many, so short texts weigh as they do in scoring.
    passage = np.cumsum(np.concatenate([[True], (rows[1:] != rows[:-1]) | (within[1:] % s.passage == 0)])) - 1 if len(codes) else np.zeros(0, np.int64)
    of_document = rows[np.unique(passage, return_index=True)[1]] if len(codes) else np.zeros(0, np.int64)
    random = np.random.default_rng(s.seed)
    table, reader = (random.normal(0, d, n).astype(np.float32) for d, n in ((0.1, (s.buckets, s.width)), (0.3, (s.width, 2))))
    constant = np.zeros(2, np.float32)
    state = [[np.zeros_like(p), np.zeros_like(p)] for p in (table, reader, constant)]
    step = 0

    def run(chosen: np.ndarray, steps: int) -> None:
        """Some steps on these passages; only their words and the buckets of those are touched."""
        nonlocal step, reader, constant
        taken = np.isin(passage, chosen)
        place = np.searchsorted(chosen, passage[taken])
        used, word = np.unique(codes[taken], return_inverse=True)
        own = ragged(first_part[used], sizes[used])
        buckets, slot = np.unique(bucket[own], return_inverse=True)
        each = (1.0 / np.maximum(sizes[used], 1)).astype(np.float32)
        to_words = Summed(np.repeat(np.arange(len(used)), sizes[used]), len(used))
        to_buckets, to_passages, to_used = Summed(slot, len(buckets)), Summed(place, len(chosen)), Summed(word, len(used))
        word_of = np.repeat(np.arange(len(used)), sizes[used])
        truth = labels[of_document[chosen]]
        weight = np.where(truth == 1, 0.5 / max(1, truth.sum()), 0.5 / max(1, (1 - truth).sum())).astype(np.float32)
        goal = np.stack([1 - truth, truth], axis=1).astype(np.float32)
        local, moments = table[buckets], [m[buckets] for m in state[0]]
        for _ in range(steps):
            vectors = to_words(local[slot]) * each[:, None]
            mean = to_passages(vectors[word]) / s.passage
            logits = mean @ reader + constant
            soft = np.exp(logits - logits.max(axis=1, keepdims=True))
            off = (soft / soft.sum(axis=1, keepdims=True) - goal) * weight[:, None]
            back = to_used((off @ reader.T / s.passage)[place]) * each[:, None]
            slopes = (to_buckets(back[word_of]), mean.T @ off + 1e-4 * reader, off.sum(axis=0))
            step += 1
            for p, g, (m, v) in zip((local, reader, constant), slopes, (moments, *state[1:]), strict=True):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                p -= s.rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        table[buckets] = local
        for kept, m in zip(state[0], moments, strict=True):
            kept[buckets] = m

    everything = np.arange(len(of_document))
    run(np.sort(random.permutation(everything)[: s.passages]), s.warm_up)
    for _ in range(s.refinements):
        weights = table @ (reader[:, 1] - reader[:, 0])
        value = np.bincount(np.repeat(np.arange(len(sizes)), sizes), weights[bucket], len(sizes)) / np.maximum(sizes, 1)
        logit = np.bincount(passage, value[codes], len(of_document))
        order = np.lexsort((-logit, of_document))
        first = np.searchsorted(of_document[order], of_document[order])
        depth = np.arange(len(order)) - first
        most = np.where(labels[of_document[order]] == 1, 1, s.worst)
        run(np.sort(order[depth < most]), s.steps)
    difference = reader[:, 1] - reader[:, 0]
    model = ToxicityModel(s, table @ difference, float(constant[1] - constant[0]))
    model.slope, model.shift = calibrated(model.worst(pa.array(texts, pa.string())), labels, s.prior)
    return model


def calibrated(values: np.ndarray, labels: np.ndarray, prior: float) -> tuple[float, float]:
    """Slope and shift of a logistic curve through these values, by Newton steps."""
    center, scale = values.mean(), values.std() + 1e-9
    x = np.stack([(values - center) / scale, np.ones(len(values))], axis=1)
    weight = np.where(labels == 1, prior / labels.sum(), (1 - prior) / (1 - labels).sum())
    w = np.zeros(2)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        w -= np.linalg.solve(h, x.T @ (weight * (p - labels)) + 1e-3 * w)
    return float(w[0] / scale), float(w[1] - w[0] * center / scale)


def fit(docs: DataFrame, labels: DataFrame, settings: ToxicitySettings = ToxicitySettings()) -> ToxicityModel:
    """Learn ``toxic`` from a sample of the labelled documents, about as many of either class.

    A document with several labels is toxic if one of them says so; null labels do not count.
    Of several texts under one id the first in order is learnt from.
    """
    truth = labels.filter(F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    truth = truth.withColumn("toxic", (F.col("toxic") > 0).cast("int"))
    sizes = {r.toxic: r["count"] for r in truth.groupBy("toxic").count().collect()}
    share = F.when(F.col("toxic") == 1, min(1.0, settings.sample / sizes.get(1, 1))).otherwise(min(1.0, settings.sample / sizes.get(0, 1)))
    chosen = truth.filter(hash_share(share, F.col("doc_id")))
    texts = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).filter(F.length("text") <= settings.longest_text)
    rows = texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text")).collect()
    rows.sort(key=lambda r: r.doc_id)
    return train([r.text for r in rows], np.array([r.toxic for r in rows], np.int64), settings)


def score_toxicity(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """``doc_id, score`` for every row, from its whole text alone; a null text is empty.

    Repeated rows are each scored; other columns are ignored.
    """
    shipped = for_tasks(docs.sparkSession, model)
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shipped()
        for batch in text_slices(batches):
            yield in_rows({"doc_id": batch.column("doc_id"), "score": own.score(batch.column("text"))}, schema)

    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return chosen.mapInArrow(work, "doc_id long, score double")
