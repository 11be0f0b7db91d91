"""Language of whole texts: known words first, character n-grams for the others.

A word that the training texts of any language hold often enough is scored by
its log frequency in each language. Any other word backs off to its longest
character n-grams of which one is known, then to shorter ones. Evidence is
summed over the words of a text, repeats included.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import coded_words, for_tasks, hash_share, in_rows, ragged, sums_by_row, text_slices
from .subwords import BoundedWords, overlapping

UNDETERMINED = "und"


@dataclass(frozen=True)
class LanguageSettings:
    """``sample``: about so many documents of each language are learnt from, all of them where there are fewer.

    A word counted ``least_count`` times is known; n-grams are learnt from all words. Of each language the
    ``most_words`` most frequent words and the ``most_grams`` most frequent n-grams of each length are known.
    """

    sample: int = 400
    least_count: int = 2
    most_words: int = 40_000
    most_grams: int = 40_000
    longest: int = 5
    longest_word: int = 40


@dataclass
class LogShares:
    """Log frequency per language of the keys that were kept, by their sorted hashes."""

    keys: np.ndarray
    values: np.ndarray

    @classmethod
    def of(cls, keys: np.ndarray, counts: np.ndarray, least: int, most: int) -> LogShares:
        """Of the keys counted ``least`` times or oftener the ``most`` frequent of each language, one added to each count."""
        enough = np.flatnonzero(counts.sum(axis=1) >= least)
        kept = np.zeros(len(keys), bool)
        for own in counts[enough].T:
            kept[enough[np.lexsort((keys[enough], -own))[: min(most, (own > 0).sum())]]] = True
        kept = np.flatnonzero(kept)
        counts = counts[kept] + 1.0
        return cls(keys[kept], np.log(counts / counts.sum(axis=0)).astype(np.float32))

    def rows(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the keys are in the table, and which are there at all."""
        if not len(self.keys):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return at, self.keys[at] == keys


def letter_runs(tokens: pa.Array, longest: int, overlap: int) -> tuple[pa.Array, np.ndarray]:
    """The runs of letters in lower-cased tokens and the token of each; a run over ``longest`` letters is several that overlap."""
    spaced = pc.replace_substring_regex(pc.utf8_lower(tokens), r"[^\p{L}]+", " ")
    lists = pc.split_pattern(spaced, " ")
    owner = np.repeat(np.arange(len(tokens)), np.diff(lists.offsets.to_numpy()))
    runs = lists.flatten()
    real = pc.not_equal(runs, "")
    runs, owner = runs.filter(real), owner[real.to_numpy(zero_copy_only=False)]
    long = pc.greater(pc.utf8_length(runs), longest).to_numpy(zero_copy_only=False)
    if not long.any():
        return runs, owner
    pieces = [overlapping(r, longest, overlap) for r in runs.filter(pa.array(long)).to_pylist()]
    sizes = np.ones(len(runs), np.int64)
    sizes[long] = [len(p) for p in pieces]
    first = np.cumsum(~long) - 1
    first[long] = (~long).sum() + np.cumsum(sizes[long]) - sizes[long]
    cut = pa.concat_arrays([runs.filter(pa.array(~long)), pa.array([p for ps in pieces for p in ps], runs.type)])
    return cut.take(pa.array(ragged(first, sizes))), np.repeat(owner, sizes)


@dataclass
class LanguageModel:
    languages: list[str]
    words: LogShares
    by_length: dict[int, LogShares]
    longest_word: int

    def run_evidence(self, runs: pa.Array) -> np.ndarray:
        """Per run of letters, its log frequency in each language, by the longest part of it that is known."""
        bounded = BoundedWords(runs, self.longest_word)
        at, known = self.words.rows(bounded.whole())
        out = np.zeros((len(runs), len(self.languages)))
        out[known] = self.words.values[at[known]]
        waiting = ~known
        for n in sorted(self.by_length, reverse=True):
            if not waiting.any():
                break
            table = self.by_length[n]
            hashes, owner = bounded.grams(n)
            open_ = waiting[owner]
            at, found = table.rows(hashes[open_])
            owner, values = owner[open_][found], table.values[at[found]]
            count = np.bincount(owner, minlength=len(runs))
            some = count > 0
            for k in range(len(self.languages)):
                out[some, k] = np.bincount(owner, values[:, k], len(runs))[some] / count[some]
            waiting &= ~some
        return out

    def predict(self, texts: pa.Array) -> tuple[list[str], np.ndarray]:
        distinct, codes, bounds = coded_words(texts)
        if not self.languages or not len(distinct):
            return [UNDETERMINED] * len(texts), np.zeros(len(texts))
        runs, owner = letter_runs(distinct, self.longest_word, max(self.by_length, default=1) - 1)
        by_run, n = self.run_evidence(runs), len(distinct)
        evidence = np.stack([np.bincount(owner, by_run[:, k], n) for k in range(len(self.languages))], axis=1)
        total = sums_by_row(evidence[codes], bounds)
        letters = sums_by_row(np.bincount(owner, minlength=n)[codes], bounds)
        best = total.argmax(axis=1)
        score = 1 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
        seen = letters > 0
        return [self.languages[b] if s else UNDETERMINED for b, s in zip(best.tolist(), seen.tolist(), strict=True)], np.where(seen, score, 0.0)


def fit(docs: DataFrame, settings: LanguageSettings = LanguageSettings()) -> LanguageModel:
    """Learn from ``text`` and non-null ``lang`` of a sample of these documents.

    Which documents are in the sample depends on the hash of their ids alone. Of
    several texts under one id in one language the first in order is learnt from.
    """
    learnt = docs.filter(F.col("lang").isNotNull()).select("doc_id", "lang", "text")
    sizes = learnt.groupBy("lang").count()
    shares = sizes.select("lang", F.least(F.lit(1.0), settings.sample / F.col("count")).alias("share"))
    chosen = learnt.join(F.broadcast(shares), "lang").filter(hash_share(F.col("share"), F.col("doc_id")))
    chosen = chosen.groupBy("lang", "doc_id").agg(F.min("text").alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            distinct, codes, bounds = coded_words(batch.column("text"))
            runs, owner = letter_runs(distinct, settings.longest_word, settings.longest - 1)
            langs = batch.column("lang").dictionary_encode()
            lang = np.repeat(langs.indices.to_numpy(), np.diff(bounds))
            pairs, n = np.unique(lang * max(1, len(distinct)) + codes, return_counts=True)
            of_lang, of_token = np.divmod(pairs, max(1, len(distinct)))
            first, size = np.searchsorted(owner, of_token), np.bincount(owner, minlength=len(distinct))[of_token]
            yield pa.record_batch({"lang": langs.dictionary.take(pa.array(np.repeat(of_lang, size))), "word": runs.take(pa.array(ragged(first, size))), "n": pa.array(np.repeat(n, size))})

    counted = chosen.select("lang", F.col("text").cast("string").alias("text")).mapInArrow(work, "lang string, word string, n long")
    # As large as the words of the sample at most.
    rows = counted.groupBy("lang", "word").agg(F.sum("n").alias("n")).collect()
    languages = sorted({r.lang for r in rows})
    words = sorted({r.word for r in rows})
    lang_at, word_at = ({v: k for k, v in enumerate(names)} for names in (languages, words))
    counts = np.zeros((len(words), len(languages)))
    for r in rows:
        counts[word_at[r.word], lang_at[r.lang]] = r.n
    bounded = BoundedWords(pa.array(words, pa.string()), settings.longest_word)

    def shares(keys: np.ndarray, owner: np.ndarray, n: np.ndarray, least: int, most: int) -> LogShares:
        distinct, slot = np.unique(keys, return_inverse=True)
        total = np.stack([np.bincount(slot, n[owner, k], len(distinct)) for k in range(n.shape[1])], axis=1) if n.shape[1] else np.zeros((len(distinct), 0))
        return LogShares.of(distinct, total, least, most)

    # Unseen words are like rare ones: for n-grams each word counts once.
    by_length = {n: shares(*bounded.grams(n), np.minimum(counts, 1), 1, settings.most_grams) for n in range(1, settings.longest + 1)}
    return LanguageModel(languages, shares(bounded.whole(), np.arange(len(words)), counts, settings.least_count, settings.most_words), by_length, settings.longest_word)


def predict_language(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """``doc_id, lang_pred, score`` for every row, from its whole text alone.

    ``und`` and 0 where a text is null, holds no letter, or nothing was learnt;
    of equally likely languages the first by name. Repeated rows are each
    predicted; other columns are ignored.
    """
    shipped = for_tasks(docs.sparkSession, model)
    schema = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shipped()
        for batch in text_slices(batches):
            lang, score = own.predict(batch.column("text"))
            yield in_rows({"doc_id": batch.column("doc_id"), "lang_pred": lang, "score": score}, schema)

    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return chosen.mapInArrow(work, "doc_id long, lang_pred string, score double")
