"""Token counts of whole texts by a sentencepiece BPE vocabulary; no pre-token is shuffled.

The vocabulary has no piece with a blank behind another character, so no merge
crosses the place before a run of blanks, and a text has as many tokens as its
pre-tokens have: each a run of blanks with what follows it. Two tiers tell the
number of a pre-token where it occurs, inside the task that reads the text:

1. a compact hash table of the frequent pre-tokens' numbers, fitted on a bounded
   sample of the documents and broadcast;
2. a cache in each Python worker, which outlives its tasks. What it does not
   hold either is given to the tokenizer.

Neither tier changes a result: the table's words are compared in full.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import for_tasks, in_rows, kept_by_worker, ragged, text_slices
from .tokens import vocabulary_path

VOCABULARY = "piece_bpe_32k.model"
TOKEN_LIMIT = 4096
SAMPLE_DOCUMENTS = 1000
SAMPLE_CHARS = 8 << 10
FREQUENT = 1 << 15
CACHED = 200_000
LONGEST_KEPT = 64
_BLANK = "▁"
_CUT = re.compile(r"(?<=[^ ]) ")
_SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64())])


def pre_tokens(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """The distinct pre-tokens of a batch without their first blank, a code per occurrence, the bounds of each
    row, and whether the row ends with a single blank, which is a pre-token that has nothing left to name it by.

    The tokenizer puts a blank before a text, so the first pre-token needs no rule of its own. A text that holds
    the vocabulary's own blank is one pre-token.
    """
    texts = pc.fill_null(texts, "")
    lists = pc.split_pattern(texts, " ")
    coded = pc.dictionary_encode(lists.flatten())
    words, codes = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    bounds = lists.offsets.to_numpy().astype(np.int64)
    bounds -= bounds[0]
    open_end = np.zeros(len(texts), bool)
    empty = pc.equal(words, "").to_numpy(zero_copy_only=False)
    blanks = np.concatenate([[0], np.cumsum(empty[codes])])
    odd = (np.diff(blanks[bounds]) > 0) & (np.diff(bounds) > 1)
    odd |= pc.match_substring(texts, _BLANK).to_numpy(zero_copy_only=False)
    rows = np.flatnonzero(odd)
    if len(rows):
        more: dict[str, int] = {}
        parts = np.split(codes, bounds[1:-1])
        for i in rows.tolist():
            text = texts[i].as_py()
            own = [text] if _BLANK in text else _CUT.split(text)
            if len(own) > 1 and own[-1] == "":
                open_end[i] = own.pop() == ""
            parts[i] = np.array([len(words) + more.setdefault(w, len(more)) for w in own], np.int64)
        words = pa.concat_arrays([words, pa.array(list(more), words.type)])
        codes = np.concatenate(parts)
        bounds = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
    return words, codes, bounds, open_end


def word_hashes(words: pa.Array) -> np.ndarray:
    """A 64-bit hash of the bytes of each word."""
    sizes = pc.binary_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    out = sizes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    some = np.flatnonzero(sizes)
    if len(some):
        raw = np.frombuffer(pc.binary_join(pa.array([words.cast(pa.binary()).to_pylist()], pa.list_(pa.binary())), b"")[0].as_buffer(), np.uint8)
        at = ragged(np.zeros(len(some)), sizes[some])
        power = np.cumprod(np.full(int(sizes.max()), 0x100000001B3, np.uint64))
        starts = np.cumsum(sizes[some]) - sizes[some]
        out[some] += np.add.reduceat((raw.astype(np.uint64) + np.uint64(1)) * power[at], starts)
    out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    return out ^ (out >> np.uint64(32))


class LengthTable:
    """An open-addressed table from words to their numbers of tokens, in flat arrays."""

    def __init__(self, words: list[str], lengths: list[int]):
        self.words = pa.array(words, pa.string())
        self.lengths = np.array(lengths, np.uint16)
        self.hashes = word_hashes(self.words)
        self.mask = max(16, 1 << (2 * len(words)).bit_length()) - 1
        self.slots = np.full(self.mask + 1, -1, np.int32)
        self.probes = 0
        for i, h in enumerate(self.hashes.tolist()):
            probe = 0
            while self.slots[(h + probe) & self.mask] >= 0:
                probe += 1
            self.slots[(h + probe) & self.mask] = i
            self.probes = max(self.probes, probe + 1)

    def lookup(self, words: pa.Array) -> np.ndarray:
        """The number of tokens of each word; -1 for a word that is not there."""
        out = np.full(len(words), -1, np.int64)
        hashes = word_hashes(words)
        open_ = np.arange(len(words))
        for probe in range(self.probes):
            entry = self.slots[((hashes[open_] + np.uint64(probe)) & np.uint64(self.mask)).astype(np.int64)]
            open_, entry = open_[entry >= 0], entry[entry >= 0]
            alike = np.flatnonzero(self.hashes[entry] == hashes[open_])
            same = pc.equal(words.take(pa.array(open_[alike])), self.words.take(pa.array(entry[alike]))).to_numpy(zero_copy_only=False)
            out[open_[alike[same]]] = self.lengths[entry[alike[same]]]
            open_ = np.delete(open_, alike[same])
        return out


class TokenCounter:
    """Counts tokens of batches of texts; keeps the numbers of short pre-tokens in two bounded generations."""

    def __init__(self, path: str, cached: int = CACHED):
        from sentencepiece import SentencePieceProcessor

        self._tokenizer = SentencePieceProcessor(model_file=path)
        self._cached = cached
        self._recent: dict[str, int] = {}
        self._older: dict[str, int] = {}
        known = self._tokenizer.piece_to_id(_BLANK) != self._tokenizer.unk_id()
        self._blank = 1 if known else len(_BLANK.encode())
        self.cuts = self._can_cut()

    def _can_cut(self) -> bool:
        """Whether texts may be cut before blanks: no piece goes on behind one, a blank is put before the text,
        and nothing else of it is changed."""
        pieces = self._tokenizer.id_to_piece(list(range(self._tokenizer.get_piece_size())))
        probe = "  Ab½ﬁ  c "
        plain = "".join(self._tokenizer.encode(probe, out_type=str)) == _BLANK + probe.replace(" ", _BLANK)
        return plain and not any(_BLANK in p.lstrip(_BLANK) for p in pieces)

    def lengths(self, words: list[str]) -> list[int]:
        return [len(ids) for ids in self._tokenizer.encode(words, num_threads=1)]

    def _cached_lengths(self, words: list[str]) -> list[int]:
        found = [self._recent.get(w, self._older.get(w)) for w in words]
        missing = [i for i, n in enumerate(found) if n is None]
        for k in range(0, len(missing), self._cached):
            some = missing[k : k + self._cached]
            if len(self._recent) + len(some) > self._cached:
                self._older, self._recent = self._recent, {}
            for i, n in zip(some, self.lengths([words[i] for i in some]), strict=True):
                found[i] = n
                if len(words[i]) <= LONGEST_KEPT:
                    self._recent[words[i]] = n
        return found

    def count(self, texts: pa.Array, table: LengthTable | None = None) -> np.ndarray:
        """The number of tokens of each text; a null text has none."""
        if not self.cuts:
            return np.array(self.lengths(pc.fill_null(texts, "").to_pylist()), np.int64)
        words, codes, bounds, open_end = pre_tokens(texts)
        lengths = np.full(len(words), -1, np.int64) if table is None else table.lookup(words)
        rest = np.flatnonzero(lengths < 0)
        if len(rest):
            lengths[rest] = self._cached_lengths(words.take(pa.array(rest)).to_pylist())
        total = np.concatenate([[0], np.cumsum(lengths[codes])])
        return total[bounds[1:]] - total[bounds[:-1]] + open_end * self._blank


def frequent_lengths(docs: DataFrame, path: str, entries: int = FREQUENT, documents: int = SAMPLE_DOCUMENTS) -> LengthTable:
    """The first tier: the ``entries`` most frequent pre-tokens of a sample of about ``documents`` documents, of
    each its first ``SAMPLE_CHARS`` characters. The sample decides what is fast, not what is counted."""
    share = min(1.0, documents / max(1, docs.count()))
    chosen = docs.sample(share, seed=13).select(F.substring(F.col("text").cast("string"), 1, SAMPLE_CHARS).alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            words, codes, _, _ = pre_tokens(batch.column("text"))
            yield pa.record_batch({"word": words, "n": pa.array(np.bincount(codes, minlength=len(words)))})

    counts: Counter[str] = Counter()
    for row in chosen.mapInArrow(work, "word string, n long").collect():
        if 0 < len(row.word) <= LONGEST_KEPT:
            counts[row.word] += row.n
    words = [w for w, _ in sorted(counts.items(), key=lambda c: (-c[1], c[0]))[:entries]]
    return LengthTable(words, TokenCounter(path).lengths(words))


def count_tokens(docs: DataFrame, path: str | None = None, entries: int = FREQUENT) -> DataFrame:
    """``doc_id, n_bytes, n_tokens`` of every row: UTF-8 bytes and tokens of its whole ``text``.

    Tokens are those the tokenizer gives the whole text, without a begin or end token; the strings of special
    tokens are ordinary text. A null text counts as empty, which has none. Repeated rows and ids are all counted, a
    null ``doc_id`` stays null, no rows give no rows. Other columns are ignored. One narrow pass, without a shuffle.
    """
    path = path or vocabulary_path(VOCABULARY)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    table = for_tasks(docs.sparkSession, frequent_lengths(docs, path, entries))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter, frequent = kept_by_worker(f"token counter {path}", lambda: TokenCounter(path)), table()
        for batch in text_slices(batches):
            texts = batch.column("text")
            n_bytes = pc.fill_null(pc.binary_length(texts), 0).cast(pa.int64())
            yield in_rows({"doc_id": batch.column("doc_id"), "n_bytes": n_bytes, "n_tokens": counter.count(texts, frequent)}, _SCHEMA)

    return docs.mapInArrow(work, "doc_id long, n_bytes long, n_tokens long")
