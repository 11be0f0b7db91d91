"""Benchmark items in whole documents, with some words changed, left out or added.

Texts are words, lower-cased, of letters and digits only; in scripts without
spaces each letter is a word. An item of L words is in a document if some run of
the document's words is within ``allowed(L)`` edits of it. Items of fewer than
``min_words`` words are looked for by a hash of all their words, others in four steps:

1. An item is cut into m parts of at most ``part_words`` words. Of a run within
   k edits of the item, some part is within k/m edits; walks over long runs part
   too often, those over parts do not.
2. A run that close to a part holds most of its word pairs. Windows with too few
   pairs of any part cannot be near one and are left out; this loses nothing.
3. Every other window of a part's size is walked at random as its words say
   (CGK embedding: the same walks for parts and windows turn few edits into few
   differing places). Words seen at a few sampled places of the walk are hashed;
   windows and parts of equal hash in any of the repeated walks are candidates.
4. The edit distance of a candidate to its part is computed exactly and, where
   that is near, the one between the whole item and the best run around it.

Step 3 finds a near part with high probability only. Its recall at the largest
number of edits is tried out for each length of a part, and walks are added
until they find ``recall`` of the trials.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pandas.util import hash_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch
from .batches import coded_words, for_tasks, in_rows, ragged, text_slices
from .subwords import UNSPACED

NOTHING = np.uint64(0)
CELLS = 1 << 21


@dataclass(frozen=True)
class LeakSettings:
    """``edit_share``: edits allowed per word of an item. Items of fewer than ``min_words`` words have to be there as they
    are: with edits they are common language. ``block`` and ``block_chars``: about so many items, of so many characters in
    all, are looked for in one pass over the documents. ``repetitions``: walks to begin with. ``recall``: what walks have
    to find of ``trials`` parts with the most edits, of each kind of edit."""

    edit_share: float = 0.2
    min_words: int = 8
    part_words: int = 18
    places: int = 2
    repetitions: int = 32
    seed: int = 11
    block: int = 5000
    block_chars: int = 2_000_000
    recall: float = 0.99
    trials: int = 200

    def allowed(self, words: int) -> int:
        return int(self.edit_share * words) if words >= self.min_words else 0


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A number per word, and the bounds of each text; words without letter or digit are left out."""
    distinct, codes, bounds = coded_words(texts)
    if not len(distinct):
        return np.zeros(0, np.uint64), bounds
    bare = pc.replace_substring_regex(pc.utf8_lower(distinct), r"[^\p{L}\p{N}]+", "")
    wide = pc.greater(pc.binary_length(bare), pc.utf8_length(bare)).to_numpy(zero_copy_only=False)
    wide[wide] = pc.match_substring_regex(bare.filter(pa.array(wide)), f"[{UNSPACED}]").to_numpy(zero_copy_only=False)
    if wide.any():
        spaced = pc.replace_substring_regex(bare, f"[{UNSPACED}]", r" \0 ")
        lists = pc.utf8_split_whitespace(pc.utf8_trim_whitespace(spaced))
        bare, first = lists.flatten(), lists.offsets.to_numpy().astype(np.int64)
        sizes = np.diff(first)[codes]
        codes, bounds = ragged(first[codes], sizes), np.concatenate([[0], np.cumsum(sizes)])[bounds]
    bare = bare.to_numpy(zero_copy_only=False)
    hashes = np.where(bare == "", NOTHING, hash_array(bare, categorize=False) | np.uint64(1))[codes]
    kept = np.concatenate([[0], np.cumsum(hashes != NOTHING)])
    return hashes[hashes != NOTHING], kept[bounds]


def pair_slots(words: np.ndarray, bits: int) -> np.ndarray:
    mixed = words[:-1] * np.uint64(0x9E3779B97F4A7C15) + words[1:] * np.uint64(0xC2B2AE3D27D4EB4F)
    return (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(64 - bits)


def run_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """A hash of each ``n`` words in a row."""
    count = max(0, len(words) - n + 1)
    out = np.zeros(count, np.uint64)
    for k in range(n):
        out = (out ^ words[k : k + count]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(32)
    return out


def walked(words: np.ndarray, starts: np.ndarray, ends: np.ndarray, steps: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Several random walks over each run of words: for each walk and run, a hash of the words at its sampled places.

    At each step the word read says whether to go on to the next one. A walk that
    has come to the end of its run before the last of its places gives 0.
    ``steps`` and ``places`` have a row per walk.
    """
    at = np.repeat(starts[None, :], len(steps), axis=0)
    seen = np.zeros(at.shape, np.uint64)
    padded = np.append(words, NOTHING)
    for k in range(int(places.max()) + 1):
        here = padded[np.where(at < ends, at, len(words))]
        sampled = (places == k).any(axis=1)
        if sampled.any():
            mixed = (seen[sampled] ^ here[sampled]) * np.uint64(0x9E3779B97F4A7C15)
            seen[sampled] = mixed ^ (mixed >> np.uint64(32))
        at += (here * steps[:, k, None] >> np.uint64(63)).view(np.int64)
        ended = sampled & (places.max(axis=1) == k)
        seen[ended] *= here[ended] != NOTHING
    return seen


def edits_to_best_run(items: np.ndarray, regions: np.ndarray) -> np.ndarray:
    """Row by row, the least edits between an item's words and any run of a region's words."""
    n, width = regions.shape
    offset = np.arange(width + 1, dtype=np.int32)
    above = np.zeros((n, width + 1), np.int32)
    for i in range(items.shape[1]):
        row = np.empty_like(above)
        row[:, 0] = i + 1
        row[:, 1:] = np.minimum(above[:, :-1] + (regions != items[:, i : i + 1]), above[:, 1:] + 1)
        above = np.minimum.accumulate(row - offset, axis=1) + offset
    return above.min(axis=1)


def walk_recall(n: int, edits: int, steps: np.ndarray, places: np.ndarray, s: LeakSettings) -> float:
    """The share of parts of ``n`` distinct words that these walks find with all edits allowed, for the worst kind of edit."""
    random, rows = np.random.default_rng([s.seed, n, 1]), np.arange(s.trials) * n
    items = random.integers(1, 1 << 63, (s.trials, n), dtype=np.uint64)
    fresh = random.integers(1, 1 << 63, (s.trials, n), dtype=np.uint64)
    chosen = np.argsort(random.random((s.trials, n)), axis=1) < edits
    keys = np.arange(n) + np.zeros((s.trials, 1))
    left_out = np.argsort(keys + n * chosen, axis=1, kind="stable")
    grown = np.argsort(np.concatenate([keys, np.where(chosen, keys - 0.5, 2 * n)], axis=1), axis=1, kind="stable")[:, :n]
    windows = (
        np.where(chosen, fresh, items),
        np.take_along_axis(np.where(chosen, fresh, items), left_out, axis=1),
        np.take_along_axis(np.concatenate([items, fresh], axis=1), grown, axis=1),
    )
    own = walked(items.ravel(), rows, rows + n, steps, places)
    seen = (walked(w.ravel(), rows, rows + n, steps, places) for w in windows)
    return min(float(((w == own) & (own != 0)).any(axis=0).mean()) for w in seen)


def sampled_walks(n: int, edits: int, s: LeakSettings) -> tuple[np.ndarray, np.ndarray]:
    """The steps and sampled places of as many walks as find ``recall`` of the trials, ``repetitions`` doubled a few times."""
    walks = s.repetitions
    while True:
        random = np.random.default_rng([s.seed, n])
        # About two steps a word: sooner than the end, most walks are still inside their part.
        length = max(3 * n // 2, s.places)
        steps = random.integers(1, 1 << 63, (walks, length), dtype=np.uint64) | np.uint64(1)
        places = np.stack([np.sort(random.choice(length, s.places, replace=False)) for _ in steps])
        if walks >= 32 * s.repetitions or walk_recall(n, edits, steps, places, s) >= s.recall:
            return steps, places
        walks *= 2


class Parts:
    """The parts of one length: their words, of which item, from which word on; and the hashes of the walks over them."""

    def __init__(self, words: np.ndarray, item: np.ndarray, offset: np.ndarray, edits: int, settings: LeakSettings):
        self.words, self.item, self.offset, self.edits = words, item, offset, edits
        count, n = words.shape
        # An edit breaks two word pairs at most; the longest run that near has ``edits`` words more.
        self.needed, self.reach = max(1, n - 1 - 2 * edits), n + edits
        self.steps, self.places = sampled_walks(n, edits, settings)
        keys = walked(words.ravel(), np.arange(count) * n, np.arange(count) * n + n, self.steps, self.places)
        self.order = np.argsort(keys, axis=1, kind="stable").astype(np.int32)
        self.keys = np.take_along_axis(keys, self.order, axis=1)

    def candidates(self, words: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Windows and parts whose walks hash alike at least once."""
        count, n = self.words.shape
        pairs = [np.zeros(0, np.int64)]
        all_seen = walked(words, starts, np.minimum(starts + n, ends), self.steps, self.places)
        for seen, known, part in zip(all_seen, self.keys, self.order, strict=True):
            low, high = np.searchsorted(known, seen, side="left"), np.searchsorted(known, seen, side="right")
            found = np.where(seen == 0, 0, high - low)
            pairs.append(np.unique(np.repeat(np.arange(len(starts)), found) * count + part[ragged(low, found)]))
        return np.divmod(np.unique(np.concatenate(pairs)), count)


def regions(words: np.ndarray, starts: np.ndarray, rows: np.ndarray, bounds: np.ndarray, n: int, edits: int) -> np.ndarray:
    """The words from ``edits`` before each start to where a run of ``n`` words with as many edits can end; none of other texts."""
    at = starts[:, None] + np.arange(-edits, n + 2 * edits)
    inside = (at >= bounds[rows][:, None]) & (at < bounds[rows + 1][:, None])
    return np.where(inside, words[np.clip(at, 0, len(words) - 1)], NOTHING)


class LeakFinder:
    """Looks for a bounded number of items; holds their words and the hashes of the walks over their parts."""

    def __init__(self, items: list[tuple[int, str]], settings: LeakSettings = LeakSettings()):
        self.settings = s = settings
        words, bounds = word_hashes(pa.array([t for _, t in items], pa.string()))
        by_length: dict[int, list[int]] = defaultdict(list)
        for k, n in enumerate(np.diff(bounds).tolist()):
            by_length[n].append(k)
        by_length.pop(0, None)
        self.short = {}
        for n in sorted(n for n in by_length if n < s.min_words):
            ks = by_length.pop(n)
            hashes = np.concatenate([run_hashes(words[bounds[k] : bounds[k + 1]], n) for k in ks])
            order = np.argsort(hashes, kind="stable")
            self.short[n] = (hashes[order], np.array([items[k][0] for k in ks], np.int64)[order])
        self.ids, self.sizes = np.array([i for i, _ in items], np.int64), np.diff(bounds)
        self.items, self.row_of = {}, np.zeros(len(items), np.int64)
        cut: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
        for n, ks in sorted(by_length.items()):
            self.items[n] = np.stack([words[bounds[k] : bounds[k + 1]] for k in ks])
            self.row_of[ks] = np.arange(len(ks))
            m = -(-n // s.part_words)
            cuts = [j * n // m for j in range(m + 1)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                cut[b - a].extend((k, a, s.allowed(n) // m) for k in ks)
        self.parts: dict[int, Parts] = {}
        for n, pieces in sorted(cut.items()):
            item, offset, edits = (np.array(c, np.int64) for c in zip(*pieces, strict=True))
            self.parts[n] = Parts(words[(bounds[item] + offset)[:, None] + np.arange(n)], item, offset, int(edits.max()), s)
        # For each pair, a bit for every length of a part that holds it (lengths beyond 16 share bits); 32 MB at most.
        pairs = sum(p.words.size for p in self.parts.values())
        self.bits = min(24, max(16, int(np.ceil(np.log2(64 * (pairs + 1))))))
        self.pairs = np.zeros(1 << self.bits, np.uint16)
        self.class_of = {n: np.uint16(k % 16) for k, n in enumerate(self.parts)}
        for n, p in self.parts.items():
            for r in p.words:
                self.pairs[pair_slots(r, self.bits)] |= np.uint16(1) << self.class_of[n]
        # Lengths that are alike share the first look at the pairs.
        self.groups: list[list[int]] = []
        for n, p in self.parts.items():
            if self.groups and p.reach <= 1.25 * self.parts[self.groups[-1][0]].reach:
                self.groups[-1].append(n)
            else:
                self.groups.append([n])

    def find(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The rows, items and least edits of all items found in these texts."""
        s = self.settings
        words, bounds = word_hashes(texts)
        nothing = np.zeros(0, np.int64)
        found: dict[tuple[int, int], int] = {}
        self._copies(words, bounds, found)
        if len(words) > 1 and self.parts:
            self._near(words, bounds, found)
        if not found:
            return nothing, nothing, nothing
        keys = np.array(sorted(found), np.int64)
        return keys[:, 0], keys[:, 1], np.array([found[tuple(k)] for k in keys.tolist()], np.int64)

    def _copies(self, words: np.ndarray, bounds: np.ndarray, found: dict) -> None:
        """Short items, word by word as they are."""
        for n, (known, ids) in self.short.items():
            seen = run_hashes(words, n)
            at = np.flatnonzero(known[np.minimum(np.searchsorted(known, seen), len(known) - 1)] == seen)
            row = np.searchsorted(bounds, at, side="right") - 1
            row, at = row[at + n <= bounds[row + 1]], at[at + n <= bounds[row + 1]]
            pairs = np.unique(np.stack([row, seen[at].view(np.int64)]), axis=1)
            row, seen = pairs[0], pairs[1].view(np.uint64)
            low, high = np.searchsorted(known, seen, side="left"), np.searchsorted(known, seen, side="right")
            found.update(((r, i), 0) for r, i in zip(np.repeat(row, high - low).tolist(), ids[ragged(low, high - low)].tolist(), strict=True))

    def _near(self, words: np.ndarray, bounds: np.ndarray, found: dict) -> None:
        """Other items, with the edits allowed."""
        pairs = self.pairs[pair_slots(words, self.bits)]
        hit = pairs != 0
        inner = bounds[1:-1]
        hit[inner[(inner > 0) & (inner < len(words))] - 1] = False  # a pair does not go over the end of a text
        size, some = len(words), np.flatnonzero(hit)
        classes = pairs[some]
        before = np.zeros(size + 1, np.int32)
        np.cumsum(hit, out=before[1:-1])
        before[-1] = before[-2]
        places = [np.zeros((3, 0), np.int64)]
        for group in self.groups:
            most, least = max(self.parts[n].reach for n in group) - 1, min(self.parts[n].needed for n in group)
            reached = before[np.minimum(np.arange(size) + most, size)] - before[:size]
            near = np.flatnonzero(reached >= least)
            if not len(near):
                continue
            row = np.searchsorted(bounds, near, side="right") - 1
            end = bounds[row + 1]
            for n in group:
                p = self.parts[n]
                own = some[(classes >> self.class_of[n] & np.uint16(1)) == 1]
                stop = np.minimum(near + p.reach - 1, end)
                held = np.flatnonzero(np.searchsorted(own, stop) - np.searchsorted(own, near) >= p.needed)
                for k in range(0, len(held), 1 << 12):
                    block = held[k : k + (1 << 12)]
                    places.append(self._near_parts(words, p, near[block], row[block], bounds))
        self._measure(words, np.unique(np.concatenate(places, axis=1), axis=1), bounds, found)

    def _near_parts(self, words: np.ndarray, p: Parts, starts: np.ndarray, rows: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Text, item and cell of every place where an item can begin of which a part is near one of these windows.

        Runs that begin in a cell are all inside the region around its middle.
        """
        n = p.words.shape[1]
        window, part = p.candidates(words, starts, bounds[rows + 1])
        near = np.zeros(len(window), bool)
        step = CELLS // (n + 3 * p.edits)
        for k in range(0, len(window), step):
            at = slice(k, k + step)
            around = regions(words, starts[window[at]], rows[window[at]], bounds, n, p.edits)
            near[at] = edits_to_best_run(p.words[part[at]], around) <= p.edits
        window, part = window[near], part[near]
        item, row = p.item[part], rows[window]
        allowed = (self.settings.edit_share * self.sizes[item]).astype(np.int64)
        middle, cell = starts[window] - p.offset[part], 2 * allowed + 1
        low, high = np.maximum(middle - allowed, bounds[row]) // cell, (middle + allowed) // cell
        count = np.where(middle + allowed >= bounds[row], high - low + 1, 0)
        return np.unique(np.stack([np.repeat(row, count), np.repeat(item, count), ragged(low, count)]), axis=1)

    def _measure(self, words: np.ndarray, places: np.ndarray, bounds: np.ndarray, found: dict) -> None:
        """Keeps the edits between each of these items and the best run that begins in its cell, where they are allowed."""
        rows, items, cells = places
        for n in np.unique(self.sizes[items]).tolist():
            own, allowed = np.flatnonzero(self.sizes[items] == n), self.settings.allowed(n)
            step = max(1, CELLS // (n + 3 * allowed))
            for k in range(0, len(own), step):
                at = own[k : k + step]
                around = regions(words, cells[at] * (2 * allowed + 1) + allowed, rows[at], bounds, n, allowed)
                edits = edits_to_best_run(self.items[n][self.row_of[items[at]]], around)
                for r, i, e in zip(rows[at].tolist(), self.ids[items[at]].tolist(), edits.tolist(), strict=True):
                    if e <= allowed and e < found.get((r, i), allowed + 1):
                        found[r, i] = e


def item_blocks(benchmark: DataFrame, settings: LeakSettings) -> Iterator[LeakFinder]:
    """Finders for all items, a bounded number at a time. Repeated items count once; null ids and texts are left out."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).dropna().distinct()
    size = items.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("chars")).first()
    blocks = max(1, -(-size.n // settings.block), -(-size.chars // settings.block_chars))
    for k in range(blocks):
        rows = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).collect()
        yield LeakFinder(sorted((r.item_id, r.text) for r in rows), settings)


def _leaks(docs: DataFrame, finder: LeakFinder) -> DataFrame:
    shipped = for_tasks(docs.sparkSession, finder)
    schema = pa.schema([(n, pa.int64()) for n in ("doc_id", "item_id", "edits")])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shipped()
        for batch in text_slices(batches):
            rows, items, edits = own.find(batch.column("text"))
            if len(rows):
                yield in_rows({"doc_id": batch.column("doc_id").take(pa.array(rows)), "item_id": items, "edits": edits}, schema)

    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return chosen.mapInArrow(work, "doc_id long, item_id long, edits long")


def find_leaks(docs: DataFrame, benchmark: DataFrame, settings: LeakSettings = LeakSettings()) -> DataFrame:
    """``doc_id, item_id, edits``: a row for each item in each document that holds it, with the fewest edits found.

    Null and empty texts hold nothing. A document that occurs twice is reported
    twice. Other columns of either table are ignored.
    """
    spark, found = docs.sparkSession, None
    for finder in item_blocks(benchmark, settings):
        leaks = _leaks(docs, finder)
        if found is not None:
            folder = scratch(spark, "leaks")
            found.write.parquet(folder)
            found = spark.read.parquet(folder).unionByName(leaks)
        else:
            found = leaks
    return found


def decontaminated(docs: DataFrame, benchmark: DataFrame, settings: LeakSettings = LeakSettings()) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, with all their columns; null texts stay."""
    for finder in item_blocks(benchmark, settings):
        shipped = for_tasks(docs.sparkSession, finder)

        def work(batches: Iterator[pa.RecordBatch], shipped=shipped) -> Iterator[pa.RecordBatch]:
            own = shipped()
            for batch in text_slices(batches):
                clean = np.ones(batch.num_rows, bool)
                clean[own.find(batch.column("text"))[0]] = False
                yield batch.filter(pa.array(clean))

        docs = docs.mapInArrow(work, docs.schema)
    return docs
