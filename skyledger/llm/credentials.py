"""Secrets in whole texts: fixed patterns, and formats learnt from what these find.

The values that the patterns find in all documents are labelled credentials.
From a sample of each kind a prefix tree is made, whose states are merged where
their outgoing shares do not differ by more than chance allows; what remains is a
probabilistic automaton of the kind's format. One more is made of ordinary
tokens. Every other token of 8 or more characters is scored by how much likelier
a credential automaton makes it than the ordinary one; nothing but the scores
decides.
"""

from __future__ import annotations

import hashlib
import heapq
import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .batches import coded_words, for_tasks, hash_share, in_rows, text_slices

# Patterns, least lengths and order of the kinds (fixed values).
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
BASE = (("assign", ASSIGN, 2, 8), ("access", ACCESS, 0, 16), ("hex", HEX, 0, 32))
KINDS = tuple(kind for kind, *_ in BASE)

CANDIDATE = re.compile(r"[A-Za-z0-9+/_.-]{8,}={0,2}")
# A word that matches neither is part of no base span's keyword or body and of no candidate.
_SUSPECT = r"(?i:password|passwd|secret|token|api_?key)|AKIA|[0-9a-f]{32}"
_RUN = r"[A-Za-z0-9+/_.-]{8,}"

SHARES = 256

Span = tuple[str, int, int, int]  # kind, start, end, where the secret itself starts


def base_spans(text: str) -> list[Span]:
    """Spans of the patterns, by start, then in the order of the kinds. Offsets are code points."""
    found = []
    for kind, pattern, group, least in BASE:
        found.extend((kind, m.start(), m.end(), m.start(group)) for m in pattern.finditer(text) if m.end(group) - m.start(group) >= least)
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def candidates(text: str, start: int = 0, end: int | None = None) -> Iterator[tuple[int, int]]:
    """Runs of 8 or more characters that credentials are made of, without full stops around them."""
    for m in CANDIDATE.finditer(text, start, len(text) if end is None else end):
        a, b = m.start() + len(m[0]) - len(m[0].lstrip(".")), m.start() + len(m[0].rstrip("."))
        if b - a >= 8:
            yield a, b


def other_candidates(text: str, base: list[Span]) -> Iterator[tuple[int, int]]:
    """Candidates before, between and behind the base spans."""
    at = 0
    for _, a, b, _ in base:
        if a > at:
            yield from candidates(text, at, a)
        at = max(at, b)
    yield from candidates(text, at)


@dataclass(frozen=True)
class GrammarSettings:
    """``values``: at most so many of each kind are learnt from, those of lowest hash in all documents, none of more than
    ``longest`` characters. ``documents``: about so many are searched for ``ordinary`` tokens to learn from.

    ``margin`` is by how much, in nats a character, a credential must be likelier than an ordinary token.
    """

    documents: int = 20_000
    values: int = 400
    longest: int = 200
    ordinary: int = 4000
    confidence: float = 0.005
    margin: float = 0.35
    quantile: float = 0.05
    alphabet: int = 66
    smoothing: float = 1.0


@dataclass
class Automaton:
    """States with counts of passages, ends, and steps by character; and how often each character, or the end, follows another."""

    passed: list[int] = field(default_factory=lambda: [0])
    ended: list[int] = field(default_factory=lambda: [0])
    steps: list[dict[str, int]] = field(default_factory=lambda: [{}])
    taken: list[dict[str, int]] = field(default_factory=lambda: [{}])
    follows: dict[str, dict[str, int]] = field(default_factory=dict)
    _totals: dict[str, int] = field(default_factory=dict)
    _known: dict[tuple[float, float], dict] = field(default_factory=dict)

    @classmethod
    def prefix_tree(cls, words: dict[str, int]) -> Automaton:
        tree = cls()
        for word, n in words.items():
            state = 0
            tree.passed[0] += n
            for char in word:
                after = tree.steps[state].get(char)
                if after is None:
                    after = tree.steps[state][char] = len(tree.passed)
                    tree.passed.append(0)
                    tree.ended.append(0)
                    tree.steps.append({})
                    tree.taken.append({})
                tree.taken[state][char] = tree.taken[state].get(char, 0) + n
                tree.passed[after] += n
                state = after
            tree.ended[state] += n
        return tree

    def _differ(self, a: int, n: int, b: int, m: int, bound: float) -> bool:
        return n > 0 and m > 0 and abs(a / n - b / m) > bound * (1 / math.sqrt(n) + 1 / math.sqrt(m))

    def compatible(self, p: int, q: int, bound: float) -> bool:
        """Whether p and q, and all that follows them alike, have shares of ends and steps that agree within the bound."""
        waiting = [(p, q)]
        while waiting:
            p, q = waiting.pop()
            n, m = self.passed[p], self.passed[q]
            if self._differ(self.ended[p], n, self.ended[q], m, bound):
                return False
            for char in self.taken[p].keys() | self.taken[q].keys():
                if self._differ(self.taken[p].get(char, 0), n, self.taken[q].get(char, 0), m, bound):
                    return False
                if char in self.steps[p] and char in self.steps[q]:
                    waiting.append((self.steps[p][char], self.steps[q][char]))
        return True

    def fold(self, p: int, q: int) -> None:
        """Add the tree below q to p."""
        waiting = [(p, q)]
        while waiting:
            p, q = waiting.pop()
            self.passed[p] += self.passed[q]
            self.ended[p] += self.ended[q]
            for char, after in self.steps[q].items():
                self.taken[p][char] = self.taken[p].get(char, 0) + self.taken[q][char]
                if char in self.steps[p]:
                    waiting.append((self.steps[p][char], after))
                else:
                    self.steps[p][char] = after

    @classmethod
    def inferred(cls, words: Iterable[str], confidence: float, most: int | None = None, least: int = 1) -> Automaton:
        """Merge each state of the prefix tree, from the root outwards, into the first kept state it is compatible with.

        The tree is that of the first ``most`` distinct words seen ``least`` times; what follows a character is counted in all. A ``Counter``
        says how often each word was seen.
        """
        words = Counter(words)
        machine = cls.prefix_tree(dict(islice(((w, n) for w, n in words.items() if n >= least), most)))
        for word, n in words.items():
            for char, after in zip(["", *word], [*word, ""], strict=True):
                told = machine.follows.setdefault(char, {})
                told[after] = told.get(after, 0) + n
        bound = math.sqrt(0.5 * math.log(2 / confidence))
        kept = [0]
        frontier = [(0, char) for char in sorted(machine.steps[0])]
        while frontier:
            frontier.sort(key=lambda e: (-machine.taken[e[0]][e[1]], e))
            source, char = frontier.pop(0)
            state = machine.steps[source][char]
            if state in kept:
                continue
            match = next((k for k in kept if machine.compatible(k, state, bound)), None)
            if match is None:
                kept.append(state)
                frontier.extend((state, c) for c in sorted(machine.steps[state]))
            else:
                machine.steps[source][char] = match
                machine.fold(match, state)
                frontier = [(k, c) for k in kept for c in machine.steps[k] if machine.steps[k][c] not in kept]
        return machine.compacted(kept)

    def compacted(self, kept: list[int]) -> Automaton:
        at = {k: i for i, k in enumerate(kept)}
        return Automaton([self.passed[k] for k in kept], [self.ended[k] for k in kept], [{c: at[t] for c, t in self.steps[k].items()} for k in kept], [dict(self.taken[k]) for k in kept], self.follows)

    def log_likelihood(self, word: str, alphabet: int, smoothing: float, learnt: bool = False, least: float = -math.inf) -> float:
        """Smoothed by what follows the character before, so that no word is impossible; off the automaton that alone counts.

        Of a word that was ``learnt`` from once, what it said itself is left out. What falls below ``least`` is not added up further.
        """
        state, total, before = 0, 0.0, ""
        own = Counter(zip(["", *word], [*word, ""], strict=True)) if learnt else {}
        first = Counter(["", *word]) if learnt else {}
        known = self._known.setdefault((alphabet, smoothing), {})
        for char in [*word, ""]:
            step = None if learnt else known.get((state, before, char))
            if step is None:
                step = self._step(state, before, char, alphabet, smoothing, own.get((before, char), 0), first.get(before, 0))
                if not learnt and len(known) < 500_000:
                    known[state, before, char] = step
            total += step[0]
            if total < least:
                break
            state, before = step[1], char
        return total

    def _step(self, state: int | None, before: str, char: str, alphabet: int, smoothing: float, own: int, first: int) -> tuple[float, int | None]:
        """The logarithm of a character's share, the empty one being the end, and the state it leads to."""
        told = self.follows.get(before, {}).get(char, 0) - own
        share = (told + smoothing / (alphabet + 1)) / (self._told(before) - first + smoothing)
        if state is None:
            return math.log(share), None
        seen = self.taken[state].get(char, 0) if char else self.ended[state]
        return math.log((seen + smoothing * share) / (self.passed[state] + smoothing)), self.steps[state].get(char)

    def _told(self, char: str) -> int:
        if not self._totals:
            self._totals = {c: sum(told.values()) for c, told in self.follows.items()}
        return self._totals.get(char, 0)


@dataclass
class Formats:
    """The automata of the kinds that were seen, how likely their own values are at least, and that of ordinary tokens."""

    settings: GrammarSettings
    kinds: dict[str, tuple[Automaton, float]]
    ordinary: Automaton
    once: frozenset[str] = frozenset()
    _judged: dict[str, str | None] = field(default_factory=dict)

    def kind_of(self, word: str) -> str | None:
        """The kind whose format a token has, or None."""
        if word in self._judged:
            return self._judged[word]
        s = self.settings
        best, usual = (s.margin, None), None
        for kind, (machine, least) in self.kinds.items():
            value = machine.log_likelihood(word, s.alphabet, s.smoothing, least=least * len(word)) / len(word)
            if value >= least:
                if usual is None:
                    usual = self.ordinary.log_likelihood(word, s.alphabet, s.smoothing, word in self.once) / len(word)
                best = max(best, (value - usual, kind), key=lambda b: b[0])
        if len(self._judged) > 200_000:
            self._judged.clear()
        if len(word) <= s.longest:
            self._judged[word] = best[1]
        return best[1]

    def spans(self, text: str) -> tuple[list[Span], list[Span]]:
        """Base spans, and all spans; a span by its format is of the kind ``format_`` and the kind it is like."""
        base = base_spans(text)
        added = [(f"format_{kind}", a, b, a) for a, b in other_candidates(text, base) if (kind := self.kind_of(text[a:b]))]
        order = [*KINDS, *(f"format_{k}" for k in KINDS)]
        return base, sorted([*base, *added], key=lambda s: (s[1], order.index(s[0])))


def infer(values: dict[str, Iterable[str]], settings: GrammarSettings = GrammarSettings()) -> Formats:
    """Automata from values by kind, each distinct one once; the key ``ordinary`` holds ordinary tokens, as often as they were seen."""
    chosen = {k: sorted(set(v), key=lambda w: hashlib.blake2b(w.encode()).digest()) for k, v in values.items()}
    seen = Counter(values.get("ordinary", ()))
    usual = Counter({w: seen[w] for w in chosen.get("ordinary", [])[: settings.ordinary]})
    # What was seen once may be a credential, which the tree would know by heart.
    ordinary = Automaton.inferred(usual, settings.confidence, settings.values, 2)
    kinds = {}
    for kind in KINDS:
        if words := chosen.get(kind, [])[: settings.values]:
            machine = Automaton.inferred(words, settings.confidence)
            # How likely a credential is at least: by values the automaton has not learnt from.
            half = Automaton.inferred(words[::2], settings.confidence)
            own = [half.log_likelihood(w, settings.alphabet, settings.smoothing) / len(w) for w in words[1::2] or words]
            kinds[kind] = (machine, float(np.quantile(own, settings.quantile)))
    return Formats(settings, kinds, ordinary, frozenset(w for w, n in usual.items() if n == 1))


def suspect_rows(texts: pa.Array, formats: Formats | None = None) -> np.ndarray:
    """Which texts can hold a base span or, with ``formats``, hold a candidate of one of them. Each distinct word is looked at once."""
    distinct, codes, bounds = coded_words(texts)
    if not len(distinct):
        return np.zeros(len(texts), bool)
    flagged = pc.match_substring_regex(distinct, _SUSPECT).to_numpy(zero_copy_only=False).copy()
    if formats and formats.kinds:
        runs = pc.match_substring_regex(distinct, _RUN).to_numpy(zero_copy_only=False)
        for k in np.flatnonzero(runs & ~flagged).tolist():
            word = distinct[k].as_py()
            flagged[k] = any(formats.kind_of(word[a:b]) for a, b in candidates(word))
    total = np.concatenate([[0], np.cumsum(flagged[codes])])
    return total[bounds[1:]] > total[bounds[:-1]]


def lowest_of_each(rows: DataFrame, key: str, order: tuple[str, ...], most: dict[str, int]) -> DataFrame:
    """Of each key the first rows by ``order``, as many as ``most`` says.

    A key may hold most rows, so its rows are first ranked in SHARES shares, each
    by a task of its own; what these keep is ranked again, SHARES * most rows at most.
    """
    bound = F.lit(0)
    for name, n in most.items():
        bound = F.when(F.col(key) == name, n).otherwise(bound)
    share = F.pmod(F.xxhash64(*order), F.lit(SHARES))
    for groups in ([F.col(key), share], [F.col(key)]):
        ranked = rows.withColumn("_rank", F.row_number().over(Window.partitionBy(*groups).orderBy(*order)))
        # The bound of all keys lets Spark cut before it shuffles.
        rows = ranked.filter(F.col("_rank") <= max(most.values())).filter(F.col("_rank") <= bound).drop("_rank")
    return rows


def fit(docs: DataFrame, settings: GrammarSettings = GrammarSettings()) -> Formats:
    """Infer formats from the values in all documents, and from the ordinary tokens of a sample chosen by the hash of their ids."""
    n = max(1, docs.count())
    order = lambda word: hashlib.blake2b(word.encode(), digest_size=8).digest()

    most = {**dict.fromkeys(KINDS, settings.values), "ordinary": settings.ordinary}

    def lowest(kind: str, values: Counter[str]) -> Counter[str]:
        return Counter({w: values[w] for w in heapq.nsmallest(most[kind], values, key=order)})

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Of each kind, no task holds or hands on more than the values of lowest hash.
        found: dict[str, Counter[str]] = {kind: Counter() for kind in most}
        for batch in text_slices(batches):
            texts, sampled = batch.column("text"), batch.column("sampled").to_numpy(zero_copy_only=False)
            for i in np.flatnonzero(suspect_rows(texts) | sampled).tolist():
                text = texts[i].as_py() or ""
                base = base_spans(text)
                new = {kind: [text[s:b].strip(".") for k, _, b, s in base if k == kind] for kind in KINDS}
                new["ordinary"] = [text[a:b] for a, b in other_candidates(text, base)] if sampled[i] else []
                for kind, words in new.items():
                    found[kind].update(w for w in words if 0 < len(w) <= settings.longest)
                    if len(found[kind]) > 4 * most[kind]:
                        found[kind] = lowest(kind, found[kind])
        rows = [(kind, w, order(w), n) for kind, words in found.items() for w, n in lowest(kind, words).items()]
        if rows:
            yield pa.record_batch(dict(zip(("kind", "value", "hash", "n"), map(list, zip(*rows, strict=True)), strict=True)))

    sampled = F.coalesce(hash_share(min(1.0, settings.documents / n), F.col("doc_id")), F.lit(False)).alias("sampled")
    values = docs.select(F.col("text").cast("string").alias("text"), sampled).mapInArrow(work, "kind string, value string, hash binary, n long")
    values = values.groupBy("kind", "value", "hash").agg(F.sum("n").alias("n"))
    by_kind: dict[str, Counter[str]] = {}
    for r in lowest_of_each(values, "kind", ("hash", "value"), most).collect():
        by_kind.setdefault(r.kind, Counter())[r.value] = r.n
    return infer(by_kind, settings)


def find_secrets(docs: DataFrame, formats: Formats) -> DataFrame:
    """Per row: ``doc_id``, the numbers of base spans, their digest, and all spans as text.

    Spans are ``kind:start:end`` joined by commas. A null text is empty, and a
    text without a secret has zeros and the digest of nothing. Repeated rows
    are each searched; other columns are ignored.
    """
    shipped = for_tasks(docs.sparkSession, formats)
    schema = pa.schema([("doc_id", pa.int64()), *((f"n_{k}", pa.int64()) for k in KINDS), ("base_sha256", pa.string()), ("spans", pa.string())])
    nothing = hashlib.sha256(b"").hexdigest()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shipped()
        written = lambda spans: ",".join(f"{k}:{a}:{b}" for k, a, b, _ in spans)
        for batch in text_slices(batches):
            texts, n = batch.column("text"), batch.num_rows
            counts, digests, lists = {k: [0] * n for k in KINDS}, [nothing] * n, [""] * n
            for i in np.flatnonzero(suspect_rows(texts, own)).tolist():
                base, spans = own.spans(texts[i].as_py())
                for kind, *_ in base:
                    counts[kind][i] += 1
                digests[i], lists[i] = hashlib.sha256(written(base).encode()).hexdigest(), written(spans)
            yield in_rows({"doc_id": batch.column("doc_id"), **{f"n_{k}": v for k, v in counts.items()}, "base_sha256": digests, "spans": lists}, schema)

    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return chosen.mapInArrow(work, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


def redacted(text: str, spans: list[Span]) -> str:
    """The text with each secret replaced by its kind in brackets; of overlapping ones, by the first one's."""
    out, at = [], 0
    for kind, _, end, start in sorted(spans, key=lambda s: (s[3], -s[2])):
        if start >= at:
            out += [text[at:start], f"[{kind}]"]
            at = end
        elif end > at:
            at = end
    return "".join([*out, text[at:]])


def redact_secrets(docs: DataFrame, formats: Formats, column: str = "text") -> DataFrame:
    """The same rows and columns with all secrets replaced; a null text stays null."""
    shipped = for_tasks(docs.sparkSession, formats)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shipped()
        for batch in text_slices(batches, column):
            texts = batch.column(column)
            changed = {i: redacted(text, own.spans(text)[1]) for i in np.flatnonzero(suspect_rows(texts, own)).tolist() for text in [texts[i].as_py()]}
            if changed:
                mask = np.zeros(batch.num_rows, bool)
                mask[list(changed)] = True
                texts = pc.replace_with_mask(texts, pa.array(mask), pa.array([changed[i] for i in sorted(changed)], texts.type))
            yield batch.set_column(batch.schema.get_field_index(column), batch.schema.field(column), texts)

    return docs.mapInArrow(work, docs.schema)
