"""Token ids of whole texts by a public byte-level BPE vocabulary.

A byte-level BPE never merges across a space that stands before a visible
character, so a text is encoded as its pieces between such spaces. Distinct
pieces are few: each is given to the tokenizer once per worker and looked up
afterwards. A text that holds the string of a special token, which the tokenizer
makes that token, is encoded whole.
"""

from __future__ import annotations

import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .batches import kept_by_worker, ragged

END_ID = 0
_SAFE_CUT = re.compile(r"(?= [^\W_])")
_STARTS_VISIBLY = r"^[\p{L}\p{N}!-/:-@\[-`{-~]"
_LONGEST_CACHED = 64
MOST_CACHED = 400_000
_JOINED = 500
# What the vocabulary writes for a space (fixed value).
_SPACE = "\u0120"


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class PieceEncoder:
    """Encodes batches of texts; keeps the ids of short pieces, in a cache of two bounded generations."""

    def __init__(self, path: str, cached: int = MOST_CACHED):
        self._cached = cached
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._recent: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}
        self._opens = np.zeros(self.vocabulary_size, bool)
        self._special = [t.content for t in self._tokenizer.get_added_tokens_decoder().values()]
        for token, i in self._tokenizer.get_vocab().items():
            self._opens[i] = token.startswith(_SPACE)

    @property
    def vocabulary_size(self) -> int:
        return self._tokenizer.get_vocab_size(with_added_tokens=True)

    @classmethod
    def of_worker(cls, path: str, cached: int = MOST_CACHED) -> PieceEncoder:
        """The one of this Python worker, whose cache is warm from the tasks before."""
        return kept_by_worker(f"piece encoder {path} {cached}", lambda: cls(path, cached))

    def _encoded(self, texts: list[str]) -> list[np.ndarray]:
        return [np.asarray(e.ids, "<u4") for e in self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _ids(self, pieces: list[str], joinable: list[bool]) -> list[bytes]:
        """Ids of each piece, as little-endian unsigned 32-bit numbers.

        A joinable piece is a space, then characters other than it, and no special token: many go to the
        tokenizer in one call, since where the next one starts is told by its space.
        """
        older, recent = self._older, self._recent
        found = list(map(recent.get, pieces))
        unseen = [i for i, ids in enumerate(found) if ids is None]
        for i in unseen:
            found[i] = older.get(pieces[i])
        missing = [i for i in unseen if found[i] is None]
        plain = [i for i in missing if i < len(joinable) and joinable[i]]
        for k in range(0, len(plain), _JOINED):
            some = plain[k : k + _JOINED]
            flat = self._encoded(["".join([pieces[i] for i in some])])[0]
            starts = np.flatnonzero(self._opens[flat])
            if len(starts) != len(some):
                continue
            raw, at = flat.tobytes(), (starts * 4).tolist() + [len(flat) * 4]
            for n, i in enumerate(some):
                found[i] = raw[at[n] : at[n + 1]]
        rest = [i for i in missing if found[i] is None]
        for i, ids in zip(rest, self._encoded([pieces[i] for i in rest]), strict=True):
            found[i] = ids.tobytes()
        # What the older generation knew is in use: it goes on to the recent one.
        if len(recent) + len(unseen) > self._cached:
            self._older, self._recent = recent, {}
        self._recent.update((pieces[i], found[i]) for i in unseen if len(pieces[i]) <= _LONGEST_CACHED)
        return found

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of these texts, the end id after each text, and the bounds of each text.

        A null text is an empty one.
        """
        texts = pc.fill_null(texts, "")
        lists = pc.split_pattern(texts, " ")
        coded = pc.dictionary_encode(lists.flatten())
        bounds = lists.offsets.to_numpy().astype(np.int64)
        bounds -= bounds[0]
        # A piece that follows a space is another piece than the same letters at the start of a text.
        keys = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64) * 2 + 1
        keys[bounds[:-1]] -= 1
        used = np.flatnonzero(np.bincount(keys))
        names = coded.dictionary.take(pa.array(used >> 1))
        follows = pa.array((used & 1).astype(bool))
        pieces = pc.binary_join_element_wise(pc.if_else(follows, " ", ""), names, "").to_numpy(zero_copy_only=False).tolist()
        visible = pc.match_substring_regex(names, _STARTS_VISIBLY).to_numpy(zero_copy_only=False)
        cannot_cut = ((used & 1) == 1) & ~visible
        position = np.zeros(int(used[-1]) + 1, np.int64)
        position[used] = np.arange(len(used))
        keys = position[keys]
        whole = np.zeros(len(texts), bool)
        for special in self._special:
            whole |= pc.match_substring(texts, special).to_numpy(zero_copy_only=False)
        odd = np.flatnonzero(whole | (np.add.reduceat(cannot_cut[keys].astype(np.int64), bounds[:-1]) > 0))
        if len(odd):
            # White space beside white space: cut these texts only where a letter or digit follows.
            texts_cut = [[t] if whole[i] else [p for p in _SAFE_CUT.split(t) if p] for i in odd for t in [texts[int(i)].as_py()]]
            own = {p: len(pieces) + n for n, p in enumerate(dict.fromkeys(p for ps in texts_cut for p in ps))}
            pieces.extend(own)
            parts = np.split(keys, bounds[1:-1])
            for i, ps in zip(odd.tolist(), texts_cut, strict=True):
                parts[i] = np.fromiter((own[p] for p in ps), np.int64, len(ps))
            keys = np.concatenate(parts)
            bounds = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
        joinable = ((used & 1) == 1) & (pc.binary_length(names).to_numpy(zero_copy_only=False) > 0)
        for special in self._special:
            joinable &= ~pc.match_substring(pc.binary_join_element_wise(" ", names, ""), special).to_numpy(zero_copy_only=False)
        ids = self._ids(pieces, joinable.tolist())
        lengths = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        flat = np.frombuffer(b"".join(ids), "<u4")
        taken = lengths[keys]
        before = np.concatenate([[0], np.cumsum(taken)])
        ends = before[bounds] + np.arange(len(bounds))
        out = np.zeros(int(ends[-1]), "<u4")
        own = np.ones(len(out), bool)
        own[ends[1:] - 1] = False
        out[own] = flat[ragged((np.cumsum(lengths) - lengths)[keys], taken)]
        out[ends[1:] - 1] = END_ID
        return out, ends
