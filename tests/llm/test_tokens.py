import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from skyledger.llm import token_files
from skyledger.llm.batches import text_slices
from skyledger.llm.packing import CAPACITY, packed, plan
from skyledger.llm.token_files import read_ids, token_ids, train_dictionary, write_store
from skyledger.llm.tokens import PieceEncoder, vocabulary_path
from skyledger.session import scratch


@pytest.fixture(scope="module")
def encoder():
    return PieceEncoder(vocabulary_path())


PLAIN = Tokenizer.from_file(vocabulary_path())


def plain(encoder, text):
    """By the library as it comes, not by the encoder's own tokenizer."""
    return [*PLAIN.encode(text or "", add_special_tokens=False).ids, 0]


TEXTS = st.text(alphabet="aé1 .\n\t |<'s#日", max_size=20)
SPECIAL = st.lists(st.sampled_from(["<|endoftext|>", " ", "a", "  ", "\n", "<|endof", " b"]), max_size=6).map("".join)


def test_special_tokens_are_what_the_library_makes_of_them():
    text = "a <|endoftext|> b"
    assert plain(None, text) == [64, 220, 50256, 275, 0]
    ids, bounds = PieceEncoder(vocabulary_path()).encode(pa.array([text, " a b", " <|endoftext|>", " c", " <|endoftext|>"]))
    parts = np.split(ids, bounds[1:-1])
    assert parts[0].tolist() == plain(None, text) and parts[4].tolist() == plain(None, " <|endoftext|>")


@given(st.lists(TEXTS | SPECIAL | st.none(), min_size=1, max_size=6))
@settings(max_examples=150, deadline=None)
def test_pieces_give_the_ids_of_the_whole_text(texts):
    encoder = ENCODER.setdefault(0, None) or ENCODER.setdefault(1, PieceEncoder(vocabulary_path()))
    ids, bounds = encoder.encode(pa.array(texts, pa.string()))
    for k, text in enumerate(texts):
        assert ids[bounds[k] : bounds[k + 1]].tolist() == plain(encoder, text)


ENCODER = {}


def test_slices_hold_every_row_once():
    batch = pa.record_batch({"text": pa.array(["a" * n for n in (5, 0, 100, 3, 3, 3)] + [None])})
    slices = list(text_slices([batch], most=10))
    assert [t for s in slices for t in s.column(0).to_pylist()] == batch.column(0).to_pylist()
    assert [s.num_rows for s in slices] == [2, 1, 4]


def expected(encoder, rows):
    return [(r[0], plain(encoder, r[1])) for r in rows]


def test_packing_of_odd_rows(encoder, odd, odd_rows):
    pieces = packed(odd).collect()
    by_place = defaultdict(list)
    for p in pieces:
        by_place[p.sequence_id].append((p.offset, p.length))
    for places in by_place.values():
        places.sort()
        assert [o for o, _ in places] == [sum(n for _, n in places[:k]) for k in range(len(places))]
        assert sum(n for _, n in places) <= CAPACITY
    whole = Counter()
    for doc, ids in expected(encoder, odd_rows):
        first = (len(ids) - 1) % CAPACITY + 1
        cuts = [0, *range(first, len(ids) + 1, CAPACITY)]
        for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
            whole[doc, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())] += 1
    assert Counter((p.doc_id, p.piece, p.start, p.length, p.ids_crc32) for p in pieces) == whole


def test_packing_of_nothing(empty):
    assert packed(empty).count() == 0


@given(st.dictionaries(st.integers(1, 60), st.integers(1, 40), max_size=25))
@settings(max_examples=200, deadline=None)
def test_plan_places_all_pieces_without_overlap(counts):
    capacity = 60
    entries = plan(counts, capacity)
    bins = defaultdict(list)
    ranks = defaultdict(list)
    for length, rank, first, n, offset in entries:
        ranks[length].extend(range(rank, rank + n))
        for k in range(n):
            bins[first + k].append((offset, length))
    assert {k: sorted(v) for k, v in ranks.items()} == {k: list(range(n)) for k, n in counts.items()}
    assert sorted(bins) == list(range(len(bins)))
    for places in bins.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    assert all(sum(3 * length > capacity for _, length in places) <= 2 for places in bins.values())
    free = []
    for length in sorted((k for k, n in counts.items() for _ in range(n)), reverse=True):
        fits = next((k for k, room in enumerate(free) if room >= length), None)
        if fits is None:
            free.append(capacity - length)
        else:
            free[fits] -= length
    # As good as first-fit decreasing, but for a rounding.
    assert len(bins) <= 1.1 * len(free) + 1


def test_plan_matches_large_pieces_best():
    # 40 fits beside 20 only, 35 beside 25: two sequences, not three.
    assert len({e[2] for e in plan({40: 1, 35: 1, 25: 1, 21: 1, 20: 1}, 60)}) <= 3
    assert max(first + n for _, _, first, n, _ in plan({31: 2, 29: 2}, 60)) == 2


def test_token_files_of_odd_rows(encoder, odd, odd_rows):
    got = token_ids(odd).collect()
    wanted = sorted(expected(encoder, odd_rows), key=lambda r: (r[0] is not None, r[0] or 0, zlib.crc32(np.array(r[1], "<u4").tobytes())))
    start = 0
    rows = []
    for doc, ids in wanted:
        rows.append((doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    key = lambda r: (r[1],)
    assert sorted((tuple(r) for r in got), key=key) == rows


def test_one_document_is_read_by_its_frame(spark, encoder, odd, odd_rows):
    folder = scratch(spark, "test-store")
    write_store(odd, folder)
    trained = bytes(spark.read.parquet(f"{folder}/dictionary").first().dictionary)
    reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(trained))
    segment = next(s for s in spark.read.parquet(f"{folder}/segments").collect() if 6 in s.doc_ids)
    at = segment.doc_ids.index(6)
    raw = reader.decompress(bytes(segment.frames)[segment.offsets[at] : segment.offsets[at + 1]])
    assert np.frombuffer(raw, "<u2").tolist() == plain(encoder, odd_rows[6][1])


def test_many_segments_and_a_changed_dictionary(spark, odd, monkeypatch):
    monkeypatch.setattr(token_files, "SEGMENT_BYTES", 50)
    folder = scratch(spark, "test-store")
    write_store(odd, folder)
    assert read_ids(spark, folder).count() == odd.count()
    assert spark.read.parquet(f"{folder}/segments").count() > 3
    other = scratch(spark, "test-store")
    write_store(odd.limit(2), other)
    spark.read.parquet(f"{folder}/segments").write.mode("overwrite").parquet(f"{other}/segments")
    with pytest.raises(Exception, match="another dictionary"):
        read_ids(spark, other).collect()


def test_a_hot_id_is_spread_over_parts(spark):
    cuts = np.array([5, 9, 9, 9, 12], np.int64)
    ids = np.array([1, 5, 7, 9, 9, 9, 10, 12, 13])
    order = np.array([7, 7, 7, 0, 1 << 31, (1 << 32) - 1, 7, 7, 7])
    assert token_files.part_of(ids, order, cuts).tolist() == [0, 1, 1, 2, 3, 4, 4, 5, 5]
    rows = [(None if k % 3 == 0 else 9 if k % 3 == 1 else k, f"text {k}") for k in range(300)]
    folder = scratch(spark, "test-store")
    write_store(spark.createDataFrame(rows, "doc_id long, text string"), folder)
    segments = spark.read.parquet(f"{folder}/segments").orderBy("part", "segment").collect()
    ids = [i for s in segments for i in s.doc_ids]
    assert ids == sorted((r[0] for r in rows), key=lambda i: (i is not None, i or 0))
    assert sum(None in s.doc_ids for s in segments) > 1 and sum(9 in s.doc_ids for s in segments) > 1


def test_token_files_of_nothing(empty):
    assert token_ids(empty).count() == 0


def test_dictionary_of_few_samples():
    assert train_dictionary([]) == b""
    assert train_dictionary([b"ab", b""]) == b"ab"


def test_pieces_in_use_stay_known():
    """A piece that each batch holds is given to the tokenizer once, however many other pieces come and go."""
    encoder = PieceEncoder(vocabulary_path(), cached=12)
    given, encoded = [], encoder._encoded
    encoder._encoded = lambda texts: given.extend(texts) or encoded(texts)
    for k in range(30):
        encoder.encode(pa.array([f"a steady word{k} new{k} other{k}"]))
    assert sum(text.count(" steady") for text in given) == 1
    assert len(encoder._recent) + len(encoder._older) <= 24
