import random
import re
from itertools import combinations

import numpy as np
import pytest
import xxhash

from skyledger.llm import simhash
from skyledger.llm.simhash import components, covering_masks, deduplicated, links, near_duplicates, text_fingerprint


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps):
    root = list(range(len(fps)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a, b in combinations(range(len(fps)), 2):
        if (fps[a] ^ fps[b]).bit_count() <= 3:
            root[find(a)] = find(b)
    return [find(k) for k in range(len(fps))]


def test_every_choice_of_three_bits_is_left_out_by_some_mask():
    for free in ((1 << 64) - 1, 0x00FF_F0F0_1234_5678, 0b1011):
        masks = covering_masks(free)
        positions = [b for b in range(64) if free >> b & 1]
        assert all(m & ~free == 0 for m in masks)
        for chosen in combinations(positions, min(3, len(positions))):
            gone = sum(1 << b for b in chosen)
            assert any(m & gone == 0 for m in masks)


def test_fingerprint_of_odd_texts():
    for text in ("", " \n", "A", "A b", "A B c", "a b c d e", "É É É x", "the " * 100_000, "a\x1cb c d", "\x0b\x0c"):
        assert text_fingerprint(text.encode()) == brute_fingerprint(text)


def near_group(random_, n, center):
    """Fingerprints that a chain of close ones connects."""
    group = [center]
    while len(group) < n:
        fp = random_.choice(group)
        for bit in random_.sample(range(64), random_.randint(1, 3)):
            fp ^= 1 << bit
        group.append(fp)
    return group


@pytest.mark.parametrize("large", [2, 8, 256])
def test_links_connect_what_all_pairs_connect(spark, monkeypatch, large):
    monkeypatch.setattr(simhash, "LARGE_BUCKET", large)
    random_ = random.Random(large)
    fps = {0, (1 << 64) - 1}
    for n in (120, 30, 2):
        fps |= set(near_group(random_, n, random_.getrandbits(64)))
    # Many that agree on most bits, in a large bucket, but are not all near each other.
    fps |= {0xABCDEF00_00000000 | random_.getrandbits(32) for _ in range(150)}
    fps |= {random_.getrandbits(64) for _ in range(200)}
    fps = sorted(fps)
    df = spark.createDataFrame([(int(np.uint64(f).view(np.int64)),) for f in fps], "fp long")
    edges = links(df)
    pairs = [(r.a & (1 << 64) - 1, r.b & (1 << 64) - 1) for r in edges.collect()]
    assert all((a ^ b).bit_count() <= 3 and a != b for a, b in pairs)
    assert len(pairs) <= 15 * 16 * len(fps)
    root = {r.node & (1 << 64) - 1: r.root & (1 << 64) - 1 for r in components(edges).collect()}
    found = [root.get(f, f) for f in fps]
    wanted = brute_components(fps)
    assert len({*zip(found, wanted, strict=True)}) == len(set(found)) == len(set(wanted))
    for f in set(found):
        assert f == min(g for g, r in zip(fps, found, strict=True) if r == f)


def test_components_of_chains_and_hubs(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 160)] + [(-5, 300), (300, -5)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {k: got.get(k, k) for k in range(41)} == dict.fromkeys(range(41), 0)
    assert all(got[k] == 100 for k in range(101, 160))
    assert got[-5] == 300  # as unsigned numbers


def test_odd_rows(odd, odd_rows):
    fps = [brute_fingerprint(r[1]) for r in odd_rows]
    root = brute_components(fps)
    smallest = {}
    for (doc, *_), r in zip(odd_rows, root, strict=True):
        if doc is not None:
            smallest[r] = min(smallest.get(r, doc), doc)
    wanted = sorted(((doc, f"{f:016x}", smallest.get(r)) for (doc, *_), f, r in zip(odd_rows, fps, root, strict=True)), key=repr)
    assert sorted(map(tuple, near_duplicates(odd).collect()), key=repr) == wanted
    kept = deduplicated(odd)
    assert kept.columns == odd.columns
    assert sorted(root[next(k for k, o in enumerate(odd_rows) if tuple(o) == tuple(r))] for r in kept.collect()) == sorted(set(root))


def test_the_smallest_id_stays(spark):
    rows = [(9, "a b c d"), (3, "a b c d"), (3, "a b c d"), (5, "other words are here"), (None, "a b c d")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, deduplicated(df).collect())) == [(3, "a b c d"), (5, "other words are here")]


def test_nothing(empty):
    assert near_duplicates(empty).count() == 0 and deduplicated(empty).count() == 0
