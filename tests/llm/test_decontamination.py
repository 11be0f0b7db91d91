import random

import numpy as np
import pyarrow as pa
import pytest
from texts import prose

from skyledger.llm.decontamination import LeakFinder, LeakSettings, decontaminated, edits_to_best_run, find_leaks

ITEMS = [(k, prose(100 + k, 12 + 5 * k)) for k in range(12)]


def brute_edits(item, text):
    """Sellers' algorithm, a cell at a time."""
    above = [0] * (len(text) + 1)
    for i, word in enumerate(item):
        row = [i + 1]
        for j, other in enumerate(text):
            row.append(min(above[j] + (word != other), above[j + 1] + 1, row[j] + 1))
        above = row
    return min(above)


def edited(random_, words, n):
    words = list(words)
    for _ in range(n):
        at, kind = random_.randrange(len(words)), random_.random()
        if kind < 0.5:
            words[at] = f"new{random_.randrange(1000)}"
        elif kind < 0.75 and len(words) > 1:
            del words[at]
        else:
            words.insert(at, f"new{random_.randrange(1000)}")
    return words


def test_edit_distance_of_runs():
    random_ = random.Random(5)
    for _ in range(60):
        item, text = ([random_.randrange(4) for _ in range(random_.randint(1, n))] for n in (8, 15))
        got = edits_to_best_run(np.array([item], np.uint64), np.array([text], np.uint64))
        assert got.tolist() == [brute_edits(item, text)]


@pytest.mark.parametrize("share", [0.0, 0.1, 0.2])
def test_recall_and_exactness_against_brute_force(share):
    random_ = random.Random(int(100 * share))
    finder, settings = LeakFinder(ITEMS), LeakSettings()
    texts, near = [], 0
    for trial in range(6):
        for _, item in ITEMS:
            words = item.split()
            inner = edited(random_, words, int(share * len(words)))
            texts.append(" ".join([*prose(trial, random_.randint(0, 30)).split(), *inner, *prose(trial + 50, random_.randint(0, 30)).split()]))
    rows, items, edits = finder.find(pa.array(texts))
    got = {(r, i): e for r, i, e in zip(rows.tolist(), items.tolist(), edits.tolist(), strict=True)}
    wanted = {}
    for r, text in enumerate(texts):
        for i, item in ITEMS:
            e = brute_edits(item.split(), text.split())
            if e <= settings.allowed(len(item.split())):
                wanted[r, i] = e
                near += 1
    assert got.keys() <= wanted.keys() and all(got[k] == wanted[k] for k in got)
    assert near >= len(texts) * 0.95 and len(got) >= 0.95 * near


@pytest.mark.parametrize("kind", ["deleted", "inserted", "replaced"])
def test_long_items_with_all_edits_allowed(kind):
    random_ = random.Random(3)
    items = [(k, " ".join(f"w{k}x{i}" for i in range(n))) for k, n in enumerate([100, 200, 400, 800] * 2)]
    texts, wanted = [], []
    for k, item in items:
        words = item.split()
        places = set(random_.sample(range(len(words)), len(words) // 5))
        new = [w if i not in places else {"deleted": "", "inserted": f"{w} n{i}", "replaced": f"n{i}"}[kind] for i, w in enumerate(words)]
        texts.append(" ".join([*prose(k, 30).split(), *new, *prose(k + 50, 30).split()]))
        wanted.append((k, k, brute_edits(words, texts[-1].split())))
    rows, found, edits = LeakFinder(items).find(pa.array(texts))
    assert list(zip(rows.tolist(), found.tolist(), edits.tolist(), strict=True)) == wanted


@pytest.mark.parametrize("n", [15, 19, 37, 59, 100, 200, 400, 800])
def test_every_length_is_found_by_walks_over_parts(n):
    random_ = random.Random(n)
    items = [(k, " ".join(f"w{k}x{i}" for i in range(n))) for k in range(60 if n < 200 else 9)]
    finder, allowed = LeakFinder(items), LeakSettings().allowed(n)
    assert set(np.concatenate([p.item for p in finder.parts.values()])) == set(range(len(items))) and max(finder.parts) <= 18
    texts = []
    for k, item in items:
        words, places = item.split(), random_.sample(range(n), allowed)
        for i in places:
            words[i] = ("", f"{words[i]} n{i}", f"n{i}")[k % 3]
        texts.append(" ".join([*prose(k, 30).split(), *words, *prose(k + 50, 30).split()]))
    rows, found, edits = finder.find(pa.array(texts))
    assert (rows == found).all() and len(rows) >= 0.97 * len(items) and (edits <= allowed).all()


def test_few_distinct_words(monkeypatch):
    monkeypatch.setattr("skyledger.llm.decontamination.CELLS", 500)
    random_ = random.Random(8)
    items = [(k, " ".join(random_.choice("abcdefghijkl") for _ in range(n))) for k, n in enumerate([8, 8, 9, 12, 12, 20, 20, 41, 41])]
    texts = [" ".join(x for _ in range(4) for x in edited(random_, random_.choice(items)[1].split(), random_.randrange(6))) for _ in range(60)]
    got = set(zip(*(x.tolist() for x in LeakFinder(items).find(pa.array(texts))), strict=True))
    brute = ((r, i, brute_edits(item.split(), text.split()), len(item.split())) for r, text in enumerate(texts) for i, item in items)
    wanted = {(r, i, e) for r, i, e, n in brute if e <= n // 5}
    assert got <= wanted and len(got) >= 0.99 * len(wanted)


def test_a_finder_is_small():
    finder = LeakFinder([(k, " ".join(f"w{(7919 * k + i) % 50_000}" for i in range(60))) for k in range(5000)])
    assert finder.pairs.nbytes <= 32 << 20
    assert sum(x.nbytes for p in finder.parts.values() for x in (p.words, p.keys, p.order, p.item, p.offset)) <= 16 << 20


def test_case_and_punctuation_do_not_hide_an_item():
    item = ITEMS[3][1]
    loud = "- ".join(w.upper() + "," for w in item.split())
    assert LeakFinder(ITEMS).find(pa.array(["before " + loud + " after"]))[1].tolist() == [3]


def test_short_items_are_found_as_they_are():
    items = [(1, "Who wrote it?"), (2, "yes"), (3, "what is the capital of france"), (4, "who WROTE it"), (5, "?!")]
    texts = ["so who wrote it, then", "who wrote", "it yes", "What is the capital of Spain", None, "the yes-man: what is the capital of France?", "yes yes", "yesterday"]
    rows, found, edits = LeakFinder(items).find(pa.array(texts))
    assert list(zip(rows.tolist(), found.tolist(), strict=True)) == [(0, 1), (0, 4), (2, 2), (5, 3), (6, 2)] and not edits.any()


def test_items_of_scripts_without_spaces():
    letters = [chr(0x4E00 + 41 * k) for k in range(60)]
    thai = "".join(chr(0x0E01 + k * 7 % 40) for k in range(25))
    items = [(1, "".join(letters[:30])), (2, "".join(letters[40:44])), (3, thai), (4, "".join(letters[10:14]) + " abc def")]
    near = letters[:5] + letters[8:20] + ["x"] + letters[21:30]
    texts = ["abc" + "".join(letters[50:] + near) + "\u3002", "".join(letters[39:46]), thai[:12] + thai[13:], "".join(letters[:15])]
    rows, found, edits = LeakFinder(items).find(pa.array(texts))
    assert list(zip(rows.tolist(), found.tolist(), edits.tolist(), strict=True)) == [(0, 1, 4), (1, 2, 0), (2, 3, 1)]


def test_a_run_does_not_go_over_the_end_of_a_text():
    words = ITEMS[0][1].split()
    texts = [" ".join(words[:6]), " ".join(words[6:]), None, "", " ".join(words)]
    assert LeakFinder(ITEMS).find(pa.array(texts))[0].tolist() == [4]


def test_odd_rows(spark, odd, odd_rows):
    bench = spark.createDataFrame([*ITEMS, (50, odd_rows[7][1]), (50, odd_rows[7][1]), (51, None), (None, "a b"), (52, "too short to tell"), (53, "")], "item_id long, text string").selectExpr("*", "'x' AS doc_id")
    got = sorted((r.doc_id, r.item_id, r.edits) for r in find_leaks(odd, bench).collect())
    holding = [r for r in odd_rows if r[1] and odd_rows[7][1] in r[1]]
    assert [g for g in got if g[1] == 50] == sorted((r[0], 50, 0) for r in holding)
    clean = decontaminated(odd, bench)
    assert clean.columns == odd.columns
    assert clean.count() == len(odd_rows) - len(holding)


def test_blocks_of_items_find_the_same(spark):
    docs = spark.createDataFrame([(k, "x y " + t + " z") for k, t in ITEMS], "doc_id long, text string")
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    rows = lambda s: sorted(map(tuple, find_leaks(docs, bench, s).collect()))
    assert rows(LeakSettings(block=3)) == rows(LeakSettings()) == [(k, k, 0) for k, _ in ITEMS]
    assert decontaminated(docs, bench, LeakSettings(block=3)).count() == 0


def test_nothing(spark, empty, odd):
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert find_leaks(empty, bench).count() == 0
    assert find_leaks(odd, bench.limit(0)).count() == 0
    assert decontaminated(odd, bench.limit(0)).count() == odd.count()
