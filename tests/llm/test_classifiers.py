import random

import numpy as np
import pyarrow as pa
import pytest
from texts import WORDS, prose

from skyledger.llm import language, quality, toxicity
from skyledger.llm.batches import held_out_fold

BAD = ["idiot", "scum", "worthless"]


def corpus(n, seed=0):
    """Documents with one bad word among many, or shouted, or neither."""
    random_ = random.Random(seed)
    rows = []
    for k in range(n):
        words = prose(k + 1000 * seed, random_.randint(5, 120)).split()
        toxic, good = int(k % 4 == 0), int(k % 5 != 0)
        if toxic:
            words.insert(random_.randrange(len(words)), random_.choice(BAD))
        text = " ".join(words)
        rows.append((k, text if good else text.upper().replace(" ", "!! "), good, toxic))
    return rows


def tables(spark, rows):
    docs = spark.createDataFrame([(k, t, "x") for k, t, _, _ in rows], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(k, q, x) for k, _, q, x in rows], "doc_id long, quality int, toxic int")
    return docs, labels


def test_quality_of_held_out_documents(spark, odd):
    docs, labels = tables(spark, corpus(600))
    model = quality.fit(docs, labels.filter("doc_id < 400"))
    scores = {r.doc_id: r.score for r in quality.score_quality(docs, model).collect()}
    assert all((scores[k] >= 0.3) == bool(good) for k, _, good, _ in corpus(600) if k >= 400)
    assert quality.accepted(docs, model, 0.3).columns == docs.columns
    assert quality.accepted(docs, model, 0.3).count() == sum(s >= 0.3 for s in scores.values())
    assert quality.score_quality(odd, model).count() == odd.count()
    assert all(0 <= r.score <= 1 for r in quality.score_quality(odd, model).collect())


def test_quality_is_a_sum_of_looked_up_values():
    random = np.random.default_rng(1)
    x = random.normal(size=(800, 3))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0)).astype(int)  # only the pair tells
    x = np.pad(x, ((0, 0), (0, len(quality.FEATURES) - 3)))
    model = quality.train(x, y, np.ones(len(y)))
    assert (0, 1) in model.pairs
    assert ((model.score(x) > 0.5) == y).mean() > 0.9
    bins = model.bins(x[:1])[0]
    by_hand = model.bias + sum(t[b] for t, b in zip(model.tables, bins, strict=True)) + sum(t[bins[i], bins[j]] for (i, j), t in zip(model.pairs, model.pair_tables, strict=True))
    assert model.logits(x[:1])[0] == pytest.approx(by_hand)


def test_quality_trees_find_the_best_cut():
    g, h = np.array([5.0, 5, -5, -5]), np.ones(4)
    assert quality.shallow_tree(g, h, np.full(4, 10.0), 2, 5).tolist() == [10 / 3, 10 / 3, -10 / 3, -10 / 3]
    gain, values = quality.quadrants(np.array([[4.0, -4], [-4, 4]]), np.ones((2, 2)))
    assert gain > 0 and values.tolist() == [[2, -2], [-2, 2]]


def test_toxicity_of_held_out_documents_and_misspellings(spark, odd):
    docs, labels = tables(spark, corpus(600))
    model = toxicity.fit(docs, labels.filter("doc_id < 400"))
    scores = {r.doc_id: r.score for r in toxicity.score_toxicity(docs, model).collect()}
    wrong = sum((scores[k] >= 0.5) != bool(toxic) for k, _, _, toxic in corpus(600) if k >= 400)
    assert wrong <= 4
    near, far = model.score(pa.array([prose(7, 30) + " worthles", prose(7, 30) + " wordings"]))
    assert near > far
    assert toxicity.score_toxicity(odd, model).count() == odd.count()
    assert all(0 <= r.score <= 1 for r in toxicity.score_toxicity(odd, model).collect())


@pytest.mark.parametrize("join", ["...", "-", "/", "_", ""])
def test_toxicity_sees_every_letter_of_a_long_token(spark, join):
    docs, labels = tables(spark, corpus(600))
    model = toxicity.fit(docs, labels.filter("doc_id < 400"))
    words = "".join(c if c.isalpha() else " " for c in prose(7, 30)).split()
    fine, bad, spelt = (model.score(pa.array([join.join(w)]))[0] for w in (words, [*words, "worthless"], [*words, *("w.o.r.t.h.l.e.s.s" if join else ["worthless"])]))
    assert bad > fine and spelt > fine and (bad >= 0.5 or not join)


def test_toxicity_is_learnt_from_text_without_spaces():
    random_ = random.Random(4)
    letters = [chr(0x4E00 + 37 * k) for k in range(200)]
    texts, labels = [], np.arange(200) % 2
    for toxic in labels:
        text = "".join(random_.choices(letters, k=80))
        texts.append(text + "\u9f98\u9f99" * toxic + "".join(random_.choices(letters, k=20)))
    model = toxicity.train(texts[:150], labels[:150])
    assert ((model.score(pa.array(texts[150:])) >= 0.5) == labels[150:]).all()


def test_cut_words_leave_no_letter_out():
    s = toxicity.ToxicitySettings()
    tokens = ["x" * 29 + "yz" + "w" * 40, "I.d.i.o.t!", "\u4f60\u597d\u4e16\u754cabc", "one-" * 10 + "a.b.c", "...", "short"]
    words, codes, bounds = toxicity.cut_words(pa.array([" ".join(tokens), None, tokens[2]]), s)
    got = words.take(pa.array(codes)).to_pylist()
    assert got[bounds[2] :] == ["\u4f60\u597d", "\u597d\u4e16", "\u4e16\u754c", "abc"] and got[bounds[1] : bounds[2]] == [""]
    long = got[: got.index("I.d.i.o.t!")]
    assert long[0] + "".join(w[-1] for w in long[1:]) == tokens[0]
    assert got[bounds[1] - 13 : bounds[1]] == [*["one"] * 10, "abc", "...", "short"]


def test_subwords_count_letters_and_digits_only():
    s = toxicity.ToxicitySettings()
    bucket, sizes = toxicity.subwords(pa.array(["Idiot!", "idiot", "...", "", "ß"]), s)
    assert sizes.tolist()[2:4] == [0, 0] and sizes[0] == sizes[1] > 5
    assert bucket[: sizes[0]].tolist() == bucket[sizes[0] : 2 * sizes[0]].tolist()


@pytest.mark.parametrize("fit", [quality.fit, toxicity.fit])
@pytest.mark.parametrize("kept", ["doc_id < 0", "quality = 1 AND toxic = 0", "doc_id < 3"])
def test_few_or_one_sided_labels(spark, fit, kept):
    docs, labels = tables(spark, corpus(30))
    model = fit(docs, labels.filter(kept))
    score = quality.score_quality if fit is quality.fit else toxicity.score_toxicity
    assert all(0 <= r.score <= 1 for r in score(docs, model).collect())


def test_nothing_is_scored(empty):
    assert quality.score_quality(empty, quality.train(np.zeros((0, len(quality.FEATURES))), np.zeros(0), np.zeros(0))).count() == 0
    assert toxicity.score_toxicity(empty, toxicity.train([], np.zeros(0, np.int64))).count() == 0


def test_language_by_every_letter_of_a_long_run(spark):
    random_ = random.Random(2)
    text = lambda low, n: "".join(chr(low + random_.randrange(60)) for _ in range(n))
    rows = [(k, text(0x4E00, 45) + text(0x5E00 if k % 2 else 0x6E00, 300), "ba"[k % 2]) for k in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(docs.filter("doc_id < 60"))
    got, _ = model.predict(pa.array([t for _, t, _ in rows[60:]]))
    assert got == [x for _, _, x in rows[60:]]
    runs, owner = language.letter_runs(pa.array(["ab1c", "x" * 39 + "yzw", "d"]), 40, 4)
    assert runs.to_pylist() == ["ab", "c", "x" * 39 + "y", "xxxyzw", "d"] and owner.tolist() == [0, 0, 1, 1, 2]


def talk(lang, k, n):
    endings = {"en": ("ing", "tion"), "de": ("ung", "keit"), "fr": ("eaux", "ère")}[lang]
    random_ = random.Random(f"{lang}{k}")
    return " ".join(random_.choice(WORDS)[:2] + random_.choice("abcdefg") * random_.randint(1, 3) + random_.choice(endings) for _ in range(n))


def test_language_of_unseen_words(spark, odd):
    rows = [(k, talk(lang, k, 30), lang, "other") for k in range(90) for lang in [("en", "de", "fr")[k % 3]]]
    docs = spark.createDataFrame([*rows, (500, "zzz", None, None), (501, None, "en", None)], "doc_id long, text string, lang string, lang_pred string")
    model = language.fit(docs)
    assert model.languages == ["de", "en", "fr"]
    tests = [(k, talk(lang, k, 4), lang) for k in range(1000, 1060) for lang in [("en", "de", "fr")[k % 3]]]
    asked = spark.createDataFrame([*tests, (1, None, None), (2, "12 .. ", None), (3, "", None)], "doc_id long, text string, lang string")
    got = {r.doc_id: (r.lang_pred, r.score) for r in language.predict_language(asked, model).collect()}
    assert sum(got[k][0] == lang for k, _, lang in tests) >= 58
    assert {got[k] for k in (1, 2, 3)} == {("und", 0.0)}
    assert all(0 <= s <= 1 for _, s in got.values())
    assert language.predict_language(odd, model).count() == odd.count()


def test_known_words_come_first_then_longer_grams(spark):
    docs = spark.createDataFrame([(k, text, lang) for k in range(4) for text, lang in (("stone", "en"), ("strasse", "de"))], "doc_id long, text string, lang string")
    model = language.fit(docs)
    evidence = model.run_evidence(pa.array(["stone", "stones", "xq"]))
    at, known = model.words.rows(np.zeros(0, np.uint64))
    assert len(at) == len(known) == 0
    assert evidence[0].argmax() == model.languages.index("en")
    assert evidence[1].argmax() == model.languages.index("en")


def test_languages_that_nobody_taught(empty, odd):
    model = language.fit(empty)
    assert model.languages == [] and language.predict_language(empty, model).count() == 0
    assert {r.lang_pred for r in language.predict_language(odd, model).collect()} == {"und"}


@pytest.mark.parametrize("fit", [quality.fit, toxicity.fit])
def test_repeated_ids_are_learnt_from_once(spark, fit):
    docs, labels = tables(spark, corpus(200))
    again = docs.filter("doc_id < 20")
    for _ in range(3):
        again = again.unionByName(again)
    score = quality.score_quality if fit is quality.fit else toxicity.score_toxicity
    once, often = ({r.doc_id: r.score for r in score(docs, fit(d, labels)).collect()} for d in (docs, docs.unionByName(again).repartition(5)))
    assert once == often


def test_texts_too_long_to_learn_from_are_scored(spark):
    docs, labels = tables(spark, corpus(300))
    words = prose(7, 12_000)
    assert len(words) > toxicity.ToxicitySettings().longest_text
    long = spark.createDataFrame([(10_000, words + " worthless scum", "x"), (10_001, words, "x")], docs.schema)
    model = toxicity.fit(docs.unionByName(long), labels.unionByName(spark.createDataFrame([(10_000, 1, 0), (10_001, 1, 1)], labels.schema)))
    bad, fine = (r.score for r in toxicity.score_toxicity(long, model).orderBy("doc_id").collect())
    assert bad >= 0.5 > fine


def test_language_repeats_and_bounds(spark):
    rows = [(k, talk(lang, k, 10), lang) for k in range(60) for lang in [("en", "de", "fr")[k % 3]]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    once, often = (language.fit(d) for d in (docs, docs.unionByName(docs).unionByName(docs.filter("doc_id = 3"))))
    assert once.words.keys.tolist() == often.words.keys.tolist() and (once.words.values == often.words.values).all()
    few = language.fit(docs, language.LanguageSettings(most_words=5, least_count=1))
    assert 5 < len(few.words.keys) <= 15
    # A language with few texts keeps words of its own beside one with many.
    uneven = docs.filter("lang = 'en' OR doc_id = 1")
    words = language.fit(uneven, language.LanguageSettings(most_words=5, least_count=1)).words
    assert ((words.values - words.values.min(axis=0) > 0).sum(axis=0) >= 5).all()


def test_folds(spark):
    import zlib

    df = spark.createDataFrame([(k,) for k in (-7, 0, 1, 12345, None)], "doc_id long")
    got = {r.doc_id: r.h for r in df.select("doc_id", held_out_fold(df.doc_id, 5, 0).alias("h")).collect()}
    assert got == {k: True if k is None else zlib.crc32(str(k).encode()) % 5 == 0 for k in (-7, 0, 1, 12345, None)}
