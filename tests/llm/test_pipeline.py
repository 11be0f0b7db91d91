import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from test_decontamination import brute_edits
from test_simhash import brute_components, brute_fingerprint
from texts import prose

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from skyledger.llm.credentials import base_spans
from skyledger.llm.tokens import PieceEncoder, vocabulary_path

ITEMS = [(k, prose(900 + k, 25)) for k in range(3)]


def rows():
    """Good and shouted documents, copies, one changed word in long ones, benchmark items and secrets."""
    random_ = random.Random(4)
    out = []
    for k in range(240):
        text = prose(k, 20 + k % 50)
        if k % 6 == 5:
            text = text.upper().replace(" ", "!! ")
        elif k % 12 == 0:
            text += " " + ITEMS[k % 3][1] + " end"
        elif k % 12 == 1:
            text += " password=" + "".join(random_.choice("0123456789abcdef") for _ in range(18)) + " end"
        out.append((k, text, "en", "s", len(text)))
    out += [(1000 + k, out[k][1], "en", "s", 0) for k in (2, 3, 4, 8)]
    return [*out, (2000, None, None, None, None), (2001, "", "en", "s", 0)]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(rows(), "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(k, int(k % 6 != 5), 0) for k in range(240)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(ITEMS, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_stages_one_by_one(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        out = str(tmp_path / name)
        stage(spark, docs, folder).write.parquet(out)
        docs = spark.read.parquet(out)
        kept[name] = docs.collect()
        if name != "best_fit_packing":
            assert docs.columns == columns
    texts = {r[0]: r[1] for r in rows()}
    # The shouted ones go, and nothing else that was labelled.
    accepted = {r.doc_id for r in kept["quality_classifier"]}
    assert {k for k in range(240) if k % 6 != 5} <= accepted and not accepted & set(range(5, 240, 6))
    # Of each component the smallest id stays.
    ids = sorted(accepted)
    root = brute_components([brute_fingerprint(texts[k]) for k in ids])
    first = {}
    for k, r in zip(ids, root, strict=True):
        first.setdefault(r, k)
    alone = {r.doc_id for r in kept["simhash_near_dedup"]}
    assert alone == set(first.values()) and not alone & {1002, 1003, 1004, 1008}
    # Documents with an item go.
    def leaks(text):
        return any(brute_edits(item.split(), (text or "").split()) <= int(0.2 * len(item.split())) for _, item in ITEMS)

    clean = {r.doc_id for r in kept["benchmark_decontamination"]}
    assert clean == {k for k in alone if not leaks(texts[k])}
    # Secrets are replaced, all else stays.
    final = {r.doc_id: r for r in kept["secret_scans"]}
    assert final.keys() == clean
    for k, r in final.items():
        assert not base_spans(r.text or "")
        assert r.n_chars == (None if r.text is None else len(r.text))
        if not base_spans(texts[k] or ""):
            assert r.text == texts[k]
        else:
            assert r.text.endswith("password=[assign] end")
    # Every id of what is left is packed once.
    encoder = PieceEncoder(vocabulary_path())
    whole = Counter()
    for k, r in final.items():
        tokens = [*encoder._tokenizer.encode(r.text or "", add_special_tokens=False).ids, 0]
        whole[k, zlib.crc32(np.array(tokens, "<u4").tobytes())] += 1
    assert Counter((p.doc_id, p.ids_crc32) for p in kept["best_fit_packing"]) == whole
    places = defaultdict(list)
    for p in kept["best_fit_packing"]:
        places[p.sequence_id].append((p.offset, p.length))
    assert all(sum(n for _, n in v) <= 2048 for v in places.values())


def test_run_is_the_stages_in_turn(spark, folder):
    assert corpus_pipeline.run(spark, folder).count() > 100
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_classifier", "simhash_near_dedup", "benchmark_decontamination", "secret_scans", "best_fit_packing"]


def test_a_corpus_of_nothing(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").filter("doc_id < -1")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
    assert docs.count() == 0


def test_all_operators_are_registered():
    names = queries()
    assert {int(n[2:].split("_")[0]) for n in names if n[:2] == "op" and n[2].isdigit()} == set(range(1, 14))
    assert "pipeline" in names and "pipeline" not in oracle_sql()


def test_odd_rows_go_through_all_stages(spark, folder):
    """A very long text, ids that are null, rows that occur twice, and columns named as the operators' own."""
    # In words of its own: the made-up prose repeats itself, and with it the items.
    long = " ".join(f"word{k * 7919 % 5003}x" for k in range(30_000))
    odd = [(3000, long), (None, prose(3, 40)), (None, None), (3001, prose(4001, 60)), (3001, prose(4001, 60)), (3002, " \n\t ")]
    schema = "doc_id long, text string, lang string, source string, n_chars long, _fp long, sequence_id string, score int, rank long, shared int"
    docs = spark.createDataFrame([(k, t, None, "s", None, 7, "q", 1, None, 2) for k, t in odd], schema).repartition(3)
    columns = docs.columns
    # What the classifier makes of such texts is its affair.
    accepted = corpus_pipeline.quality_classifier(spark, docs, folder)
    assert accepted.columns == columns and accepted.count() <= len(odd)
    for name, stage in corpus_pipeline.STAGES[1:-1]:
        docs = stage(spark, docs, folder)
        assert docs.columns == columns, name
    left = docs.collect()
    texts = Counter(r.text for r in left)
    assert texts[long] == 1 and all(r.sequence_id == "q" and r._fp == 7 for r in left)
    assert max(Counter(r.doc_id for r in left).values()) <= 2
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, folder).collect()
    encoder = PieceEncoder(vocabulary_path())
    total = sum(len(encoder._tokenizer.encode(r.text or "", add_special_tokens=False).ids) + 1 for r in left)
    assert sum(p.length for p in pieces) == total and max(p.length for p in pieces) == 2048
