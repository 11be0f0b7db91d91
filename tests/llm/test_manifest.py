import hashlib
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from skyledger.llm import queries
from skyledger.llm.manifest import document_manifest, folded, manifest

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row, more=0):
    values = [row["doc_id"], row["source"], row["lang"], row["n_chars"] if row["n_chars"] is None else row["n_chars"] + more, row["text"]]
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def tree(nodes, fan):
    """The root, and of each node the others of its run, level by level as (left, right)."""
    ways, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[i : i + fan] for i in range(0, len(nodes), fan)]
        for k, i in enumerate(at):
            run, slot = runs[i // fan], i % fan
            ways[k].append(("".join(run[:slot]), "".join(run[slot + 1 :])))
            at[k] = i // fan
        nodes = [h(*run) for run in runs]
    return nodes[0], ways


def brute(rows, fan=2):
    groups = defaultdict(list)
    for row in rows:
        groups[row["lang"]].append((row["doc_id"] is not None, row["doc_id"] or 0, leaf_of(row), row))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for name in names:
        groups[name].sort(key=lambda r: r[:3])
        trees[name] = tree([r[2] for r in groups[name]], fan)
    root, over = tree([trees[n][0] for n in names], fan)
    out = []
    for name, way in zip(names, over, strict=True):
        for (_, _, leaf, row), own in zip(groups[name], trees[name][1], strict=True):
            proof = own + way
            hit = row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 7 == 0
            node = leaf_of(row, 1) if hit else leaf
            for left, right in proof:
                node = h(left, node, right)
            out.append((row["doc_id"], leaf, trees[name][0], root, h(*[left + right for left, right in proof]), node, node == root))
    return sorted(out, key=repr)


def rows_of(df):
    return [r.asDict() for r in df.select(*COLUMNS).collect()]


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_odd_rows(odd):
    assert got(document_manifest(odd)) == brute(rows_of(odd))


def test_nothing_and_one_row(spark, empty, odd):
    assert document_manifest(empty).collect() == []
    one = odd.filter("doc_id = 5")
    (r,) = document_manifest(one).collect()
    assert r.leaf == r.subroot == r.root == r.folded_root and r.verified and r.proof_sha256 == h()


def docs(spark, sizes):
    langs = [None, "", "z", "é", "e", "="]
    rows = [(k, f"text {k}" if k % 5 else None, langs[g % len(langs)], "s" if k % 3 else None, k if k % 11 else None) for g, n in enumerate(sizes) for k in range(g * 10_000, g * 10_000 + n)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(5)


@pytest.mark.parametrize(("fan", "levels"), [(2, 2), (2, 3), (3, 2), (5, 1)])
def test_many_blocks_and_fans(spark, fan, levels):
    df = docs(spark, [1, 2, 9, 33, 64, 65])
    found = manifest(df, fan=fan, levels=levels, extra={"again": F.col("doc_id")})
    rows = {r.doc_id: r for r in found.withColumn("fold", folded(F.col("leaf"), F.col("proof"))).collect()}
    for doc_id, leaf, subroot, root, siblings, _, _ in brute(rows_of(df), fan):
        r = rows.pop(doc_id)
        assert (r.leaf, r.subroot, r.root, r.again) == (leaf, subroot, root, doc_id)
        assert h(*[s.left + s.right for s in r.proof]) == siblings and r.fold == root
    assert not rows


def test_hot_copies_are_leaves_of_their_own(spark):
    df = spark.createDataFrame([(1, "same", "en", "s", 4)] * 700 + [(k, "t", "en", None, 1) for k in range(20)], "doc_id long, text string, lang string, source string, n_chars long")
    assert got(document_manifest(df)) == brute(rows_of(df))


def test_the_largest_number(spark):
    top = (1 << 63) - 1
    df = spark.createDataFrame([(k, "t", "en", "s", top) for k in range(40)], "doc_id long, text string, lang string, source string, n_chars long")
    assert got(document_manifest(df)) == brute(rows_of(df))


def test_no_window_spans_a_group(spark, capsys):
    document_manifest(docs(spark, [30])).explain()
    plan = capsys.readouterr().out
    assert "hashpartitioning(tree" in plan and "SinglePartition" not in plan


def test_whole_table(spark):
    folder = "/root/testdata/sf0.01"
    found = queries.op12_manifest(spark, folder)
    assert got(found) == brute(rows_of(spark.read.parquet(f"{folder}/documents.parquet")))
    assert 0 < found.filter(~F.col("verified")).count() < 300
