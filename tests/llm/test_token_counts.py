import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import SentencePieceProcessor
from texts import prose

from skyledger.llm import queries
from skyledger.llm.token_counts import (
    VOCABULARY,
    LengthTable,
    TokenCounter,
    count_tokens,
    frequent_lengths,
    word_hashes,
)
from skyledger.llm.tokens import vocabulary_path

PATH = vocabulary_path(VOCABULARY)
COUNTER = TokenCounter(PATH)
PLAIN = SentencePieceProcessor(model_file=PATH)
ODD = ["", " ", "  ", "a ", " a", "a  b", "a   b  ", "\n", "a\n b", "\t \t", "a▁b", " ▁ ", "▁", "<s> x </s> <unk>", "<0x0A>", "\x00a", "中文 文", "a　b\xa0c", "x" * 3000, "½ ﬁ é", "\U0001f600 \U0001f600", "1234 56"]


def counts(texts, table=None, counter=None):
    return (counter or COUNTER).count(pa.array(texts, pa.string()), table).tolist()


def whole(texts):
    return [len(PLAIN.encode(t or "")) for t in texts]


def test_odd_texts_as_the_tokenizer_counts_them():
    assert COUNTER.cuts
    assert counts([*ODD, None]) == whole([*ODD, None])
    assert counts([]) == []


@given(st.lists(st.text(st.sampled_from(" ▁ab\n\t1.é中<s>/")) | st.text(max_size=20), max_size=8))
@settings(max_examples=300, deadline=None)
def test_any_text(texts):
    assert counts(texts, LengthTable(["a", "b", " a", "ab"], whole(["a", "b", " a", "ab"]))) == whole(texts)


def test_a_small_cache_changes_nothing():
    texts = [prose(k, 50) for k in range(20)]
    small = TokenCounter(PATH, cached=7)
    for _ in range(2):
        assert counts(texts, counter=small) == whole(texts)
    assert len(small._recent) <= 7 and len(small._older) <= 7


def test_words_of_one_hash_are_told_apart(monkeypatch):
    from skyledger.llm import token_counts

    monkeypatch.setattr(token_counts, "word_hashes", lambda words: word_hashes(words) & 3)
    words = [f"w{k}" for k in range(60)]
    table = LengthTable(words[:40], list(range(40)))
    assert table.lookup(pa.array(words)).tolist() == [*range(40), *[-1] * 20]


def test_an_empty_table():
    assert LengthTable([], []).lookup(pa.array(["a", ""])).tolist() == [-1, -1]
    assert LengthTable(["", "a"], [0, 1]).lookup(pa.array(["", "b", "a"])).tolist() == [0, -1, 1]


def test_odd_rows(odd, odd_rows):
    got = sorted(((r.doc_id, r.n_bytes, r.n_tokens) for r in count_tokens(odd).collect()), key=repr)
    assert got == sorted(((r[0], len((r[1] or "").encode()), *whole([r[1]])) for r in odd_rows), key=repr)


def test_nothing(empty):
    assert count_tokens(empty).collect() == []


def test_the_table_holds_frequent_words(spark):
    docs = spark.createDataFrame([(k, "often often seldom%d" % k) for k in range(50)], "doc_id long, text string")
    table = frequent_lengths(docs, PATH, entries=1)
    assert table.words.to_pylist() == ["often"] and table.lengths.tolist() == whole(["often"])


@pytest.mark.parametrize("sf", ["sf0.01"])
def test_whole_table(spark, sf):
    folder = f"/root/testdata/{sf}"
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in queries.op13_token_counts(spark, folder).collect()}
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    assert got == {d.doc_id: (len((d.text or "").encode()), n, n > 4096) for d in docs for n in whole([d.text])}


def test_no_shuffle(spark, odd, capsys):
    count_tokens(odd.coalesce(1)).explain()
    assert "Exchange" not in capsys.readouterr().out.replace("Exchange RoundRobin", "").replace("REPARTITION_BY_NUM", "")
