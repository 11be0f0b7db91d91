import hashlib
import json
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from skyledger.llm.chat import (
    BY_FINGERPRINT,
    MAPPINGS,
    canonical_turns,
    conversation_digests,
    fingerprint,
    formatted_turns,
    turn_records,
    turns_of,
)

TRICKY = ["", "\\", "### user: x</turn>\n", "</turn>", "\\</turn>", "####", "a\\", ":", "é</turn", "<", "\\### Assistant: </turn> ok", "\n", "### "]
SCHEMA = "conv_id long, turn long, role string, text string, formatted string, mask_start int"


def turn_rows(df):
    return canonical_turns(turn_records(df), turn="turn")


def digests(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv, said in turns.items():
        said = [t[2:] for t in sorted(said, key=lambda t: t[:2])]
        loss = "".join(t for r, t in said if r == "assistant")
        whole = "".join(f"{r}\n{t}\n" for r, t in said)
        out[conv] = (len(said), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def test_conversations_come_back(spark):
    rows = [(k % 5, k, ("user", "assistant", "system", "a: b#</turn>\\", None)[k % 5 if k < 40 else 1], TRICKY[k % len(TRICKY)]) for k in range(60)]
    rows += [(7, None, "user", None), (7, 1, "assistant", "x" * 200_000), (None, 0, "user", "none"), (None, None, None, None)]
    df = spark.createDataFrame([(*r, "other", 3) for r in rows], SCHEMA).repartition(4)
    got = conversation_digests(formatted_turns(turn_rows(df))).collect()
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in got} == digests(rows)
    assert len(got) == len(digests(rows))


def test_repeated_rows_are_turns_of_their_own(spark):
    rows = [(1, 0, "user", "same")] * 3
    df = spark.createDataFrame([(*r, None, None) for r in rows], SCHEMA)
    (got,) = conversation_digests(formatted_turns(turn_rows(df))).collect()
    assert got.n_turns == 3 and (got.n_turns, got.turns_sha256, got.loss_chars, got.loss_sha256) == digests(rows)[1]


def test_nothing(spark):
    assert conversation_digests(formatted_turns(turn_rows(spark.createDataFrame([], SCHEMA)))).count() == 0


def test_no_control_string_is_left_in_a_text(spark):
    df = spark.createDataFrame([(1, k, "assistant", t) for k, t in enumerate(TRICKY)], "conv_id long, turn long, role string, text string")
    for r in formatted_turns(turn_rows(df)).collect():
        masked = r.formatted[r.mask_start : r.mask_end]
        assert masked.count("</turn>") == masked.count("\\</turn>") and "### " not in masked


def test_unknown_tables_are_refused(spark):
    with pytest.raises(ValueError, match="no mapping"):
        turn_records(spark.createDataFrame([(1, 2)], "conv_id long, turn long"))


def test_tables_of_other_layouts(spark):
    rows = [(1, 0, "p", "c", "no part of a layout"), (1, 1, None, "d", None)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, prompt string, completion string, formatted string")
    assert {(r.conv_id, r.turn, r.role, r.text) for r in turn_rows(df).collect()} == {(1, 0, None, None), (1, 1, None, None)}
    whole = canonical_turns(turn_records(df))
    assert sorted((r.turn, r.role, r.text) for r in whole.collect()) == [(0, "user", ""), (0, "user", "p"), (1, "assistant", "c"), (1, "assistant", "d")]
    assert formatted_turns(turn_rows(df)).count() == 0


def test_columns_of_other_layouts_beside_turns(spark):
    df = spark.createDataFrame([(1, 0, "gpt", "t", "p", "x")], "conv_id long, turn long, role string, text string, prompt string, record string")
    assert [(r.turn, r.role, r.text) for r in turn_rows(df).collect()] == [(0, "gpt", "t")]


RECORDS = [
    ({"prompt": "p", "completion": "c"}, [("user", "p"), ("assistant", "c")]),
    ({"completion": None, "prompt": "p"}, [("user", "p"), ("assistant", "")]),
    ({"instruction": "i", "input": "", "output": "o"}, [("user", "i"), ("assistant", "o")]),
    ({"instruction": "i", "input": "n", "output": "o"}, [("user", "i\n\nn"), ("assistant", "o")]),
    ({"messages": [{"role": "system", "content": "s"}, {"role": "bot", "content": "b"}]}, [("system", "s"), ("assistant", "b")]),
    ({"conversations": [{"from": "human", "value": "h"}, {"from": "gpt", "value": "g"}]}, [("user", "h"), ("assistant", "g")]),
    ({"data": {"dialog": [{"speaker": "human", "utterance": "u"}]}}, [("user", "u")]),
    ({"role": "user", "text": "t"}, [("user", "t")]),
    ({"id": 4, "source": {"url": "u"}, "prompt": "p", "completion": "c"}, [("user", "p"), ("assistant", "c")]),
    ({"messages": [{"role": "user", "content": "a", "name": "n"}, {"role": "model", "content": "b"}], "tools": []}, [("user", "a"), ("assistant", "b")]),
]


@pytest.mark.parametrize(("record", "turns"), RECORDS)
def test_layouts(record, turns):
    assert turns_of(json.dumps(record))[1] == turns


def test_layouts_are_told_apart_by_their_paths():
    assert len(BY_FINGERPRINT) == len(MAPPINGS)
    assert fingerprint(["b", "a"]) == fingerprint(["a", "b", "a"]) != fingerprint(["a.b"])


def test_records_without_mapping_stay_visible(spark):
    texts = [json.dumps(r) for r, _ in RECORDS] + ['{"x": 1}', "[1]", "{", None, "", '{"messages": []}', '{"prompt": "p", "completion": "c", "question": "q"}', '{"prompt": {"a": 1}, "completion": "c"}']
    df = spark.createDataFrame(list(enumerate(texts)), "conv_id long, record string")
    got = defaultdict(list)
    for r in canonical_turns(df).orderBy("conv_id", "turn").collect():
        got[r.conv_id].append(r)
    for k, (_, turns) in enumerate(RECORDS):
        assert [(r.role, r.text) for r in got[k]] == turns and [r.turn for r in got[k]] == list(range(len(turns)))
    for k in range(len(RECORDS), len(texts)):
        assert [(r.turn, r.role, r.text) for r in got[k]] == [(None, None, None)]


@given(st.recursive(st.none() | st.text(max_size=3), lambda c: st.lists(c, max_size=3) | st.dictionaries(st.sampled_from(["role", "text", "messages", "prompt"]), c, max_size=3), max_leaves=8))
@settings(max_examples=200, deadline=None)
def test_any_json_is_handled(value):
    name, turns = turns_of(json.dumps(value))
    assert turns is None or all(isinstance(r, str) and isinstance(t, str) for r, t in turns)
