"""Chat records of different layouts as canonical turns, and their training text.

The layout of a record is told by the hash of its nested field paths. A layout
has a declared mapping, which says where the turns are; there is no guessing.
Paths that no mapping names, such as an id or a source, are no part of a layout.

Training text: each turn is ``### Role: text</turn>`` and a line end. Texts and
roles are escaped so that no control string of the template can be read out of
them, and so that unescaping gives back what was there. The loss mask covers
the texts of the assistant, and nothing else.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .batches import in_rows, key_runs, text_slices

OPEN, SAYS, CLOSE = "### ", ": ", "</turn>\n"
ASSISTANT = "assistant"
_TURN = re.compile(r"### ((?:[^\\:]++|\\.)*+): ((?:[^\\<]++|\\.|<(?!/turn>))*+)</turn>\n", re.DOTALL)
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)


@dataclass(frozen=True)
class Mapping:
    """Where a layout keeps its turns.

    ``turns``: path of the list of turns with the fields of role and text; or
    ``fields``: pairs of a role and the fields whose texts, where present, make
    up its turn, joined by an empty line. ``role_names`` renames roles.
    """

    paths: tuple[str, ...]
    turns: tuple[str, str, str] | None = None
    fields: tuple[tuple[str, tuple[str, ...]], ...] = ()
    role_names: tuple[tuple[str, str], ...] = (("human", "user"), ("gpt", "assistant"), ("bot", "assistant"), ("model", "assistant"))


MAPPINGS = (
    Mapping(("prompt", "completion"), fields=(("user", ("prompt",)), ("assistant", ("completion",)))),
    Mapping(("prompt", "response"), fields=(("user", ("prompt",)), ("assistant", ("response",)))),
    Mapping(("question", "answer"), fields=(("user", ("question",)), ("assistant", ("answer",)))),
    Mapping(("instruction", "output"), fields=(("user", ("instruction",)), ("assistant", ("output",)))),
    Mapping(("instruction", "input", "output"), fields=(("user", ("instruction", "input")), ("assistant", ("output",)))),
    Mapping(("system", "instruction", "input", "output"), fields=(("system", ("system",)), ("user", ("instruction", "input")), ("assistant", ("output",)))),
    Mapping(("system", "prompt", "response"), fields=(("system", ("system",)), ("user", ("prompt",)), ("assistant", ("response",)))),
    Mapping(("messages[].role", "messages[].content"), turns=("messages", "role", "content")),
    Mapping(("messages[].role", "messages[].text"), turns=("messages", "role", "text")),
    Mapping(("conversations[].from", "conversations[].value"), turns=("conversations", "from", "value")),
    Mapping(("data.dialog[].speaker", "data.dialog[].utterance"), turns=("data.dialog", "speaker", "utterance")),
    # A record that is a turn; its role is final.
    Mapping(("role", "text"), role_names=()),
)


def fingerprint(paths) -> str:
    """The hash of a set of field paths."""
    return hashlib.blake2b("\n".join(sorted(set(paths))).encode(), digest_size=8).hexdigest()


BY_FINGERPRINT = {fingerprint(m.paths): m for m in MAPPINGS}
#: The layout of records that are one turn each.
ONE_TURN = fingerprint(("role", "text"))
_NAMED = {p for m in MAPPINGS for p in m.paths}


def field_paths(value: object, prefix: str = "") -> set[str]:
    """Paths of all leaves: names joined by dots, ``[]`` after the name of a list. An empty list or object is a leaf."""
    if isinstance(value, dict) and value:
        return {p for k, v in value.items() for p in field_paths(v, f"{prefix}.{k}" if prefix else k)}
    if isinstance(value, list) and value:
        return {p for v in value for p in field_paths(v, f"{prefix}[]")}
    return {prefix}


def layout(paths: set[str]) -> set[str]:
    """Of these paths the ones that a mapping names, and what is below them."""
    return {p for p in paths if p in _NAMED or any(p.startswith((f"{n}.", f"{n}[]")) for n in _NAMED)}


def turns_of(record: str | None) -> tuple[str | None, list[tuple[str, str]] | None]:
    """The fingerprint of a JSON record and its turns; None where it is no JSON object or its layout is not declared.

    The fingerprint is that of the layout, and of all paths where that is not declared.
    """
    try:
        found = json.loads(record or "")
    except ValueError:
        return None, None
    if not isinstance(found, dict):
        return None, None
    paths = field_paths(found)
    name = fingerprint(layout(paths))
    mapping = BY_FINGERPRINT.get(name)
    if mapping is None:
        return fingerprint(paths), None
    names = dict(mapping.role_names)
    text = lambda v: "" if v is None else v if isinstance(v, str) else json.dumps(v, ensure_ascii=False)
    if mapping.turns:
        at, role, said = mapping.turns
        rows = found
        for step in at.split("."):
            rows = rows[step]
        return name, [(names.get(text(r.get(role)), text(r.get(role))), text(r.get(said))) for r in rows]
    if name == ONE_TURN:
        return name, [(names.get(text(found["role"]), text(found["role"])), text(found["text"]))]
    parts = [(role, [text(found[f]) for f in fields]) for role, fields in mapping.fields]
    return name, [(role, "\n\n".join(t for t in said if t)) for role, said in parts]


def canonical_turns(records: DataFrame, conv_id: str = "conv_id", record: str = "record", turn: str | None = None) -> DataFrame:
    """``conv_id, turn, role, text, fingerprint`` from JSON records of any declared layout.

    Turns are counted within a record. Where records are parts of a
    conversation, ``turn`` names the column with the place of each, and
    a record of several turns has no mapping, as its turns would share a place.

    A record that is null, no JSON object, or of a layout without a mapping
    gives one row with null role and text, so that nothing is lost unseen. A null
    role or text within a record is empty. Other columns are left out.
    """
    schema = pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("fingerprint", pa.string())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "record"):
            rows = []
            for conv, place, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                name, turns = turns_of(raw)
                if turns is None or (turn is not None and len(turns) != 1):
                    rows.append((conv, place, None, None, name))
                elif turn is not None:
                    rows.append((conv, place, *turns[0], name))
                else:
                    rows.extend((conv, k, role, said, name) for k, (role, said) in enumerate(turns))
            if rows:
                yield in_rows(dict(zip(schema.names, map(list, zip(*rows, strict=True)), strict=True)), schema)

    place = F.lit(None) if turn is None else F.col(turn)
    chosen = records.select(F.col(conv_id).cast("long").alias("conv_id"), place.cast("long").alias("turn"), F.col(record).cast("string").alias("record"))
    return chosen.mapInArrow(work, "conv_id long, turn long, role string, text string, fingerprint string")


def turn_records(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, record``: the rows of a table of turns as records, for ``canonical_turns``.

    Beside ``conv_id`` and ``turn``, the columns that a mapping names are the
    record, with their nulls; others are no part of any layout and are not
    written. Of a table with ``role`` and ``text`` these two are the record.
    """
    named = {p.split(".")[0].split("[]")[0] for p in _NAMED}
    fields = [c for c in rows.columns if c in named]
    if {"role", "text"} <= set(fields):
        fields = ["role", "text"]
    if not fields:
        raise ValueError(f"no mapping for a table with the columns {rows.columns}")
    return rows.select("conv_id", "turn", F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("record"))


def escaped(text: Column, *controls: str) -> Column:
    """A backslash before each backslash and before the first character of each control string."""
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for control in controls:
        text = F.replace(text, F.lit(control), F.lit("\\" + control))
    return text


def unescaped(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def formatted_turns(turns: DataFrame) -> DataFrame:
    """``conv_id, turn, formatted, mask_start, mask_end``: a row per turn, narrow and native.

    The text of a conversation is that of its rows in the order of ``turn``,
    null first, and of ``formatted`` where turns are equal. The mask is a range
    of code points of the row's text, null for other roles. Rows without a role,
    which stand for records without a mapping, have no text and are left out.
    """
    role = escaped(F.col("role"), ":", "#")
    said = escaped(F.col("text"), "#", "</turn>")
    start = F.length(role) + len(OPEN) + len(SAYS)
    learnt = F.col("role") == ASSISTANT
    return turns.filter(F.col("role").isNotNull()).select(
        "conv_id",
        "turn",
        F.concat(F.lit(OPEN), role, F.lit(SAYS), said, F.lit(CLOSE)).alias("formatted"),
        F.when(learnt, start).alias("mask_start"),
        F.when(learnt, start + F.length(said)).alias("mask_end"),
    )


def conversation_digests(formatted: DataFrame) -> DataFrame:
    """Per conversation, what can be read back from formatted turns and their loss masks.

    A conversation is read as a stream of rows in one task, as its digest must
    be; only one batch of rows is held, whatever its size. No rows give no
    rows; null is one conversation.
    """
    rows = formatted.repartition(F.col("conv_id")).sortWithinPartitions("conv_id", "turn", "formatted")
    rows = rows.select("conv_id", "formatted", "mask_start", "mask_end")
    schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, turns, said, n, chars, loss = None, None, None, 0, 0, 0
        for batch, starts, goes_on in key_runs(batches, ["conv_id"]):
            formatted, begins, ends = (batch.column(k).to_pylist() for k in (1, 2, 3))
            done = []
            for run, (a, b) in enumerate(zip(starts.tolist(), [*starts[1:].tolist(), batch.num_rows], strict=True)):
                if run or not goes_on:
                    if turns is not None:
                        done.append((conv, n, turns.hexdigest(), loss, said.hexdigest(), chars))
                    conv, turns, said, n, chars, loss = batch.column(0)[a].as_py(), hashlib.sha256(), hashlib.sha256(), 0, 0, 0
                for text, first, last in zip(formatted[a:b], begins[a:b], ends[a:b], strict=True):
                    at = 0
                    while at < len(text):
                        m = _TURN.match(text, at)
                        if m is None:
                            raise ValueError("a formatted turn cannot be read back")
                        turns.update(f"{unescaped(m[1])}\n{unescaped(m[2])}\n".encode())
                        n, at = n + 1, m.end()
                    if first is not None:
                        learnt = unescaped(text[first:last])
                        loss += len(learnt)
                        said.update(learnt.encode())
                    chars += len(text)
            if done:
                yield in_rows(dict(zip(schema.names, map(list, zip(*done, strict=True)), strict=True)), schema)
        if turns is not None:
            yield in_rows(dict(zip(schema.names, ([x] for x in (conv, n, turns.hexdigest(), loss, said.hexdigest(), chars)), strict=True)), schema)

    return rows.mapInArrow(work, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
