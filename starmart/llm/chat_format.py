"""Conversations of many layouts to one chat text: the nested fields a record has pick the mapping that reads it.

A layout says which nested fields hold what. The paths a record has, of all that any layout names, are hashed; the hash is
looked up among the layouts' own. Fields that no layout names play no part. Layouts are read by DataFrame functions; chat
texts are written and parsed in Arrow batches, in one pass over a conversation's turns.
"""

from __future__ import annotations

import hashlib
import itertools
import re
from collections.abc import Iterable
from functools import reduce
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType, StructField, StructType

# fixed values: roles that some layouts name otherwise
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}

# fixed values: layouts with a list of turns: (list, field of the role, field of the text)
LISTS = {
    "messages": ("messages", "role", "content"),
    "messages_text": ("messages", "role", "text"),
    "turns": ("turns", "role", "text"),
    "conversations": ("conversations", "from", "value"),
}
# fixed values: layouts with a field a turn: (role, fields joined by an empty line), a field in brackets may be absent
FIELDS = {
    "prompt_response": [("system", ["[system]"]), ("user", ["prompt"]), ("assistant", ["response"])],
    "prompt_completion": [("system", ["[system]"]), ("user", ["prompt"]), ("assistant", ["completion"])],
    "instruction": [("system", ["[system]"]), ("user", ["instruction", "[input]"]), ("assistant", ["output"])],
    "question_answer": [("system", ["[system]"]), ("user", ["question"]), ("assistant", ["answer"])],
}
#: layout of a table with one row for each turn
ROWS = ("conv_id", "role", "text", "turn")

TURNS = "array<struct<role:string,text:string>>"


def fingerprint(paths: Iterable[str]) -> str:
    """Hash of a set of field paths, such as ``messages``, ``messages[].role``."""
    return hashlib.md5("\n".join(sorted(set(paths))).encode()).hexdigest()


def _layout_paths() -> dict[str, list[tuple[str, ...]]]:
    """Each layout's sets of paths, one for each choice of fields that may be absent."""
    found: dict[str, list[tuple[str, ...]]] = {}
    for name, (items, role, text) in LISTS.items():
        found[name] = [(items, f"{items}[].{role}", f"{items}[].{text}")]
    found["messages"].append(("messages",))  # a list without turns
    for name, turns in FIELDS.items():
        fields = [f for _, parts in turns for f in parts]
        needed, free = [f for f in fields if f[0] != "["], [f[1:-1] for f in fields if f[0] == "["]
        found[name] = [tuple(needed + list(some)) for n in range(len(free) + 1) for some in itertools.combinations(free, n)]
    return found


LAYOUTS = _layout_paths()
BY_FINGERPRINT = {fingerprint(paths): name for name, sets in LAYOUTS.items() for paths in sets}
PATHS = sorted({p for sets in LAYOUTS.values() for paths in sets for p in paths})


def _place(path: str) -> str:
    """Where a variant has it; of a list, the first element tells."""
    return "$." + path.replace("[]", "[0]")


def record_fingerprint(record: Column) -> Column:
    """Hash of the paths that a variant has, of those that layouts name. A field that is null is there."""
    own = [F.when(F.try_variant_get(record, _place(p), "variant").isNotNull(), F.lit(p)) for p in PATHS]
    return F.md5(F.concat_ws("\n", *own))


def _turn(role: Column, text: Column) -> Column:
    return F.struct(F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text"))


def _named_alike(role: Column) -> Column:
    known = reduce(lambda out, pair: out.when(F.lower(role) == pair[0], F.lit(pair[1])), ROLES.items(), F.when(F.lit(False), F.lit("")))
    return F.coalesce(known, role)


def _mapped(name: str, record: Column) -> Column:
    """The turns of a record of this layout."""
    get = lambda value, path: F.try_variant_get(value, f"$.{path}", "string")
    if name in LISTS:
        items, role, text = LISTS[name]
        return F.transform(F.try_variant_get(record, f"$.{items}", "array<variant>"), lambda turn: _turn(_named_alike(get(turn, role)), get(turn, text))).cast(TURNS)
    turns = []
    for role, fields in FIELDS[name]:
        texts = [get(record, f.strip("[]")) for f in fields]
        texts = [F.nullif(t, F.lit("")) if f[0] == "[" else t for t, f in zip(texts, fields, strict=True)]
        turn = _turn(F.lit(role), F.concat_ws("\n\n", *texts))
        turns.append(F.when(texts[0].isNotNull(), turn) if fields[0][0] == "[" else turn)
    return F.filter(F.array(*turns), lambda turn: turn.isNotNull()).cast(TURNS)


def canonical_records(records: DataFrame, record: str = "record", conv_id: str = "conv_id") -> DataFrame:
    """conv_id, layout, turns (role, text) of records with a whole conversation each, as JSON text or as a variant.

    A record that is no JSON or fits no layout keeps its row, with layout and turns null. Null texts are empty, roles are
    named alike (`ROLES`; those of a table with a row a turn stay as they are), a system turn or input that is absent or empty is left out. Rows are read each by itself, so ids
    may be null or repeated.
    """
    value = F.col(record) if dict(records.dtypes)[record] == "variant" else F.try_parse_json(F.col(record))
    rows = records.select(F.col(conv_id).alias("conv_id"), value.alias("record"))
    rows = rows.select("conv_id", "record", record_fingerprint(F.col("record")).alias("print"))
    layout = reduce(lambda out, pair: out.when(F.col("print") == pair[0], F.lit(pair[1])), BY_FINGERPRINT.items(), F.when(F.lit(False), F.lit("")))
    rows = rows.select("conv_id", "record", layout.alias("layout"))
    turns = reduce(lambda out, name: out.when(F.col("layout") == name, _mapped(name, F.col("record"))), LAYOUTS, F.when(F.lit(False), F.lit(None).cast(TURNS)))
    return rows.select("conv_id", "layout", turns.alias("turns"))


def canonical_rows(rows: DataFrame) -> DataFrame:
    """conv_id, layout, turns of a table with one row a turn, in order of turn.

    Turns without a number come first; rows of one number are put in order of role and text, repeated rows stay. Rows
    without conv_id make up one conversation. Null roles and texts are empty. A conversation is one row of the result, so it
    must fit in one, as its formatted text must.
    """
    turn = F.struct("turn", _turn(F.col("role"), F.col("text")).alias("said"))
    grouped = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    return grouped.select("conv_id", F.lit("rows").alias("layout"), F.transform("turns", lambda t: t["said"]).cast(TURNS).alias("turns"))


def canonical(table: DataFrame) -> DataFrame:
    """conv_id, layout, turns of a table, its columns telling the layout: one row for each turn, or one for each conversation."""
    if fingerprint(set(table.columns) & set(ROWS)) == fingerprint(ROWS):
        return canonical_rows(table)
    fields = [c for c in table.columns if c in {p.split("[")[0] for p in PATHS}]
    record = F.to_variant_object(F.struct(*[F.col(f"`{c}`") for c in fields])) if fields else F.lit(None).cast("variant")
    own = F.col("conv_id") if "conv_id" in table.columns else F.lit(None).cast("bigint")
    return canonical_records(table.select(own.alias("conv_id"), record.alias("record")))


# The chat text: "### role: text</turn>\n" for each turn. Inside texts a backslash is doubled, and one is put into each
# "### " and "</turn>" behind its first character, so neither string is left there. Roles are URL-encoded.
BEGIN, END = "### ", "</turn>\n"
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)


def escaped(text: str) -> str:
    return text.replace("\\", "\\\\").replace(BEGIN, "#\\## ").replace("</turn>", "<\\/turn>")


def unescaped(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def chat_text(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The chat text of (role, text) turns, and the spans of assistants' texts in it."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{BEGIN}{quote(role, safe='')}: ", escaped(text)
        if role == "assistant":
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, END]
        at += len(head) + len(body) + len(END)
    return "".join(parts), spans


def turns_in(text: str) -> list[tuple[str, str]]:
    """The (role, text) turns of a chat text."""
    found = []
    for piece in text.split(END)[:-1]:
        role, _, body = piece.removeprefix(BEGIN).partition(": ")
        found.append((unquote(role), unescaped(body)))
    return found


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
_TURNS = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))


def _structs(rows: list[list[tuple]], kind: pa.ListType) -> pa.Array:
    names = [f.name for f in kind.value_type]
    return pa.array([[dict(zip(names, x, strict=True)) for x in row] for row in rows], kind)


def _format_batches(batches):
    for batch in batches:
        turns = [[(t["role"], t["text"]) for t in row or []] for row in batch.column("turns").to_pylist()]
        made = [chat_text(row) for row in turns]
        columns = [batch.column("conv_id"), batch.column("layout"), pa.array([t for t, _ in made], pa.string()), _structs([s for _, s in made], _SPANS)]
        yield pa.RecordBatch.from_arrays(columns, ["conv_id", "layout", "formatted", "loss_spans"])


def _read_batches(batches):
    for batch in batches:
        texts, spans = batch.column("formatted").to_pylist(), batch.column("loss_spans").to_pylist()
        turns = _structs([turns_in(t) for t in texts], _TURNS)
        loss = pa.array([[unescaped(t[s["start"] : s["end"]]) for s in own] for t, own in zip(texts, spans, strict=True)], pa.list_(pa.string()))
        yield pa.RecordBatch.from_arrays([*batch.columns, turns, loss], [*batch.schema.names, "turns", "loss"])


def format_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, layout, formatted, loss_spans: the chat text, and where in it (code points, end exclusive) assistants' texts lie.

    Input as `canonical` gives it; turns that are null (no layout) format to an empty text without spans.
    """
    own = StructType([conversations.schema["conv_id"], StructField("layout", StringType()), StructField("formatted", StringType())])
    own = own.add("loss_spans", DataType.fromDDL("array<struct<start:bigint,end:bigint>>"))
    return conversations.select("conv_id", "layout", "turns").mapInArrow(_format_batches, own)


def read_back(formatted: DataFrame) -> DataFrame:
    """What `format_turns` gives, with ``turns`` (role, text) parsed from the chat text and ``loss`` (texts under the spans)."""
    own = StructType(list(formatted.schema)).add("turns", DataType.fromDDL(TURNS)).add("loss", DataType.fromDDL("array<string>"))
    return formatted.mapInArrow(_read_batches, own)
