"""Operator 5: conversations rendered by a compiled template, with marks on what a model shall learn to say."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from weftloom.llm import template

START, END = "<|im_start|>", "<|im_end|>"
CHATML = (
    "{% for message in messages %}"
    "{{ '<|im_start|>' + (message.role | one_line) + '\\n' }}"
    "{% if message.role == 'assistant' %}{% generation %}{{ message.content | guard }}{% endgeneration %}"
    "{% else %}{{ message.content | guard }}{% endif %}"
    "{{ '<|im_end|>\\n' }}{% endfor %}"
)
PART_CHARS = 1_000_000  # a longer conversation is returned in several parts, cut between pieces
_ROWS = 1000


def guard(text: str | None) -> str:
    """Make control strings harmless: ``<|`` gets a backslash inside, one more than there is."""
    return re.sub(r"<(\\*)\|", r"<\1\\|", text or "")


def unguard(text: str) -> str:
    return re.sub(r"<(\\*)\\\|", r"<\1|", text)


def one_line(text: str | None) -> str:
    return guard(text).replace("\\", "\\\\").replace("\n", "\\n")


def whole_lines(text: str) -> str:
    return unguard(re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], text))


FILTERS = template.FILTERS | {"guard": guard, "one_line": one_line}
FORMATTED = "conv_id long, part int, formatted string, spans array<struct<start:int,end:int>>"


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for start in range(0, len(batch), _ROWS):
            yield from zip(*(c.to_pylist() for c in batch.slice(start, _ROWS).columns))


def _batched(rows: Iterator[tuple], schema: pa.Schema, size=lambda row: 0) -> Iterator[pa.RecordBatch]:
    held, total = [], 0
    for row in rows:
        held.append(row)
        total += size(row)
        if len(held) >= _ROWS or total >= 4 * PART_CHARS:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, total = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def format_conversations(turns: DataFrame, source: str = CHATML) -> DataFrame:
    """Render ``turns(conv_id, turn, role, text)``: rows ``(conv_id, part, formatted, spans)``.

    Turns follow each other by ``turn``, then role and text, null first. ``spans`` are the code-point ranges of the part that
    come from generation blocks. Null roles and texts count as empty; rows without a conv_id make up one conversation with a
    null id; an empty table gives no rows. Turns stream through the template, so a conversation of any length
    takes the memory of a part and a turn; its parts come in order and next to each other in one partition.
    """
    ordered = turns.select("conv_id", "turn", "role", "text").repartition("conv_id").sortWithinPartitions(
        "conv_id", "turn", "role", "text"
    ).select("conv_id", "role", "text")
    schema = pa.schema([
        ("conv_id", pa.int64()), ("part", pa.int32()), ("formatted", pa.string()),
        ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
    ])

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        render = template.compile_template(source, FILTERS)
        for conv_id, rows in groupby(_rows(batches), key=itemgetter(0)):
            messages = ({"role": role or "", "content": text or ""} for _, role, text in rows)
            part, at, held, spans = 0, 0, [], []
            for text, marked in render({"messages": messages}):
                if at and at + len(text) > PART_CHARS:
                    yield conv_id, part, "".join(held), spans
                    part, at, held, spans = part + 1, 0, [], []
                held.append(text)
                if marked:
                    spans.append({"start": at, "end": at + len(text)})
                at += len(text)
            yield conv_id, part, "".join(held), spans

    return ordered.mapInArrow(lambda batches: _batched(parts(batches), schema, lambda row: len(row[2])), FORMATTED)


READ = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
)


def read_back(formatted: DataFrame) -> DataFrame:
    """Parse the output of ``format_conversations`` with the standard template again: counts and digests of turns and of the text under the marks.

    It must follow the formatting directly, whose partitions hold the parts of each conversation in order.
    """
    schema = pa.schema([
        (name, pa.string() if kind == "string" else pa.int64()) for name, kind in (x.split(" ") for x in READ.split(", "))
    ])

    def conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for conv_id, parts in groupby(_rows(batches), key=itemgetter(0)):
            turns, loss = hashlib.sha256(), hashlib.sha256()
            n_turns = loss_chars = chars = 0
            rest = ""
            for _, _, text, spans in parts:
                chars += len(text)
                for span in spans:
                    learned = unguard(text[span["start"] : span["end"]])
                    loss_chars += len(learned)
                    loss.update(learned.encode())
                *complete, rest = (rest + text).split(f"{END}\n")
                for turn in complete:
                    head, content = turn.removeprefix(START).split("\n", 1)
                    turns.update(f"{whole_lines(head)}\n{unguard(content)}\n".encode())
                    n_turns += 1
            yield conv_id, n_turns, turns.hexdigest(), loss_chars, loss.hexdigest(), chars

    return formatted.mapInArrow(lambda batches: _batched(conversations(batches), schema), READ)
