"""Operator 8: token counts of fields and sections, attributed by character offsets.

A document's fields are joined to one text and encoded once. Each token has a span of characters; spans are joined with those
of the sections, and a token that crosses a boundary goes where a rule puts it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

FIELDS = ("source", "lang", "text")
SECTIONED = "text"  # this field has a section for each line, line end included; the others are one section each
SEPARATOR = "\n"
RULES = ("most", "first")  # the section holding most of a token's characters (ties: the earlier), or its first one
COUNTED = "doc_id long, field string, section int, start int, end int, n_tokens long, n_crossing long"


def character_spans(text: bytes, token_bytes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First character and end of each token, given the tokens' lengths in bytes.

    A token that begins or ends inside a character covers that character.
    """
    character = np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80) - 1
    ends = np.cumsum(token_bytes)
    return character[ends - token_bytes], character[ends - 1] + 1


def attribute(first: np.ndarray, end: np.ndarray, bounds: np.ndarray, rule: str = "most") -> tuple[np.ndarray, np.ndarray]:
    """Section of each token and whether it crosses a boundary; sections lie between neighbouring ``bounds``."""
    section = np.searchsorted(bounds, first, "right") - 1
    last = np.searchsorted(bounds, end - 1, "right") - 1
    crossing = section != last
    if rule == "most":
        for token in np.flatnonzero(crossing).tolist():
            edges = bounds[section[token] : last[token] + 2].clip(first[token], end[token])
            section[token] += int(np.argmax(np.diff(edges)))
    return section, crossing


def _sections(values: list[str | None]) -> tuple[str, list[tuple[int, int]], list[int]]:
    """The joined text, (field, number) of each section, and the sections' bounds; a separator belongs to the field before it."""
    parts, names, bounds, at = [], [], [], 0
    for field, value in enumerate(values):
        value = (value or "") + (SEPARATOR if field < len(values) - 1 else "")
        pieces = value.split("\n")
        lines = [piece + "\n" for piece in pieces[:-1]] + ([pieces[-1]] if pieces[-1] else [])
        cut = lines if FIELDS[field] == SECTIONED else [value]
        for number, piece in enumerate(cut or [""]):
            names.append((field, number))
            bounds.append(at)
            at += len(piece)
        parts.append(value)
    return "".join(parts), names, [*bounds, at]


def count_tokens(docs: DataFrame, ranks: dict[bytes, int], pattern: str, rule: str = "most") -> DataFrame:
    """A row per section of each row of ``docs``: its field, number, character range in the joined text, the tokens that it got and
    how many of them crossed a boundary.

    ``docs`` needs doc_id and ``FIELDS``. Null fields count as empty; every field has at least one section, so a document
    without any text still has rows. The counts of a document add up to its tokens. Special tokens are ordinary
    text. Repeated rows are counted alike; an empty table gives no rows.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    shared = docs.sparkSession.sparkContext.broadcast((ranks, pattern))  # as large as the rank file

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = None
        for batch in batches:
            if encode is None:
                import tiktoken

                ranks, pattern = shared.value
                encode = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
                size = np.zeros(max(ranks.values()) + 1, np.int64)
                size[list(ranks.values())] = [len(token) for token in ranks]
            for low in range(0, len(batch), 500):
                yield _counted(batch.slice(low, 500), encode, size, rule)

    return docs.select("doc_id", *FIELDS).mapInArrow(run, COUNTED)


def _counted(batch: pa.RecordBatch, encode, size: np.ndarray, rule: str) -> pa.RecordBatch:
    ids, *fields = (column.to_pylist() for column in batch.columns)
    owner, field, section, start, end, tokens, crossed = ([] for _ in range(7))
    for doc_id, *values in zip(ids, *fields):
        text, names, bounds = _sections(values)
        bounds, n = np.array(bounds), len(names)
        found = size[np.array(encode(text), np.int64)]
        count, crossing = np.zeros(n, np.int64), np.zeros(n, np.int64)
        if len(found):
            first, last = character_spans(text.encode(), found)
            own, crosses = attribute(first, last, bounds, rule)
            count, crossing = np.bincount(own, minlength=n), np.bincount(own[crosses], minlength=n)
        owner += [doc_id] * n
        field += [FIELDS[f] for f, _ in names]
        section += [number for _, number in names]
        start += bounds[:-1].tolist()
        end += bounds[1:].tolist()
        tokens += count.tolist()
        crossed += crossing.tolist()
    kinds = (pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64())
    columns = (owner, field, section, start, end, tokens, crossed)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, kinds)], ["doc_id", "field", "section", "start", "end", "n_tokens", "n_crossing"]
    )
