"""Operator 4: scan texts for license notices by MinHash bands over overlapping windows, then exact containment.

A notice of up to C words (C a power of two) lies wholly in one of the windows of 2 C words that begin every C words. Its
shingles and the window's have at least a known Jaccard similarity, from which the bands are set so that the two
share a band with probability ``CERTAINTY`` or more. Whatever shares a band is then checked exactly.

A license has several templates: its notice, its usual wordings and its standard header or body. Where the templates of two
licenses differ in so few shingles that one's text would pass for the other (GPL 2 and 3, BSD with 2 and 3 clauses), these
shingles must be contained as well.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from weftloom.llm import words
from weftloom.llm.license_texts import WORDINGS

# Notices as their licenses or publishers word them.
NOTICES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "MIT": "Released under the MIT License",
    "GPL-3.0": "licensed under the GNU General Public License, version 3",
    "LGPL-3.0": "licensed under the GNU Lesser General Public License, version 3",
    "AGPL-3.0": "licensed under the GNU Affero General Public License, version 3",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "CC-BY-4.0": "Licensed under CC BY 4.0",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "CC-BY-ND-4.0": "Licensed under CC BY-ND 4.0",
    "MIT-permission": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
    "associated documentation files",
    "BSD-redistribution": "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
    "that the following conditions are met",
    "Apache-2.0-header": "you may not use this file except in compliance with the License",
    "all-rights-reserved": "All rights reserved. No part of this publication may be reproduced",
}
#: By license, all its templates.
TEMPLATES = {name: (*([NOTICES[name]] if name in NOTICES else []), *WORDINGS.get(name, ())) for name in {**NOTICES, **WORDINGS}}
SHINGLE_WORDS = 3
CONTAINED = 0.8
CERTAINTY = 0.999
_SLICE = 200_000  # words whose windows are hashed at once
FOUND = "doc_id long, license string, containment double, start int, end int"


def band_settings(jaccard: float, certainty: float = CERTAINTY, most: int = 128) -> tuple[int, int]:
    """(bands, rows): the most rows a band for which sets of this similarity share one with ``certainty``, within ``most`` values."""
    best = None
    for rows in range(1, 9):
        bands = math.ceil(math.log(1 - certainty) / math.log1p(-(jaccard**rows)))
        if bands * rows <= most:
            best = bands, rows
    if best is None:
        raise ValueError(f"no {most} hash values find a similarity of {jaccard:.3f} with probability {certainty}")
    return best


@dataclass(frozen=True)
class _Class:
    """Templates of up to ``size`` words, with the band values that windows of twice as many words are looked up by."""

    size: int
    names: list[str]
    sets: list[np.ndarray]
    telling: list[list[np.ndarray]]  # by template, the shingles that tell it from each relative of another license
    longest: int
    bands: int
    rows: int
    seeds: np.ndarray
    values: np.ndarray  # template by band


def _minima(shingles: np.ndarray, starts: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """The least value of each hash function in the runs of shingles that begin at ``starts``."""
    out = np.empty((len(seeds), len(starts)), np.uint64)
    for i, seed in enumerate(seeds):
        out[i] = np.minimum.reduceat((shingles ^ seed) * (seed | np.uint64(1)), starts)
    return out


def _banded(minima: np.ndarray, bands: int, rows: int) -> np.ndarray:
    grouped = minima.reshape(bands, rows, -1)
    out = grouped[:, 0].copy()
    for r in range(1, rows):
        out = words.mix(out) ^ grouped[:, r]
    return out


def template_classes(
    notices: Mapping[str, str | tuple[str, ...]], width: int = SHINGLE_WORDS, contained: float = CONTAINED
) -> list[_Class]:
    spelled = [(name, text) for name, texts in notices.items() for text in ((texts,) if isinstance(texts, str) else texts)]
    templates = []
    for row, hashes, _ in words.words_and_spans(pa.array([text for _, text in spelled], pa.string()), True, True):
        if len(hashes) < width:
            raise ValueError(f"{spelled[row][0]!r} has a template of fewer than {width} words")
        templates.append((spelled[row][0], len(hashes), np.unique(words.windows(hashes, width))))

    def telling(name: str, own: np.ndarray) -> list[np.ndarray]:
        rests = (np.setdiff1d(own, other, assume_unique=True) for relative, _, other in templates if relative != name)
        return [rest for rest in rests if 0 < len(rest) <= (1 - contained) * len(own) + 1e-9]

    by_size: dict[int, list] = {}
    for name, n, own in templates:
        by_size.setdefault(max(4, 1 << (n - 1).bit_length()), []).append((name, n, own, telling(name, own)))
    classes = []
    for size, group in sorted(by_size.items()):
        most = 2 * size - width + 1  # shingles of a window
        jaccard = min(contained * len(g[2]) / (most + (1 - contained) * len(g[2])) for g in group)
        bands, rows = band_settings(jaccard)
        seeds = np.random.default_rng(size).integers(1, 1 << 63, bands * rows, dtype=np.uint64)
        values = np.stack([_banded(_minima(g[2], np.array([0]), seeds), bands, rows)[:, 0] for g in group])
        longest = max(g[1] for g in group)
        classes.append(_Class(size, [g[0] for g in group], [g[2] for g in group], [g[3] for g in group], longest, bands, rows, seeds, values))
    return classes


def _segments(texts: Iterator[tuple[int, np.ndarray]], step: int, overlap: int) -> Iterator[list[tuple[int, int, np.ndarray]]]:
    """Groups of (row, first word, words) of about ``step`` words; longer texts are cut on the grid of windows, overlapping."""
    group, size = [], 0
    for row, hashes in texts:
        for low in range(0, len(hashes), step):
            part = hashes[low : low + step + overlap]
            if group and size + len(part) > step:
                yield group
                group, size = [], 0
            group.append((row, low, part))
            size += len(part)
    if group:
        yield group


def _candidates(shingles: np.ndarray, sizes: np.ndarray, kind: _Class) -> set[tuple[int, int, int]]:
    """(segment, first word of a window in it, template) that share a band; segments have ``sizes`` words."""
    runs = -(-sizes // kind.size)
    segment = np.repeat(np.arange(len(sizes)), runs)
    within = (np.arange(len(segment)) - np.repeat(np.cumsum(runs) - runs, runs)) * kind.size
    starts = np.repeat(np.cumsum(sizes) - sizes, runs) + within
    minima = _minima(shingles, starts, kind.seeds)
    # a window is two neighbouring runs of a segment; shingles across segments do no harm, as all matches are checked
    same = np.flatnonzero(segment[1:] == segment[:-1])
    minima[:, same] = np.minimum(minima[:, same], minima[:, same + 1])
    banded = _banded(minima, kind.bands, kind.rows)
    hits = set()
    for band in range(kind.bands):
        for at in np.flatnonzero(np.isin(banded[band], kind.values[:, band])).tolist():
            for t in np.flatnonzero(kind.values[:, band] == banded[band, at]).tolist():
                hits.add((int(segment[at]), int(within[at]), t))
    return hits


Match = tuple[float, int, int]


def find_notices(
    texts: Iterator[tuple[int, np.ndarray]], classes: list[_Class], width: int = SHINGLE_WORDS, contained: float = CONTAINED
) -> dict[int, dict[str, Match]]:
    """By row, the best match of each notice in the text's words: (containment, first word, last word)."""
    best: dict[int, dict[str, tuple[tuple[float, int], Match]]] = {}
    largest = max((kind.size for kind in classes), default=8)
    for group in _segments(texts, _SLICE // largest * largest, 2 * largest + width):
        joined = np.concatenate([part for _, _, part in group])
        if len(joined) < width:
            continue
        sizes = np.array([len(part) for _, _, part in group])
        shingles = np.append(words.windows(joined, width), np.full(width - 1, np.iinfo(np.uint64).max, np.uint64))
        for kind in classes:
            for segment, at, t in sorted(_candidates(shingles, sizes, kind)):
                row, low, part = group[segment]
                inside = words.windows(part[at : at + 2 * kind.size + width - 1], width)
                places = np.flatnonzero(np.isin(inside, kind.sets[t]))
                held = np.unique(inside[places])
                share = len(held) / len(kind.sets[t])
                rank = share, len(held)
                own, name = best.setdefault(row, {}), kind.names[t]
                if share < contained or any(np.isin(rest, held).mean() < contained for rest in kind.telling[t]):
                    continue
                match = share, low + at + int(places[0]), low + at + int(places[-1]) + width
                known, before = own.get(name, ((0.0, 0), (0.0, 0, 0)))
                if rank > known or rank == known and match[1] < before[1]:
                    own[name] = rank, match
    return {row: {name: match for name, (_, match) in own.items()} for row, own in best.items()}


def scan_licenses(docs: DataFrame, notices: Mapping[str, str | tuple[str, ...]] = TEMPLATES, contained: float = CONTAINED) -> DataFrame:
    """``(doc_id, license, containment, start, end)`` for every license whose notice a text holds.

    ``notices`` has one template or several by license. Words are compared without case and ASCII punctuation. A notice is found where a window holds at least ``contained`` of its
    3-word shingles; of several places and templates the largest share counts, then the most shingles, then the first. ``start`` and ``end`` are code-point
    offsets from the first to the last shingle found. Null and empty texts hold nothing; repeated rows give
    repeated results; rows without an id are scanned as well. The notices, given as a parameter, travel with the tasks.
    """
    classes = template_classes(notices, contained=contained)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            found = find_notices(((row, hashes) for row, hashes, _ in words.words_and_spans(texts, True, True)), classes, contained=contained)
            out = []
            for row, own in found.items():
                raw, doc_id = (texts[row].as_py() or "").encode(), batch.column("doc_id")[row].as_py()
                _, _, spans = next(words.words_and_spans(texts.slice(row, 1), True, True))
                chars = lambda end: len(raw[:end].decode())
                for name, (share, first, last) in sorted(own.items()):
                    out.append((doc_id, name, share, chars(int(spans[first, 0])), chars(int(spans[last - 1, 1]))))
            columns = list(zip(*out)) or [[]] * 5
            kinds = (pa.int64(), pa.string(), pa.float64(), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds)], ["doc_id", "license", "containment", "start", "end"]
            )

    return docs.select("doc_id", F.col("text")).mapInArrow(run, FOUND)
