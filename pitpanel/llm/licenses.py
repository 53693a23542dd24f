"""License scans: MinHash bands over overlapping windows, then containment.

A text's five-word shingles are cut into blocks; a window is two neighbouring
blocks, so every run of one block length lies inside a window.  Templates are
classed by size and looked for with blocks of at least their own length: a
window that holds 80 % of a template has a Jaccard similarity of at least
0.2 to it, even when the block is almost twice the template.  With ``BANDS``
single-row bands it is retrieved with probability 1 - 0.8**64 > 0.9999993 at
that worst case.  Block minima of a larger class are minima of the smaller
class's blocks, so a text is hashed once for all classes.  Retrieved windows
are verified by the exact share of the template's shingles they contain.

Templates are a small fixed table (or the caller's), bounded by
``MAX_TEMPLATE_SHINGLES`` in all, and travel with the code; no shuffle.

Defined results: words are runs of letters and digits, lower-cased; null,
empty and shorter texts contain nothing; a template that occurs several times
is reported once with its number of places; repeated rows are reported each;
an empty table gives an empty result.  Extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitpanel.llm.common import mix64, text_batches, window_hashes, word_hashes

SHINGLE = 5
CONTAINED = 0.8
BANDS = 64
MIN_BLOCK = 2
MAX_TEMPLATE_SHINGLES = 200_000
#: Shingles hashed at once inside a task.
CHUNK = 1 << 17

#: Public license notices by SPDX identifier.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "Apache-2.0-header": (
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        "software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS "
        "OF ANY KIND, either express or implied. See the License for the specific language governing permissions "
        "and limitations under the License."),
    "BSD-conditions": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met"),
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "GPL-3.0": "licensed under the GNU General Public License, version 3",
    "GPL-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation"),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    "MIT": "Released under the MIT License",
    "MIT-permission": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the Software), to deal in the Software without restriction, including "
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so"),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
        "was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}


_WORD = re.compile(r"[^\W_]+")


def shingle_hashes(text: bytes | None) -> np.ndarray:
    """Hashes of all five-word windows, in order."""
    words = _WORD.findall(text.decode().lower()) if text else []
    return window_hashes(word_hashes(words), SHINGLE)


def template_classes(templates: Mapping[str, str]) -> dict[int, list[tuple[str, np.ndarray]]]:
    """Distinct shingles of the templates by block length, the power of two
    that is at least their number."""
    out: dict[int, list[tuple[str, np.ndarray]]] = {}
    total = 0
    for name, text in sorted(templates.items()):
        shingles = np.unique(shingle_hashes(text.encode()))
        if not len(shingles):
            raise ValueError(f"template {name} is shorter than {SHINGLE} words")
        total += len(shingles)
        out.setdefault(max(MIN_BLOCK, 1 << int(len(shingles) - 1).bit_length()), []).append((name, shingles))
    if total > MAX_TEMPLATE_SHINGLES:
        raise ValueError(f"templates have {total} shingles, more than {MAX_TEMPLATE_SHINGLES}")
    return out


def _band_values(shingles: np.ndarray, salt: np.ndarray, band: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (shingles ^ salt[2 * band]) * (salt[2 * band + 1] | np.uint64(1))


def retrieved(shingles: np.ndarray, classes, mins, salt: np.ndarray) -> dict[int, np.ndarray]:
    """Per block length a (windows, templates) mask of shared band values."""
    found: dict[int, np.ndarray] = {}
    for band in range(len(salt) // 2):
        block, values = MIN_BLOCK, _band_values(shingles, salt, band)
        low = np.minimum.reduceat(values, np.arange(0, len(values), block))
        while block <= max(classes):
            if block in classes:
                window = np.minimum(low[:-1], low[1:]) if len(low) > 1 else low
                if block not in found:
                    found[block] = np.zeros((len(window), len(classes[block])), bool)
                for t, value in enumerate(mins[block][:, band]):
                    found[block][:, t] |= window == value
            low = np.minimum.reduceat(low, np.arange(0, len(low), 2))
            block *= 2
    return found


def _places(shingles, classes, mins, salt, contained):
    """(template, containment, first shingle) of the windows that hold a
    template, in order."""
    for block, hit in retrieved(shingles, classes, mins, salt).items():
        for w, t in zip(*np.nonzero(hit)):
            name, wanted = classes[block][t]
            part = shingles[w * block:(w + 2) * block]
            at = np.flatnonzero(np.isin(part, wanted))
            share = len(np.unique(part[at])) / len(wanted)
            if share >= contained:
                yield name, len(wanted), share, int(w * block + at[0])


def _scan(templates: Mapping[str, str], contained: float, bands: int):
    classes = template_classes(templates)
    salt = mix64(np.arange(1, 2 * bands + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    mins = {block: np.array([[_band_values(s, salt, b).min() for b in range(bands)] for _, s in group])
            for block, group in classes.items()}
    # between two texts lie as many fillers as the longest window has shingles
    gap = np.zeros(2 * max(classes), np.uint64)

    def found(ids: list, parts: list[np.ndarray]):
        """Texts are scanned side by side, so each band is a few array operations."""
        starts = np.concatenate([[0], np.cumsum([len(p) + len(gap) for p in parts])])
        best: dict[tuple[int, str], list] = {}
        for name, size, share, at in _places(np.concatenate([x for p in parts for x in (p, gap)]), classes, mins,
                                             salt, contained):
            doc = int(np.searchsorted(starts, at, "right")) - 1
            at -= int(starts[doc])
            row = best.setdefault((doc, name), [share, at, 0, -1])
            if at >= row[3]:
                row[2:] = [row[2] + 1, at + size]
            if share > row[0]:
                row[:2] = [share, at]
        return [(ids[doc], name, *row[:3]) for (doc, name), row in sorted(best.items())]

    def run(batches):
        for batch, texts in text_batches(batches):
            rows, ids, parts, n = [], [], [], 0
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts):
                shingles = shingle_hashes(text)
                if len(shingles):
                    ids.append(doc_id)
                    parts.append(shingles)
                    n += len(shingles) + len(gap)
                if n >= CHUNK:
                    rows += found(ids, parts)
                    ids, parts, n = [], [], 0
            if parts:
                rows += found(ids, parts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in rows], t) for k, t in enumerate(
                    (pa.int64(), pa.string(), pa.float64(), pa.int64(), pa.int64()))],
                ["doc_id", "license", "containment", "first_word", "n_places"])
    return run


def scan_licenses(docs: DataFrame, templates: Mapping[str, str] = TEMPLATES, contained: float = CONTAINED,
                  bands: int = BANDS) -> DataFrame:
    """One row per document and license found: doc_id, license, containment
    (the best window's), first_word (its place) and n_places."""
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        _scan(templates, contained, bands),
        "doc_id long, license string, containment double, first_word long, n_places long")
