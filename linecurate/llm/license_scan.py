"""Licence texts in documents: winnowed fingerprints, an inverted index, banded alignment.

Templates are cut into word K-grams; of each WINDOW consecutive hashes the smallest is posted.
A document's winnowed fingerprints are looked up in these postings; fingerprints on nearby
diagonals make a candidate, and the words around it are aligned with the template in a band.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textblocks as tb
from .runtime import bounded_batches

K = 3  # words in a fingerprint; shorter templates aren't looked for
WINDOW = 4  # any WINDOW + K - 1 shared words share a fingerprint
SHORT = 12  # words; of shorter templates every K-gram is posted
BAND = 8  # words by which an alignment may leave the candidate's diagonal
MIN_COVERAGE = 0.8  # of the template's words

# Wording of public licence notices and terms.
TEMPLATES: dict[str, str] = {
    "MIT-notice": "Released under the MIT License.",
    "MIT-notice-2": "Licensed under the MIT License.",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0-notice": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0-notice": "Licensed under CC BY-SA 4.0.",
    "CC-BY-4.0-long": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0-long": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "all-rights-reserved": "All rights reserved.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "GPL-3.0": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "GPL-2.0": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "LGPL-3.0": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 3 of the License, or (at your option) any later version.",
    "BSD": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "MIT-warranty": "The Software is provided \"as is\", without warranty of any kind, express or implied, including but not limited to the warranties of merchantability, fitness for a particular purpose and noninfringement. In no event shall the authors or copyright holders be liable for any claim, damages or other liability, whether in an action of contract, tort or otherwise, arising from, out of or in connection with the Software or the use or other dealings in the Software.",
    "BSD-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "BSD-3-endorsement": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "BSD-warranty": "This software is provided by the copyright holders and contributors \"as is\" and any express or implied warranties, including, but not limited to, the implied warranties of merchantability and fitness for a particular purpose are disclaimed. In no event shall the copyright holder or contributors be liable for any direct, indirect, incidental, special, exemplary, or consequential damages (including, but not limited to, procurement of substitute goods or services; loss of use, data, or profits; or business interruption) however caused and on any theory of liability, whether in contract, strict liability, or tort (including negligence or otherwise) arising in any way out of the use of this software, even if advised of the possibility of such damage.",
    "Zlib": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution.",
    "GPL-warranty": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    "ISC-warranty": "The software is provided \"as is\" and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness. In no event shall the author be liable for any special, direct, indirect, or consequential damages or any damages whatsoever resulting from loss of use, data or profits, whether in an action of contract, negligence or other tortious action, arising out of or in connection with the use or performance of this software.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "Unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
}


def _words(raw: bytes) -> np.ndarray:
    """Hashes of the words, taken without their outer punctuation by blanking it first."""
    return tb.word_hashes([raw])[0]


_PLAIN = bytes(c if chr(c).isalnum() or c >= 128 or c in b" \t\n\r\x0b\x0c-" else 32 for c in range(256))


def plain(text: str | None) -> bytes:
    """Lower-cased bytes of the same length with ASCII punctuation (but -) turned into blanks."""
    return tb.lowered(text).translate(_PLAIN)


def fingerprints(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Winnowed (hash, place) of the word K-grams: the last smallest of every WINDOW of them; all of short templates."""
    n = len(words) - K + 1
    if n <= 0:
        return words[:0], np.zeros(0, np.int64)
    grams = np.zeros(n, np.uint64)
    for i in range(K):
        grams = tb.mix(grams + words[i : i + n] + np.uint64(i + 1))
    if len(words) < SHORT:
        at = np.arange(n)
    else:
        views = np.lib.stride_tricks.sliding_window_view(grams, WINDOW)[:, ::-1]
        at = np.unique(np.arange(len(views)) + WINDOW - 1 - np.argmin(views, axis=1))
    return grams[at], at


def align(pattern: np.ndarray, text: np.ndarray, band: int) -> tuple[int, int, int]:
    """(words in common, first, past the end) of the best alignment of pattern inside text.

    A longest common subsequence over the diagonals 0..2*band; text's end parts are free. first
    and end bound the matched words of text.
    """
    m, width = len(pattern), 2 * band + 1
    best = np.zeros((m + 1, width), np.int32)
    lanes = np.arange(width)
    for i in range(1, m + 1):
        at = i - 1 + lanes
        inside = at < len(text)
        same = np.zeros(width, bool)
        same[inside] = text[at[inside]] == pattern[i - 1]
        row = best[i - 1] + same
        row[:-1] = np.maximum(row[:-1], best[i - 1, 1:])
        best[i] = np.maximum.accumulate(row)
    i, c, places = m, int(np.argmax(best[m])), []
    while i > 0 and best[i, c] > 0:
        at = i - 1 + c
        if at < len(text) and text[at] == pattern[i - 1] and best[i, c] == best[i - 1, c] + 1:
            places.append(at)
            i -= 1
        elif c + 1 < width and best[i - 1, c + 1] == best[i, c]:
            i, c = i - 1, c + 1
        elif c > 0 and best[i, c - 1] == best[i, c]:
            c -= 1
        else:
            i -= 1
    return len(places), (places[-1] if places else 0), (places[0] + 1 if places else 0)


class Index:
    """Inverted index of winnowed template fingerprints."""

    def __init__(self, templates: dict[str, str]):
        self.names = sorted(templates)
        self.words = [_words(plain(templates[n])) for n in self.names]
        grams, owners, places = [], [], []
        for i, words in enumerate(self.words):
            g, at = fingerprints(words)
            grams.append(g)
            owners.append(np.full(len(g), i))
            places.append(at)
        flat = np.concatenate(grams)
        order = np.argsort(flat, kind="stable")
        self.grams, self.owners, self.places = flat[order], np.concatenate(owners)[order], np.concatenate(places)[order]


def scan(text: str | None, index: Index, min_coverage: float = MIN_COVERAGE) -> list[tuple[str, float, int, int, int, int]]:
    """(template, coverage, matched words, template words, first and past-the-end byte offset)."""
    raw = plain(text)
    words = _words(raw)
    # every K-gram of the document is looked up: a template shorter than a window is found in any surroundings
    n = len(words) - K + 1
    if n <= 0:
        return []
    grams = np.zeros(n, np.uint64)
    for i in range(K):
        grams = tb.mix(grams + words[i : i + n] + np.uint64(i + 1))
    low = np.searchsorted(index.grams, grams, "left")
    at = np.flatnonzero(index.grams[np.minimum(low, len(index.grams) - 1)] == grams)
    if not len(at):
        return []
    starts, ends = tb.word_bounds(raw)
    found = []
    many = np.searchsorted(index.grams, grams[at], "right") - low[at]
    posted = np.repeat(low[at] - np.concatenate(([0], np.cumsum(many)[:-1])), many) + np.arange(many.sum())
    hits = np.unique(np.stack((index.owners[posted], np.repeat(at, many) - index.places[posted])), axis=1)
    done: dict[int, int] = {}  # past the last match's end
    for owner, diagonal in hits.T.tolist():
        pattern = index.words[owner]
        begin, stop = max(0, diagonal - BAND, done.get(owner, 0)), min(len(words), diagonal + len(pattern) + BAND)
        if stop - begin < min_coverage * len(pattern):
            continue
        common, first, end = align(pattern, words[begin:stop], BAND)
        if common and common >= min_coverage * len(pattern):
            done[owner] = begin + end
            found.append((index.names[owner], common / len(pattern), common, len(pattern), int(starts[begin + first]), int(ends[begin + end - 1])))
    # a template inside a longer match of another one is that one's
    found = [x for x in found if not any(y[2] > x[2] and y[4] <= x[4] and x[5] <= y[5] for y in found)]
    return sorted(found, key=lambda x: (x[4], x[5], x[0]))


def _scan(templates: dict[str, str], min_coverage: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index = Index(templates)
        for batch in batches:
            rows = [(d, *x) for d, t in zip(batch["doc_id"].astype("Int64"), batch["text"]) for x in scan(t, index, min_coverage)]
            yield pd.DataFrame(rows, columns=["doc_id", "template", "coverage", "matched_words", "template_words", "start_byte", "end_byte"]).astype({"doc_id": "Int64"})

    return run


def license_spans(docs: DataFrame, templates: dict[str, str] | None = None, min_coverage: float = MIN_COVERAGE) -> DataFrame:
    """Licence templates found in docs: doc_id, template, coverage, matched_words, template_words,
    start_byte, end_byte (of the text's UTF-8).

    One row for each place of each template whose words are covered to min_coverage, in order,
    within BAND words of a diagonal, the next one after the end of the one before; a place shares
    K words in a row with a template of fewer than SHORT words; case (A-Z) and ASCII punctuation but - don't count. A match
    inside a longer match of another template is left out. Licences of many clauses are templates by
    clause, so that a clause that is left out or changed leaves the others found. Null, empty and short texts give no
    row; null doc_ids are carried along; repeated rows are scanned again. Other columns are
    ignored. The templates are code, so the index that goes to the executors is of fixed size.
    """
    bounded_batches(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id long, template string, coverage double, matched_words long, template_words long, start_byte long, end_byte long"
    return docs.mapInPandas(_scan(dict(templates or TEMPLATES), min_coverage), schema)


def op6_license_scan(spark, sf_dir: str) -> DataFrame:
    """Licence wording in `documents`."""
    return license_spans(spark.read.parquet(f"{sf_dir}/documents.parquet"))
