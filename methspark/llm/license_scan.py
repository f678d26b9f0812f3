"""License scan: winnowed template fingerprints pick candidates, banded alignment reports coverage and spans.

Templates are winnowed (the least hash of every few consecutive grams of words) into an inverted index,
which is broadcast: at most ``MAX_TEMPLATE_WORDS`` words in all, checked. A run of words that the changes
allowed by ``COVERAGE`` surely leave whole must hold a kept gram, so it holds as many grams as the window
has: a run of four words, which templates of eight words and more have at 0.8, gives grams of three words
and a window of two; shorter ones have smaller grams, and only those of two or five words keep all grams,
as a run of two words leaves no room for a window. Each text's hashes are looked up; each place where a hit lets the template begin is a
candidate, and the template is aligned on a band around it, in the words that no earlier match of the
template takes, many candidates at a time. Matches with at least ``COVERAGE`` of the template, in a span of
which they are as large a share, are reported.

Defined results: null and empty texts have no match; a template that occurs several times is reported
each time, back to back too; matches of different templates may overlap; repeated rows are scanned alike; no
templates or rows work; extra columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_right, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._text import ALNUM, chunks, table, thrifty, words_of
from .align import matched_places

GRAM = 3
COVERAGE = 0.8
BAND = 8
MAX_TEMPLATE_WORDS = 500_000
#: Short license notices, the openings of common licenses, and whole short licenses.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "MIT-notice": "Released under the MIT License.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so",
    "BSD": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
    "all-rights-reserved": "All rights reserved.",
    "MIT-whole": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "ISC-whole": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    "BSD-2-Clause-whole": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
}


def winnow(h: np.ndarray, window: int) -> np.ndarray:
    """Places of the least hash (the last of equals) of every `window` consecutive ones; of all if there are fewer."""
    if not len(h):
        return np.empty(0, np.int64)
    if len(h) <= window:
        return np.array([len(h) - 1 - int(np.argmin(h[::-1]))])
    view = np.lib.stride_tricks.sliding_window_view(h[::-1], window)
    return np.unique(len(h) - 1 - (np.arange(len(view)) + view.argmin(1)))


def sizes_of(n: int, gram: int, coverage: float) -> tuple[int, int]:
    """(words of a gram, grams of a window) such that n words with all but `coverage` of them changed keep a winnowed gram: one of a run that the changes leave whole."""
    changed = int((1 - coverage) * n + 1e-9)
    run = max(1, -(-(n - changed) // (changed + 1)))
    size = min(gram, run - 1) if run > 2 else run
    return size, run - size + 1


def tight(places: np.ndarray, share: float) -> tuple[int, int, int]:
    """(places held, start, end) of the span with the most places, which are at least `share` of it; the first of equals."""
    best = (0, 0, 0)
    for i in range(len(places)):
        if len(places) - i <= best[0]:
            break
        fits = np.flatnonzero(np.arange(1, len(places) - i + 1) >= share * (places[i:] - places[i] + 1) - 1e-9)
        if fits[-1] + 1 > best[0]:
            best = (int(fits[-1]) + 1, int(places[i]), int(places[i + fits[-1]]) + 1)
    return best


class TemplateIndex:
    def __init__(self, templates: dict[str, str], gram: int = GRAM, coverage: float = COVERAGE):
        self.names, self.words, index = [], [], {}
        for name, text in sorted(templates.items()):
            w = words_of(text, ALNUM)
            if not len(w.hash):
                continue
            n, window = sizes_of(len(w.hash), gram, coverage)
            at, h = w.windows(n)
            for k in winnow(h, window).tolist():
                index.setdefault((n, int(h[k])), []).append((len(self.names), int(at[k])))
            self.names.append(name)
            self.words.append(w.hash)
        self.index = index
        self.sorted = {n: np.array(sorted(h for m, h in index if m == n), np.uint64) for n in {m for m, _ in index}}

    def candidates(self, words) -> dict[tuple[int, int], list[int]]:
        """By (text, template): the places in the text where the template would begin, by each hit."""
        out: dict[tuple[int, int], list[int]] = {}
        for n, known in self.sorted.items():
            at, h = words.windows(n)
            found = np.searchsorted(known, h)
            found[found == len(known)] = 0
            for k in np.flatnonzero(known[found] == h).tolist():
                doc = int(words.doc[at[k]])
                for t, place in self.index[n, int(h[k])]:
                    out.setdefault((doc, t), []).append(int(at[k] - words.first[doc]) - place)
        return out

    def scan(self, words, coverage: float, band: int) -> list[list[tuple[str, float, int, int]]]:
        """(name, coverage, start, end) of each text's matches, in words."""
        out: list[list] = [[] for _ in range(len(words.count))]
        # of each text and template: the places left to try, the last one first, and the matches so far
        todo = [(doc, t, sorted(set(begins), reverse=True), []) for (doc, t), begins in sorted(self.candidates(words).items())]
        while todo:
            asked = []
            for doc, t, begins, taken in todo:
                text, own = words.hash[words.first[doc] : words.first[doc + 1]], self.words[t]
                while begins:
                    at = max(0, begins[-1])
                    k = bisect_right(taken, (at, len(text)))  # matches are apart and in order: those before the place and after it
                    before, after = taken[k - 1][1] if k else 0, taken[k][0] if k < len(taken) else len(text)
                    lo, hi = max(before, begins[-1] - band), min(after, begins[-1] + len(own) + 2 * band)
                    if before <= at and hi - lo >= coverage * len(own) - 1e-9:
                        around = np.zeros(2 * band, own.dtype)  # words that match nothing, where a template's ends are missing
                        asked.append((doc, t, begins, taken, lo - 2 * band, (own, np.concatenate((around, text[lo:hi], around)), begins[-1] - lo, begins[-1] - lo + 4 * band)))
                        break
                    begins.pop()
            for (doc, t, begins, taken, lo, _), places in zip(asked, matched_places([x[-1] for x in asked], free=True), strict=True):
                n, s, e = tight(places[places >= 0], coverage)
                if n >= coverage * len(self.words[t]) - 1e-9:  # a match beside the place leaves it to be tried again
                    insort(taken, (lo + s, lo + e))
                    out[doc].append((self.names[t], n / len(self.words[t]), lo + s, lo + e))
                else:
                    begins.pop()
            todo = [x[:4] for x in asked]
        return [sorted(x, key=lambda m: (m[2], m[3], m[0])) for x in out]


MATCHES = "array<struct<license:string,coverage:double,start:long,end:long>>"
ARROW = pa.list_(pa.struct([("license", pa.string()), ("coverage", pa.float64()), ("start", pa.int64()), ("end", pa.int64())]))


def scan_licenses(docs: DataFrame, templates: dict[str, str] | None = None, coverage: float = COVERAGE, band: int = BAND, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_words, matches (license, coverage, start, end); one row for each document."""
    templates = TEMPLATES if templates is None else templates
    if sum(len(words_of(t, ALNUM).hash) for t in templates.values()) > MAX_TEMPLATE_WORDS:
        raise ValueError(f"at most {MAX_TEMPLATE_WORDS} template words can be broadcast")
    index = docs.sparkSession.sparkContext.broadcast(TemplateIndex(templates, coverage=coverage))
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for i, j, words in chunks(batch.column("text"), ALNUM):
                found = [[dict(zip(("license", "coverage", "start", "end"), m, strict=True)) for m in x] for x in index.value.scan(words, coverage, band)]
                yield pa.RecordBatch.from_arrays([batch.column("id").slice(i, j - i), pa.array(words.count, pa.int64()), pa.array(found, ARROW)], ["id", "n_words", "matches"])

    out = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(thrifty(run), f"id {kind}, n_words long, matches {MATCHES}")
    return out.withColumnRenamed("id", id_col)


def query(spark, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))
