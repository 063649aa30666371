"""Operator 3: license notices found by patience alignment.

Words are lower-cased and stripped of outer punctuation.  For each template, text
windows that hold enough of its words (an upper bound of the coverage) are
aligned: anchor on the words that occur once in both, keep the longest increasing
subsequence of their places, and align the gaps between anchors the same way;
gaps without an anchor give their equal first and last words.  The share of the
template's words that are aligned is its coverage; a notice is found from
``COVERAGE`` on, if the phrases that tell its license from its neighbours (``KEYS``:
name, clause code, version) are aligned, with no other word of the text inside a
phrase.  Windows are tried along the whole text, each behind the last one
found.  Of notices that overlap, the one with the most aligned words stands.

The pass is map-only: the templates travel with the tasks.

Defined results: a null or blank text has no notice; of equal coverages the longer
template is the best, then the first by name; repeated rows are scanned each; a
very long text is scanned whole by one task; only id and text are read, under names
of their own, so further columns clash with nothing; an empty table gives an empty
result.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import LOWER, SEPARATORS, buffers, slices, split_words, word_hashes

COVERAGE = 0.8
#: A window is this much longer than its template, plus two words.
SLACK = 1.25
#: Wordings of public license notices.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at '
                         'http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, '
                         "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, "
                      "either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even "
                      "the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    "MIT": "Released under the MIT License.",
    "MIT-notice": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without '
                  "restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom "
                  "the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "MPL-1.1": 'The contents of this file are subject to the Mozilla Public License Version 1.1 (the "License"); you may not use this file except in compliance with the License.',
    "MPL-2.0-v": "This Source Code Form is subject to the terms of the Mozilla Public License v2.0.",
    "MIT-X11": "Released under the MIT/X11 License.",
    "Apache-2.0-v": "Licensed under the Apache License v2.0.",
    "Apache-2.0-short": "Licensed under the Apache License, Version 2.",
    "Apache-1.1": "Licensed under the Apache License, Version 1.1.",
    "BSD": "Released under the BSD License.",
    "BSD-2-Clause": "Released under the BSD 2-Clause License.",
    "BSD-2-Clause-line": "Released under the 2-Clause BSD License.",
    "BSD-3-Clause": "Released under the BSD 3-Clause License.",
    "BSD-3-Clause-line": "Released under the 3-Clause BSD License.",
    "BSD-2-Clause-notice": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must "
                           "retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of "
                           "conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "ISC": "Released under the ISC License.",
    "ISC-notice": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission "
                  "notice appear in all copies.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "CC0-1.0": "Licensed under CC0 1.0.",
    "CC0-1.0-notice": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "BSL-1.0": "Distributed under the Boost Software License, Version 1.0.",
    "EPL-1.0": "Made available under the terms of the Eclipse Public License v1.0.",
    "EPL-2.0": "Made available under the terms of the Eclipse Public License 2.0.",
}
TEMPLATES["BSD-3-Clause-notice"] = TEMPLATES["BSD-2-Clause-notice"] + (" Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived "
                                                                       "from this software without specific prior written permission.")
#: The phrases of each template that have to be aligned: a word with ? may be missing, | stands between wordings.
KEYS = {
    "Apache-2.0": ["Apache", "Version? 2.0"], "Apache-2.0-v": ["Apache", "v2.0"], "Apache-2.0-short": ["Apache", "Version? 2"], "Apache-1.1": ["Apache", "Version? 1.1"],
    "Apache-2.0-header": ["Apache", "Version? 2.0|http://www.apache.org/licenses/LICENSE-2.0"],
    "MPL-2.0": ["Mozilla", "v? 2.0"], "MPL-2.0-v": ["Mozilla", "v2.0"], "MPL-1.1": ["Mozilla", "Version? 1.1"], "MIT": ["MIT"], "MIT-X11": ["MIT/X11"], "MIT-notice": ["charge", "sublicense"],
    "BSD": ["BSD"], "BSD-2-Clause": ["BSD", "2-Clause"], "BSD-2-Clause-line": ["2-Clause", "BSD"], "BSD-3-Clause": ["BSD", "3-Clause"], "BSD-3-Clause-line": ["3-Clause", "BSD"],
    "BSD-2-Clause-notice": ["Redistribution", "binary"], "BSD-3-Clause-notice": ["Redistribution", "binary", "endorse|promote"], "ISC": ["ISC"], "ISC-notice": ["purpose", "fee"],
    "Unlicense": ["unencumbered"], "CC0-1.0": ["CC0", "1.0"], "CC0-1.0-notice": ["waived"], "BSL-1.0": ["Boost", "Version? 1.0"], "EPL-1.0": ["Eclipse", "v1.0"], "EPL-2.0": ["Eclipse", "2.0"],
}
for _family, _title, _versions in (("GPL", "General", "2 3"), ("LGPL", "Lesser General", "2.1 3"), ("LGPL", "Library General", "2"), ("AGPL", "Affero General", "3")):
    for _v in _versions.split():
        _name, _full = f"{_family}-{_v if '.' in _v else _v + '.0'}", f"GNU {_title} Public License"
        _told = _full.replace("General", "General?")
        _dotted = _name.partition("-")[2]
        for _form, _version in (("", f"version {_v}"), ("-v", f"v{_v}"), *([("-dotted", f"version {_dotted}"), ("-v-dotted", f"v{_dotted}")] if _dotted != _v else [])):
            TEMPLATES[_name + _form] = f"This work is licensed under the {_full}, {_version}."
            KEYS[_name + _form] = [_told, _version.replace("version", "version?")]
        TEMPLATES[_name + "-header"] = TEMPLATES["GPL-3.0-header"].replace("GNU General Public License", _full).replace("version 3 of", f"version {_v} of")
        KEYS[_name + "-header"] = [_told, f"version? {_v}"]
        TEMPLATES[_name + "-code"] = f"Licensed under the {_family}v{_v}."
        KEYS[_name + "-code"] = [f"{_family}v{_v}"]
        TEMPLATES[_name + "-id"] = f"Licensed under the {_name}."
        KEYS[_name + "-id"] = [_name]
for _code, _title in {"BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-NC": "Attribution-NonCommercial", "BY-ND": "Attribution-NoDerivatives",
                      "BY-NC-SA": "Attribution-NonCommercial-ShareAlike", "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives"}.items():
    for _v, _kind in (("1.0", "Generic"), ("2.0", "Generic"), ("2.5", "Generic"), ("3.0", "Unported"), ("4.0", "International")):
        _name, _long = f"CC-{_code}-{_v}", f"This work is licensed under a Creative Commons {_title} {_v} {_kind} License."
        _short = f"Licensed under CC {_code} {_v}."
        _first = TEMPLATES.setdefault(_name, _long)
        _by_title, _by_code = [_title, _v], [f"CC? {_code}", _v]
        KEYS[_name] = _by_title if _first == _long else _by_code
        _name += "-short" if _first == _long else "-long"
        TEMPLATES[_name], KEYS[_name] = (_short, _by_code) if _first == _long else (_long, _by_title)
#: ASCII marks at a word's ends that do not count.
OUTER = SEPARATORS.copy()
OUTER[[b for b in range(33, 127) if not chr(b).isalnum()]] = True


def increasing(places: list[int]) -> list[int]:
    """Indices of a longest strictly increasing subsequence."""
    tops, ends, before = [], [], []
    for i, x in enumerate(places):
        k = bisect_left(tops, x)
        before.append(ends[k - 1] if k else -1)
        if k == len(tops):
            tops.append(x)
            ends.append(i)
        else:
            tops[k], ends[k] = x, i
    out, i = [], ends[-1] if ends else -1
    while i >= 0:
        out.append(i)
        i = before[i]
    return out[::-1]


def patience(a: list, b: list) -> list[tuple[int, int]]:
    """Aligned places of two word sequences, ascending in both."""
    out, work = [], [(0, len(a), 0, len(b))]
    while work:
        a0, a1, b0, b1 = work.pop()
        if a0 >= a1 or b0 >= b1:
            continue
        once = [{w for w, n in Counter(x).items() if n == 1} for x in (a[a0:a1], b[b0:b1])]
        anchors = once[0] & once[1]
        if not anchors:
            while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
                out.append((a0, b0))
                a0, b0 = a0 + 1, b0 + 1
            while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
                a1, b1 = a1 - 1, b1 - 1
                out.append((a1, b1))
            continue
        where = {w: i for i, w in enumerate(b[b0:b1], b0) if w in anchors}
        pairs = [(i, where[w]) for i, w in enumerate(a[a0:a1], a0) if w in anchors]
        kept = [pairs[i] for i in increasing([j for _, j in pairs])]
        out += kept
        for (i, j), (k, m) in zip([(a0 - 1, b0 - 1), *kept], [*kept, (a1, b1)], strict=True):
            work.append((i + 1, k, j + 1, m))
    return sorted(out)


def trimmed_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each lower-cased word without outer punctuation, and the first word of each row; a word of marks alone hashes as empty."""
    starts, ends, first = split_words(data, offsets)
    if not len(starts):
        return np.zeros(0, np.uint64), first
    solid = np.flatnonzero(~OUTER[data])
    lo, hi = np.searchsorted(solid, starts), np.searchsorted(solid, ends)
    some = hi > lo
    if len(solid):
        starts, ends = np.where(some, solid[np.minimum(lo, len(solid) - 1)], starts), np.where(some, solid[np.maximum(hi - 1, 0)] + 1, starts)
    else:
        ends = starts
    return word_hashes(LOWER[data], starts, ends), first


def _template_words(text: str) -> list[int]:
    return trimmed_words(*buffers(pa.array([text])))[0].tolist()


def key_places(template: list[int], phrase: str) -> list[list[tuple[int, bool]]]:
    """Where the wordings of a phrase stand in the template: place of each word, and whether it may not be missing."""
    out = []
    for wording in phrase.split("|"):
        own, needed = _template_words(wording), [not w.endswith("?") for w in wording.split()]
        out += [list(zip(range(i, i + len(own)), needed, strict=True)) for i in range(len(template) - len(own) + 1) if template[i:i + len(own)] == own]
    if not out:
        raise ValueError(f"{phrase} is not in its template")
    return out


def told(pairs: list[tuple[int, int]], keys: list[list[list[tuple[int, bool]]]]) -> bool:
    """Each phrase is aligned at one of its places, with no other word of the text inside."""
    at = dict(pairs)

    def whole(place):
        found = [at[k] for k, _ in place if k in at]
        return all(k in at for k, needed in place if needed) and found[-1] - found[0] == len(found) - 1

    return all(any(map(whole, places)) for places in keys)


def scan_row(words: np.ndarray, hit: np.ndarray, templates: dict[str, list[int]], keys: dict[str, list[list[list[tuple[int, bool]]]]], share: float) -> list[tuple[str, float, int, int]]:
    """(license, coverage, start, end) of the notices in one text's words, in text order; ``hit`` marks the words of any template."""
    out, present = [], set(words[hit].tolist())
    for name, template in templates.items():
        if not all(any(all(template[k] in present for k, needed in place if needed) for place in places) for places in keys[name]):
            continue
        places = np.flatnonzero(np.isin(words, np.array(template, np.uint64)))
        need, span = -int(-share * len(template) // 1), int(SLACK * len(template)) + 2
        enough = np.searchsorted(places, places + span) - np.arange(len(places)) >= need
        starts, behind = places[enough].tolist(), -1

        def aligned(lo, template=template, span=span, need=need, own=keys[name]):
            window = words[lo:lo + span].tolist()
            if sum((Counter(window) & Counter(template)).values()) < need:
                return []
            pairs = patience(template, window)
            return [lo + j for _, j in pairs] if told(pairs, own) else []

        for i, lo in enumerate(starts):
            if lo <= behind or len(best := aligned(lo)) < need:
                continue
            # a later start inside the notice may leave out words that stand before it by chance
            for other in starts[i + 1:]:
                if other >= lo + span or len(best) == len(template):
                    break
                best = max(best, aligned(other), key=len)
            out.append((name, len(best) / len(template), best[0], best[-1] + 1))
            behind = best[-1]
    kept = []
    for n in sorted(out, key=lambda x: (-round(x[1] * len(templates[x[0]])), -x[1], x[3] - x[2], x[2], x[0])):  # of notices that overlap the better one stands
        if all(n[3] <= m[2] or n[2] >= m[3] for m in kept):
            kept.append(n)
    return sorted(kept, key=lambda x: x[2])


def scan_licenses(docs: DataFrame, id: str = "doc_id", text: str = "text", templates: dict[str, str] = TEMPLATES, coverage: float = COVERAGE,
                  keys: dict[str, list[str]] = KEYS) -> DataFrame:
    """Per document: id, ``license`` and ``coverage`` of the best notice (null and 0.0 without one) and ``notices``, all that were found with their words."""
    known = {n: _template_words(t) for n, t in sorted(templates.items())}
    told_by = {n: [key_places(t, k) for k in keys.get(n, [])] for n, t in known.items()}
    every = np.unique(np.concatenate([np.array(t, np.uint64) for t in known.values()]))
    least = min(-int(-coverage * len(t) // 1) for t in known.values())
    kind = pa.list_(pa.struct([("license", pa.string()), ("coverage", pa.float64()), ("start", pa.int64()), ("end", pa.int64())]))

    def scan(batches):
        for batch in batches:
            data, offsets = buffers(batch.column(1))
            found = []
            for lo, hi in slices(offsets):
                words, first = trimmed_words(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
                rows = np.repeat(np.arange(hi - lo), np.diff(first))
                near = np.minimum(np.searchsorted(every, words), len(every) - 1)
                hit = every[near] == words
                hits = np.bincount(rows[hit], minlength=hi - lo)
                found += [scan_row(words[first[r]:first[r + 1]], hit[first[r]:first[r + 1]], known, told_by, coverage) if hits[r] >= least else [] for r in range(hi - lo)]
            best = [min(f, key=lambda x: (-x[1], -len(known[x[0]]), x[0])) if f else (None, 0.0) for f in found]
            notices = pa.array([[dict(zip(("license", "coverage", "start", "end"), x, strict=True)) for x in f] for f in found], kind)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([b[0] for b in best], pa.string()), pa.array([b[1] for b in best], pa.float64()), notices], ["_id", "license", "coverage", "notices"])

    rows = docs.select(F.col(id).alias("_id"), F.col(text).cast("string").alias("_text"))
    fields = T._parse_datatype_string("license string, coverage double, notices array<struct<license:string,coverage:double,start:long,end:long>>").fields
    return rows.mapInArrow(scan, T.StructType([rows.schema["_id"], *fields])).withColumnRenamed("_id", id)
