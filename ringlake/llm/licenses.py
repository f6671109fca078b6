"""Licence scans by conditional compression (operator 1).

Candidate blocks, lines and paragraphs with a licence cue, are compressed alone and once with each template as a raw
zstandard dictionary. The templates that shorten a block most are ranked by that saving, and a winner counts only when
its exact wording is confirmed: the words that the block lacks or has beyond the template are listed, and any lacking
word, version number or clause among the template's own words makes it a variant instead of a match.
"""

from __future__ import annotations

import bisect
import difflib
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringlake.llm import bytescan as B
from ringlake.llm.spaces import table

#: Notice wordings by licence identifier.
TEMPLATES = {
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        "SPDX-License-Identifier: MIT",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "GPL-3.0-only": ["This work is licensed under the GNU General Public License, version 3.", "SPDX-License-Identifier: GPL-3.0-only"],
    "GPL-3.0-or-later": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "GPL-2.0-only": ["This work is licensed under the GNU General Public License, version 2.", "SPDX-License-Identifier: GPL-2.0-only"],
    "GPL-2.0-or-later": [
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
        "SPDX-License-Identifier: GPL-2.0-or-later",
    ],
    "LGPL-2.1-only": ["SPDX-License-Identifier: LGPL-2.1-only"],
    "LGPL-2.1-or-later": [
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
    ],
    "AGPL-3.0-only": ["Licensed under the GNU Affero General Public License, version 3.", "SPDX-License-Identifier: AGPL-3.0-only"],
    "AGPL-3.0-or-later": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "SPDX-License-Identifier: AGPL-3.0-or-later",
    ],
    "BSD-3-Clause": [
        "Licensed under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "BSD-2-Clause": ["Licensed under the BSD 2-Clause License.", "SPDX-License-Identifier: BSD-2-Clause"],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
        "SPDX-License-Identifier: MPL-2.0",
    ],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
        "SPDX-License-Identifier: ISC",
    ],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC-BY-ND-4.0": ["Licensed under CC BY-ND 4.0.", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."],
    "CC-BY-NC-SA-4.0": ["Licensed under CC BY-NC-SA 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License."],
    "CC0-1.0": ["Dedicated to the public domain under CC0 1.0.", "SPDX-License-Identifier: CC0-1.0"],
    "BSL-1.0": ["Distributed under the Boost Software License, Version 1.0.", "SPDX-License-Identifier: BSL-1.0"],
    "EPL-2.0": ["This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/", "SPDX-License-Identifier: EPL-2.0"],
    "Zlib": ["SPDX-License-Identifier: Zlib"],
    "0BSD": ["SPDX-License-Identifier: 0BSD"],
    "Unlicense": ["SPDX-License-Identifier: Unlicense", "This is free and unencumbered software released into the public domain."],
}
CUE = r"(?i)licen[sc]|spdx|permission is hereby|permission to use|redistribution|free software|public domain|cc[ -]by|cc0"
WORD = re.compile(r"[^\W_]+(?:\.\d+)*")
#: Lines and sentences, each with the end that closes it.
SEGMENT = re.compile(r"[^\n]*?(?:[.!?](?=\s)|\n|\Z)")
PARAGRAPH = re.compile(r"(?:[^\n]*\S[^\n]*(?:\n|\Z))+")


def words(s: str) -> list[str]:
    return [w.lower() for w in WORD.findall(s)]


@dataclass
class Verdict:
    start: int
    end: int
    license: str
    verdict: str
    saving: float
    lacking: list[str]
    beyond: list[str]


class Scanner:
    """Compressors primed with each template; plain data, made where it is used.

    A paragraph's words are listed once. Its segments with a cue, sentences and lines, are settled first; what a segment states
    exactly stands, unless a longer template goes on from there. Each cue that is left gets one window of words about it, a longest
    template's length on each side but not into what is settled, for wordings that run over lines and sentences. So a text
    takes as many settlings as it has segments, cues and statements, however they crowd.
    """

    def __init__(self, level: int = 3, near: float = 0.75):
        self.cue, self.near = re.compile(CUE), near
        self.plain = zstandard.ZstdCompressor(level=level, write_checksum=False, write_content_size=False)
        self.all = []
        for name, texts in TEMPLATES.items():
            for t in texts:
                w = words(t)
                primed = zstandard.ZstdCompressionDict(" ".join(w).encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                primed.precompute_compress(level=level)
                self.all.append((name, w, zstandard.ZstdCompressor(level=level, dict_data=primed, write_checksum=False, write_content_size=False, write_dict_id=False)))
        self.counts = [Counter(w) for _, w, _ in self.all]
        flat = [f" {' '.join(w)} " for _, w, _ in self.all]
        #: Templates that another one holds: what states them exactly may state the longer one.
        self.begun = [any(f != g and f in g for g in flat) for f in flat]
        self.reach = max(len(w) for _, w, _ in self.all) * 5 // 4
        self.known: dict[bytes, tuple | None] = {}

    def judged(self, own: list[str]) -> tuple | None:
        """``first word, end, template, verdict, saving, lacking, beyond`` of a block's best wording. Templates too few of whose words the block has
        cannot be confirmed and are not tried; all others that shorten the block are."""
        flat = " ".join(own).encode()
        if flat in self.known:  # the verdict depends on the words alone
            return self.known[flat]
        if len(self.known) > 4096:
            self.known.clear()
        have = Counter(own)
        may = [i for i, c in enumerate(self.counts) if sum(min(n, have[w]) for w, n in c.items() if w in have) >= self.near * len(self.all[i][1])]
        alone = len(self.plain.compress(flat)) if may else 1
        ranked = sorted(((alone - len(self.all[i][2].compress(flat))) / alone, i) for i in may)
        best = None
        for saving, i in sorted(ranked, key=lambda r: (-r[0], self.all[r[1]][0], r[1])):
            if saving <= 0:
                break
            found = self.compared(own, i, saving)
            if found and (best is None or found[0] > best[0]):
                best = found
        self.known[flat] = best and best[1]
        return self.known[flat]

    def compared(self, own: list[str], i: int, saving: float) -> tuple | None:
        """The exact differences between a block and a template."""
        name, want, _ = self.all[i]
        ops = difflib.SequenceMatcher(None, own, want, autojunk=False).get_opcodes()
        same = [(x, y) for op, x, y, _, _ in ops if op == "equal"]
        share = sum(y - x for x, y in same) / len(want)
        if not same or share < self.near or same[-1][1] - same[0][0] > 2 * len(want) + 8:  # words of it, far apart
            return None
        lo, hi = same[0][0], same[-1][1]
        lacking = [w for op, _, _, x, y in ops if op in ("insert", "replace") for w in want[x:y]]
        beyond = [w for op, x, y, _, _ in ops if op == "delete" for w in own[max(x, lo) : min(y, hi)]]
        beyond += [w for op, x, y, p, q in ops if op == "replace" and lo <= x <= hi for w in own[x : y if y <= hi else min(y, x + q - p)]]
        exact = not lacking and not beyond
        return (exact, len(want) if exact else 0, share, saving), (lo, hi, i, "exact" if exact else "variant", saving, lacking, beyond)

    def scan(self, text: str) -> list[Verdict]:
        """Non-overlapping verdicts in text order."""
        out: list[Verdict] = []
        for p in PARAGRAPH.finditer(text):
            if self.cue.search(text, p.start(), p.end()):
                out += self.paragraph(text, p.start(), p.end())
        return out

    def paragraph(self, text: str, a: int, b: int) -> list[Verdict]:
        found = [(m.start(), m.end()) for m in WORD.finditer(text, a, b)]
        own = [text[x:y].lower() for x, y in found]
        starts = [x for x, _ in found]
        at = lambda c: bisect.bisect_left(starts, c)
        cues = sorted({min(bisect.bisect_right(starts, m.start()) - 1 if starts and m.start() >= starts[0] else 0, len(own) - 1) for m in self.cue.finditer(text, a, b)}) if own else []
        taken: list[tuple[int, int]] = []  # word ranges of the accepted statements, in order
        said: dict[int, tuple] = {}

        def free(c: int) -> tuple[int, int] | None:
            """The words about a cue up to accepted statements; none if one holds it."""
            k = bisect.bisect_right(taken, (c, len(own)))
            lo = taken[k - 1][1] if k else 0
            return None if lo > c else (max(lo, c - self.reach), min(taken[k][0] if k < len(taken) else len(own), c + self.reach))

        def accept(lo: int, hi: int, v: tuple) -> None:
            bisect.insort(taken, (lo, hi))
            said[lo] = (hi, *v)

        edge, loose = a, {}
        for m in SEGMENT.finditer(text, a, b):  # a segment's words, up to the end that closes it
            lo, hi, edge = at(edge), at(m.end()), m.end()
            while lo < hi <= lo + 2 * self.reach and bisect.bisect_left(cues, hi) > bisect.bisect_left(cues, lo) and (v := self.judged(own[lo:hi])):
                if v[3] != "exact" or self.begun[v[2]]:
                    loose[lo + v[0]] = (lo + v[1], *v[2:])
                    break
                accept(lo + v[0], lo + v[1], v[2:])
                lo += v[1]
        for c in cues:
            while (span := free(c)) and (v := self.judged(own[span[0] : span[1]])):
                accept(span[0] + v[0], span[0] + v[1], v[2:])
        for lo, (hi, *v) in loose.items():  # what no window has found to be part of something else
            k = bisect.bisect_left(taken, (lo, 0))
            if (k == len(taken) or taken[k][0] >= hi) and (k == 0 or taken[k - 1][1] <= lo):
                accept(lo, hi, tuple(v))
        return [Verdict(found[lo][0], found[hi - 1][1], self.all[said[lo][1]][0], *said[lo][2:]) for lo, hi in taken]


def licences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, start, end, license, verdict, saving, lacking, beyond, wording)``, one row per licence statement.

    Offsets are code points of the whole text. Null, empty and cue-free texts give no row; repeated rows and null ids each
    give theirs; equal savings go by licence name; an empty table gives no rows; other columns are ignored.
    """
    schema = pa.schema([("id", pa.int64()), ("start", pa.int64()), ("end", pa.int64()), ("license", pa.string()), ("verdict", pa.string()), ("saving", pa.float64()), ("lacking", pa.list_(pa.string())), ("beyond", pa.list_(pa.string())), ("wording", pa.string())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner()
        for batch in batches:
            hit = batch.filter(pc.fill_null(pc.match_substring_regex(batch.column(1), CUE), False))
            rows = []
            for i, text in zip(hit.column(0).to_pylist(), hit.column(1), strict=True):
                text = text.as_py()
                rows += [(i, v.start, v.end, v.license, v.verdict, v.saving, v.lacking, v.beyond, text[v.start : v.end]) for v in scanner.scan(text)]
            if rows:
                yield B.batch_of(schema, **dict(zip(schema.names, map(list, zip(*rows, strict=True)), strict=True)))

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(scan, "id long, start long, end long, license string, verdict string, saving double, lacking array<string>, beyond array<string>, wording string")


def op1_license_scan(spark, sf_dir: str) -> DataFrame:
    return licences(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")
