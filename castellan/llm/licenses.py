"""License scans by conditional compression.

Lines with a licensing cue, and the lines between two of them at most ``gap`` apart, are a candidate block. Each template serves as a raw
zstandard dictionary: what it says costs next to nothing to say again, so the templates are ranked by how much smaller each makes the block. In
this order they are aligned with the block word by word, but for those of which the block lacks more than ``tolerance`` of the words
wherever they stand (they cannot be confirmed); the one of fewest differing words wins if these are at most ``tolerance`` of its
words, and the differences are reported. A long block is read in frames of a few times the longest template, so the work grows with its length.

Cases: a null or empty text has no block; whole texts are scanned; a block may hold several notices, found one after another; repeated rows give
repeated rows; an empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from difflib import SequenceMatcher
from functools import lru_cache

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CUES = re.compile(r"licen[cs]|copyright|permission|redistribut|warrant|rights reserved|public domain|creative commons|spdx|\bcc[ -]by|as is", re.I)

# Public license notices, short and in full, by SPDX identifier.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ),
    "GPL-2.0": (
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    "LGPL-3.0": (
        "This work is licensed under the GNU Lesser General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    "AGPL-3.0": (
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    "MPL-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",),
    "BSD-3-Clause": (
        "Released under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    ),
    "BSD-2-Clause": (
        "Released under the BSD 2-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    ),
    "Zlib": ("This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution.",),
    "BSL-1.0": ("Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so.",),
    "ISC": ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",),
    "CC-BY-4.0": ("Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "CC-BY-SA-4.0": ("Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    "CC-BY-ND-4.0": ("Licensed under CC BY-ND 4.0.",),
    "CC0-1.0": ("This work has been dedicated to the public domain under CC0 1.0 Universal.",),
    "Unlicense": ("This is free and unencumbered software released into the public domain.",),
    "Proprietary": ("All rights reserved.",),
}
EDGES = ".,;:!?()\"'"


def plain_words(text: str) -> list[str]:
    return [w.strip(EDGES).lower() for w in text.split()]


class Templates:
    """Compressors primed with each template, its words and how often it has each."""

    def __init__(self, templates: dict[str, tuple[str, ...]]):
        self.plain = zstandard.ZstdCompressor(level=3)
        self.known = []
        for name, texts in templates.items():
            for t in texts:
                words = plain_words(t)
                primed = zstandard.ZstdCompressionDict(" ".join(words).encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                self.known.append((name, words, Counter(words), zstandard.ZstdCompressor(level=3, dict_data=primed)))
        self.longest = max(len(words) for _, words, _, _ in self.known)

    def ranked(self, words: list[str], tolerance: float) -> tuple[int, list[tuple[int, str, list[str]]]]:
        """The block's own compressed size, and (reduction, name, words), greatest first, of the templates of which it has enough words."""
        has = Counter(words)
        able = [(name, t, c) for name, t, n, c in self.known if sum(max(0, k - has[w]) for w, k in n.items()) <= tolerance * len(t)]
        if not able:
            return 0, []
        data = " ".join(words).encode("utf-8", "surrogatepass")
        size = len(self.plain.compress(data))
        found = [(size - len(c.compress(data)), name, t) for name, t, c in able]
        return size, sorted(found, key=lambda x: (-x[0], x[1], len(x[2])))


def differences(template: list[str], words: list[str]) -> tuple[int, int, int, int]:
    """Missing and extra words of the best alignment, and the words [first, last) that it spans."""
    same = [b for b in SequenceMatcher(None, words, template, autojunk=False).get_matching_blocks() if b.size]
    if not same:
        return len(template), 0, 0, 0
    first, last = same[0].a, same[-1].a + same[-1].size
    matching = sum(b.size for b in same)
    return len(template) - matching, last - first - matching, first, last


@lru_cache(maxsize=1)
def all_templates() -> Templates:
    return Templates(TEMPLATES)


def blocks_of(text: str, gap: int) -> list[tuple[int, int]]:
    """Code point spans of the candidate blocks."""
    spans: list[tuple[int, int]] = []
    if not CUES.search(text):
        return spans
    at, since = 0, gap + 1
    for line in text.split("\n"):
        if CUES.search(line):
            if spans and since <= gap:
                spans[-1] = (spans[-1][0], at + len(line))
            else:
                spans.append((at, at + len(line)))
            since = 0
        else:
            since += 1
        at += len(line) + 1
    return spans


Word = tuple[int, int, str]


def best_notice(words: list[Word], tolerance: float) -> tuple[int, int, dict] | None:
    """The first and last word of the notice that differs least, and what is reported of it."""
    plain = [w for *_, w in words]
    size, ranked = all_templates().ranked(plain, tolerance)
    found = []
    for reduction, name, template in ranked:
        missing, extra, first, last = differences(template, plain)
        if missing + extra <= tolerance * len(template):
            found.append((missing + extra - len(template), -reduction, name, missing, extra, first, last))
    if not found:
        return None
    _, reduction, name, missing, extra, first, last = min(found)
    return first, last, {"license": name, "start": words[first][0], "end": words[last - 1][1], "missing": missing, "extra": extra, "plain_bytes": size, "saved_bytes": -reduction}


def notices_in(text: str, start: int, end: int, tolerance: float) -> Iterator[dict]:
    """Confirmed notices within a block, frame by frame: the best one of a frame, then what the words before and after it hold.

    A notice that starts where its end may lie beyond the frame is looked at again in a frame that starts with it."""
    words = [(m.start() + start, m.end() + start, m[0].strip(EDGES).lower()) for m in re.finditer(r"\S+", text[start:end])]
    longest = 2 * all_templates().longest
    frames = [(0, len(words))]  # (from, to) of what is still to be read
    while frames:
        a, b = frames.pop()
        frame = words[a : min(b, a + 2 * longest)]
        if len(frame) < 2:
            continue
        more = a + len(frame) < b
        best = best_notice(frame, tolerance)
        if best is None:
            frames += [(a + len(frame) - longest, b)] if more else []
        elif more and best[0] > len(frame) - longest:
            frames += [(a + best[0], b), (a, a + best[0])]
        else:
            yield best[2]
            frames += [(a + best[1], b), (a, a + best[0])]


def scan_licenses(docs: DataFrame, *, id: str = "doc_id", text: str = "text", gap: int = 2, tolerance: float = 0.2) -> DataFrame:
    """id, n_blocks, and notices (license, start, end in code points, missing and extra words, plain_bytes, saved_bytes) by start."""
    fields = [("license", pa.string()), *((n, pa.int64()) for n in ("start", "end", "missing", "extra", "plain_bytes", "saved_bytes"))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, notices = [], []
            for t in b.column(1).to_pylist():
                spans = blocks_of(t or "", gap)
                n.append(len(spans))
                notices.append(sorted((x for s, e in spans for x in notices_in(t, s, e, tolerance)), key=lambda x: (x["start"], x["end"])))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(notices, pa.list_(pa.struct(fields)))], ["id", "n_blocks", "notices"])

    kind = docs.schema[id].dataType.simpleString()
    of = ",".join(f"{n}:{'string' if t == pa.string() else 'bigint'}" for n, t in fields)
    return docs.select(F.col(id).alias("id"), F.col(text).alias("text")).mapInArrow(run, f"id {kind}, n_blocks bigint, notices array<struct<{of}>>")
