"""License scans by conditional compression.

Candidate blocks are the stretches of ``REACH`` bytes on both sides of a hint
word, whatever the line breaks; overlapping ones merge.  A block is compressed
alone and once with each template that its words can hold as a raw zstandard
dictionary; templates are ranked by the relative reduction.  All are confirmed by exact wording, best first: a template's words are aligned with the
block's wherever they lie, the share of words that differ must stay below a limit,
and words that name the license or its version must match.

Everything happens per text in the scan; nothing is shuffled.

Null and empty text: no candidate.  Null doc_id and repeated rows: a row each.
Empty table: no rows.
"""

from __future__ import annotations

import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_CC = "Creative Commons Attribution"
_GNU = (("GPL", "General Public License"), ("LGPL", "Lesser General Public License"), ("AGPL", "Affero General Public License"))
_VERSIONS = {"GPL": ("3.0", "2.0"), "LGPL": ("3.0", "2.1"), "AGPL": ("3.0",)}
#: Standard notices, headings and SPDX lines of well-known licenses by SPDX identifier.
_NOTICES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except"
                   " in compliance with the License."),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "The MIT License (MIT)"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and"
            " associated documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("ISC", "Licensed under the ISC License."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is"
            " hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0-only", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0-only", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("LGPL-2.1-only", "This work is licensed under the GNU Lesser General Public License, version 2.1."),
    ("AGPL-3.0-only", "This work is licensed under the GNU Affero General Public License, version 3."),
    *((f"{short}-{version}-only", f"Licensed under the GNU {name}, version {version}.")
      for short, name in _GNU for version in _VERSIONS[short]),
    ("GPL-3.0-only", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("GPL-2.0-only", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("LGPL-3.0-only", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("LGPL-2.1-only", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"),
    ("AGPL-3.0-only", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    *((f"{short}-{version}-or-later", f"you can redistribute it and/or modify it under the terms of the GNU {name} as published"
       f" by the Free Software Foundation, either version {version.removesuffix('.0')} of the License, or (at your option)"
       " any later version.")
      for short, name in _GNU for version in _VERSIONS[short]),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted"
                     " provided that the following conditions are met"),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-NC-ND-4.0", "Licensed under CC BY-NC-ND 4.0."),
    *((f"CC-BY{short}-4.0", f"This work is licensed under a {_CC}{name} 4.0 International License.")
      for short, name in (("", ""), ("-SA", "-ShareAlike"), ("-NC", "-NonCommercial"), ("-ND", "-NoDerivatives"),
                          ("-NC-SA", "-NonCommercial-ShareAlike"), ("-NC-ND", "-NonCommercial-NoDerivatives"))),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights to this work."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("MPL-2.0", "Licensed under the Mozilla Public License, Version 2.0."),
)
_SPDX = sorted({name for name, _ in _NOTICES} | {
    n.replace("-only", "-or-later") for n, _ in _NOTICES if n.endswith("-only")})
TEMPLATES = (*_NOTICES, *((name, f"SPDX-License-Identifier: {name}") for name in _SPDX))
HINTS = (b"licen", b"copyright", b"spdx", b"released under", b"redistribut", b"permission is hereby", b"permission to use",
         b"cc by", b"cc-by", b"cc0")
REACH = 320            # bytes kept on each side of a hint
MAX_DIFFERENT = 0.12   # share of template words that may differ; one word may in any template with two free words
LEVEL = 9
_BREAK = r"\r?\n[\s#*/;]*"   # line break after a hyphen inside a word
_WORD = re.compile(rf"(?:[\w.+-]|(?<=\w-){_BREAK}(?=\w))*\w")
_VERSION = re.compile(r"v?\.?(\d+(?:\.\d+)*?)(?:\.0)*")
#: Words that name a license or its version: they must match, and no other of them may come between.
_NAME = re.compile(r"apache|mit|isc|gnu|general|lesser|affero|mozilla|bsd|creative|attribution.*|sharealike|noncommercial"
                   r"|noderivatives|cc|cc0|by-.*|cc-by.*|spdx-license-identifier|\d+(\.\d+)*|\d-clause")
#: What makes a notice of one version one of later versions too.
_LATER = re.compile(r"\+(?!\w)|\W+(?:of\W+the\W+license\W+)?or\W+(?:at\W+your\W+option\W+)?(?:any\W+)?(?:later|newer)(?:\W+version)?\b", re.I)
_FAR = 1 << 30


def words_of(text: str) -> tuple[list[str], list[tuple[int, int]]]:
    """Lower-case words (versions without v and final .0) and their places."""
    found = list(_WORD.finditer(text))
    low = [re.sub(_BREAK, "", m[0]).lower() for m in found]
    return [v[1] if (v := _VERSION.fullmatch(w)) else w for w in low], [m.span() for m in found]


def alignments(words: list[str], wanted: list[str], fixed: list[bool], limit: int) -> list[tuple[int, int, int]]:
    """(words that differ, first word, one past the last word) of places of ``words`` that do not overlap and hold
    ``wanted`` with at most ``limit`` words replaced, missing or added; the best first, none of the ``fixed`` differing.
    If there is any such place, at least one is returned."""
    m = len(wanted)
    named = any(fixed)
    skip = [_FAR if f else 1 for f in fixed]
    top = [0] * (m + 1)
    for j in range(m):
        top[j + 1] = min(_FAR, top[j] + skip[j])
    # cost, first word of the place and one past its last matching word
    cost, first, last = top, [-1] * (m + 1), [-1] * (m + 1)
    ends = []
    for i, w in enumerate(words):
        name = named and _NAME.fullmatch(w) is not None
        c, f, e = [0], [-1], [-1]
        for j in range(m):
            if w == wanted[j]:
                best, bf, be = cost[j], first[j] if first[j] >= 0 else i, i + 1
            elif name or fixed[j]:
                best, bf, be = _FAR, -1, -1
            else:
                best, bf, be = cost[j] + 1, first[j], last[j]
            if c[j] + skip[j] < best:
                best, bf, be = c[j] + skip[j], f[j], e[j]
            if not name and cost[j + 1] + 1 < best:
                best, bf, be = cost[j + 1] + 1, first[j + 1], last[j + 1]
            c.append(min(best, _FAR))
            f.append(bf)
            e.append(be)
        cost, first, last = c, f, e
        if c[m] <= limit and f[m] >= 0:
            ends.append((c[m], f[m], e[m]))
    got = []
    for hit in sorted(set(ends), key=lambda x: (x[0], x[1], -x[2])):
        if all(hit[2] <= a or hit[1] >= b for _, a, b in got):
            got.append(hit)
    return got


class Scanner:
    def __init__(self, templates=TEMPLATES):
        import zstandard as z

        settings = z.ZstdCompressionParameters.from_level(LEVEL, write_content_size=0, write_checksum=0, write_dict_id=0)
        self.plain = z.ZstdCompressor(compression_params=settings)
        self.templates = []
        for name, body in templates:
            raw = z.ZstdCompressionDict(body.encode(), dict_type=z.DICT_TYPE_RAWCONTENT)
            words = words_of(body)[0]
            fixed = [_NAME.fullmatch(w) is not None or (w == "by" and words[i - 1] == "cc") for i, w in enumerate(words)]
            limit = max(int(MAX_DIFFERENT * len(words)), int(fixed.count(False) >= 2))
            self.templates.append((name, words, z.ZstdCompressor(compression_params=settings, dict_data=raw), fixed, limit,
                                   Counter(words), {w for w, x in zip(words, fixed, strict=True) if x}))

    def reductions(self, block: bytes, numbers) -> list[tuple[float, int]]:
        """(relative size reduction, template number), best first; equal ones by number."""
        alone = len(self.plain.compress(block))
        gains = [(1 - len(self.templates[i][2].compress(block)) / alone, i) for i in numbers]
        return sorted(gains, key=lambda g: (-g[0], g[1]))

    def ranked(self, block: bytes) -> list[tuple[float, int]]:
        """The templates that reduce the block, as ``reductions``."""
        return [g for g in self.reductions(block, range(len(self.templates))) if g[0] > 0]

    def possible(self, number: int, count: Counter) -> bool:
        """Whether words that occur so often can hold the template: no place does if not."""
        _, words, _, _, limit, wanted, fixed = self.templates[number]
        if any(w not in count for w in fixed):
            return False
        return sum(max(0, n - count[w]) for w, n in wanted.items()) <= limit

    def confirm(self, block: str) -> list[tuple[int, int, int, float]]:
        """(start, end, template number, reduction, words that differ) of all notices in the block that do not overlap.

        Every template that the block's words can hold is aligned, the one with the greatest reduction first; after
        each place found, the rest left and right of it again, until nothing more is found."""
        words, at = words_of(block)
        count = Counter(words)
        numbers = [i for i in range(len(self.templates)) if self.possible(i, count)]
        if not numbers:
            return []
        free, out = [(0, len(words))], []
        for gain, number in self.reductions(block.encode(), numbers):
            _, wanted, _, fixed, limit, _, _ = self.templates[number]
            left, todo = [], free
            while todo:
                lo, hi = todo.pop()
                part = words[lo:hi]
                hits = alignments(part, wanted, fixed, limit) if self.possible(number, Counter(part)) else []
                if not hits:
                    left.append((lo, hi))
                    continue
                edge = lo
                for different, a, b in sorted(hits, key=lambda x: x[1]):
                    out.append((at[lo + a][0], at[lo + b - 1][1], number, gain, different))
                    todo.append((edge, lo + a))
                    edge = lo + b
                todo.append((edge, hi))
            free = left
        return out

    def blocks(self, text: str) -> list[tuple[int, str]]:
        """(start in code points, block) of the candidates, overlapping ones merged."""
        raw = text.encode()
        low = raw.lower()
        spans = []
        for hint in HINTS:
            at = low.find(hint)
            while at >= 0:
                spans.append((max(0, at - REACH), min(len(raw), at + len(hint) + REACH)))
                at = low.find(hint, at + len(hint))
        merged = []
        for a, b in sorted(spans):
            if merged and a <= merged[-1][1]:
                merged[-1][1] = max(b, merged[-1][1])
            else:
                merged.append([a, b])
        out = []
        for a, b in merged:
            while a < b and (raw[a] & 0xC0) == 0x80:   # cut between code points
                a += 1
            while b < len(raw) and (raw[b] & 0xC0) == 0x80:
                b += 1
            out.append((len(raw[:a].decode()), raw[a:b].decode()))
        return out

    def scan(self, text: str) -> tuple[int, list[tuple[int, int, str, float, int]]]:
        """Number of candidates and (start, end, license, reduction, words different) of the confirmed."""
        got = []
        candidates = self.blocks(text)
        for start, block in candidates:
            for a, b, number, gain, different in self.confirm(block):
                name = self.templates[number][0]
                later = _LATER.match(block, b) if name.endswith("-only") else None
                if later:
                    name, b = name.removesuffix("-only") + "-or-later", later.end()
                got.append((start + a, start + b, name, gain, different))
        return len(candidates), sorted(got)


SCHEMA = ("doc_id long, n_candidates long, matches array<struct<start: bigint, end: bigint, license: string, "
          "reduction: double, words_different: bigint>>")


def _scan(templates):
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("license", pa.string()),
                               ("reduction", pa.float64()), ("words_different", pa.int64())]))
    names = ("start", "end", "license", "reduction", "words_different")

    def run(batches):
        scanner = Scanner(templates)
        for batch in batches:
            got = [scanner.scan(t.as_py() or "") for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([g[0] for g in got], pa.int64()),
                 pa.array([[dict(zip(names, m, strict=True)) for m in g[1]] for g in got], kind)],
                ["doc_id", "n_candidates", "matches"])

    return run


def scan_licenses(docs: DataFrame, templates=TEMPLATES, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_candidates, matches: the license notices of every text, by position."""
    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(
        _scan(tuple(templates)), SCHEMA)


def license_query(docs: DataFrame) -> DataFrame:
    """Digest: doc_id, n_candidates, n_matches, licenses (distinct, sorted), spans."""
    return scan_licenses(docs).select(
        "doc_id", "n_candidates", F.size("matches").cast("long").alias("n_matches"),
        F.array_join(F.array_sort(F.array_distinct("matches.license")), ",").alias("licenses"),
        F.array_join(F.transform("matches", lambda m: F.concat_ws(
            ":", m["license"], m["start"].cast("string"), m["end"].cast("string"))), ",").alias("spans"))
