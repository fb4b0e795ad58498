"""License scans by conditional compression.

A block of text that holds a license compresses better when the compressor already knows the license. Blocks around words that occur
in license notices are compressed alone and with each template as a raw dictionary. Templates are ranked by the bytes saved, relative
to what it saves on itself, and a winner is confirmed by the differences between its words and the block's.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressroom.llm import words

_FOUNDATION = "as published by the Free Software Foundation"
_GNU = "This {2} is free software{0} you can redistribute it and/or modify it under the terms of the GNU {1} License " + _FOUNDATION
_CREATIVE = {
    "BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-NC": "Attribution-NonCommercial", "BY-ND": "Attribution-NoDerivatives",
    "BY-NC-SA": "Attribution-NonCommercial-ShareAlike", "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives",
}
_UNDER = "This work is licensed under the "

#: Notices, standard headers, titles and opening sentences, as the licenses or their stewards word them. Each license and
#: version has its own; what follows a license's name or identifier tells several wordings of one license apart.
TEMPLATES = {
    "Apache-1.1": "Licensed under the Apache License, Version 1.1.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. "
    "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "Apache-2.0-title": "Apache License Version 2.0, January 2004 http://www.apache.org/licenses",
    "Artistic-1.0": "Released under the Artistic License 1.0.",
    "Artistic-1.0-title": 'The "Artistic License" Preamble The intent of this document is to state the conditions under which a Package may be copied',
    "Artistic-2.0": "Released under the Artistic License 2.0.",
    "BSD": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "BSD-notice": "Released under the BSD License.",
    "BSD-2-Clause": "Released under the BSD 2-Clause License.",
    "BSD-3-Clause": "Released under the BSD 3-Clause License.",
    "BSL-1.0": "Distributed under the Boost Software License, Version 1.0.",
    "CC0-1.0": "CC0 1.0 Universal Public Domain Dedication, licensed by Creative Commons.",
    "CC0-1.0-title": "Creative Commons Legal Code CC0 1.0 Universal",
    "EPL-1.0": "made available under the terms of the Eclipse Public License v1.0",
    "EPL-2.0": "made available under the terms of the Eclipse Public License 2.0",
    "GPL-header": _GNU.format(":", "General Public", "program"),
    "LGPL-header": _GNU.format(";", "Lesser General Public", "library"),
    "LGPL-2.0-header": _GNU.format(";", "Library General Public", "library"),
    "AGPL-header": _GNU.format(":", "Affero General Public", "program"),
    "GFDL-header": "Permission is granted to copy, distribute and/or modify this document under the terms of the GNU Free Documentation License",
    "GFDL-1.2-title": "GNU Free Documentation License Version 1.2, November 2002",
    "GFDL-1.3-title": "GNU Free Documentation License Version 1.3, 3 November 2008",
    "GPL-1.0-title": "GNU GENERAL PUBLIC LICENSE Version 1, February 1989",
    "GPL-2.0-title": "GNU GENERAL PUBLIC LICENSE Version 2, June 1991",
    "GPL-3.0-title": "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
    "LGPL-2.0-title": "GNU LIBRARY GENERAL PUBLIC LICENSE Version 2, June 1991",
    "LGPL-2.1-title": "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999",
    "LGPL-3.0-title": "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
    "AGPL-3.0-title": "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007",
    "ISC": "Released under the ISC License.",
    "ISC-permission": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
    "provided that the above copyright notice and this permission notice appear in all copies.",
    "MIT": "Released under the MIT License.",
    "MIT-permission": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    "MPL-1.1": "The contents of this file are subject to the Mozilla Public License Version 1.1",
    "MPL-1.1-title": "MOZILLA PUBLIC LICENSE Version 1.1 1. Definitions",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "MPL-2.0-title": "Mozilla Public License Version 2.0 1. Definitions",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "Zlib": "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely",
    "reserved": "All rights reserved.",
}
TEMPLATES |= {f"GPL-{v}.0": f"{_UNDER}GNU General Public License, version {v}." for v in (1, 2, 3)}
TEMPLATES |= {f"LGPL-{v}": f"{_UNDER}GNU Lesser General Public License, version {v}." for v in ("2.1", "3.0")}
TEMPLATES |= {"AGPL-3.0": f"{_UNDER}GNU Affero General Public License, version 3.", "LGPL-2.0": f"{_UNDER}GNU Library General Public License, version 2."}
for _v, _kind in (("2.0", "Generic"), ("2.5", "Generic"), ("3.0", "Unported"), ("4.0", "International")):
    for _short, _long in _CREATIVE.items():
        TEMPLATES[f"CC-{_short}-{_v}-notice"] = f"Licensed under CC {_short} {_v}."
        TEMPLATES[f"CC-{_short}-{_v}"] = f"This work is licensed under a Creative Commons {_long} {_v} {_kind} License."
# the names these had first
TEMPLATES["CC-BY-NC-4.0-license"] = TEMPLATES["CC-BY-NC-4.0"]
TEMPLATES["CC-BY-NC-4.0"] = TEMPLATES.pop("CC-BY-NC-4.0-notice")
#: Words that tell licenses apart, besides numbers: a run with others of them than the template, or with one more or less, is another license.
NAMES = frozenset(
    "apache artistic bsd boost isc mit mozilla eclipse gnu gpl lgpl agpl lesser library affero documentation unencumbered cc cc0 "
    "attribution sharealike noncommercial noderivatives noderivs nc nd sa".split()
)
#: Words near which a notice may stand.
CUE = re.compile(r"licen[cs]e|copyright|rights\W{1,8}reserved|spdx|permission|redistribut|general\W{1,8}public|creative\W{1,8}commons|free\W{1,8}software|unencumbered|\bcc0\b", re.IGNORECASE)
#: A block reaches so many characters to both sides of a cue, for templates of up to so many characters: what a short notice
#: saves would be lost in a long block. Blocks that grow together beyond BLOCK are cut, with the same overlap.
REACH, BLOCK = {40: 40, 100: 100, 1000: 320}, 8000
#: Least share that a template saves of what it saves on itself, and most differing words for each hundred of its words.
LEAST_SAVED, MOST_DIFFERENT = 0.25, 12
#: A template of so many words with a name or number among them may always differ in one word, as no other license is meant by it.
ONE_DIFFERENT = 5

_FOUND = "array<struct<license:string,start:long,end:long,saved:double,differences:long>>"
_WORD = re.compile(r"[^\W_]+")
#: A version that goes on after its first number, other than by zeros.
_GOES_ON = re.compile(r"\.0*[1-9]")


def blocks(text: str, reach: int, most: int = BLOCK) -> list[tuple[int, int]]:
    """The parts of a text around its cues."""
    out: list[list[int]] = []
    for m in CUE.finditer(text):
        start, end = max(0, m.start() - reach), min(len(text), m.end() + reach)
        if out and start <= out[-1][1] and end - out[-1][0] <= 3 * reach:
            out[-1][1] = end
        else:
            out.append([start, end])
    return [(a, min(a + most, end)) for start, end in out for a in range(start, max(start + 1, end - reach), most - reach)]


def differences(template: list[str], block: list[str]) -> tuple[int, int, int]:
    """The fewest changed, missing or added words that turn the template into some run of the block's words, and that run."""
    row = [(0, j) for j in range(len(block) + 1)]
    for i, word in enumerate(template, 1):
        after = [(i, row[0][1])]
        for j, other in enumerate(block, 1):
            change = (row[j - 1][0] + (word != other), row[j - 1][1])
            after.append(min(change, (row[j][0] + 1, row[j][1]), (after[j - 1][0] + 1, after[j - 1][1])))
        row = after
    best = min(range(len(row)), key=lambda j: (row[j][0], j))
    return row[best][0], row[best][1], best


def telling(wording: list[str]) -> list[str]:
    """The names and numbers of a wording, versions without their v and zeros."""
    numbers = (re.sub(r"^v(?=\d)", "", word) for word in wording)
    return [word for word in numbers if word in NAMES or (any(c.isdigit() for c in word) and word.strip("0"))]


def runs(template: list[str], block: list[str], start: int = 0) -> Iterator[tuple[int, int, int]]:
    """All runs of the block that come near enough to the template and name the same license, none of which overlap: the best, then those
    before and after it."""
    different, first, last = differences(template, block)
    names = telling(template)
    if last > first and (100 * different <= MOST_DIFFERENT * len(template) or (different == 1 and names and len(template) >= ONE_DIFFERENT)):
        if telling(block[first:last]) == names:
            yield different, start + first, start + last
        yield from runs(template, block[:first], start)
        yield from runs(template, block[last:], start + last)


class Compressor:
    """Compressed sizes, alone and with each template known."""

    def __init__(self):
        # the same search for all, whatever the sizes of block and template are, so that only the dictionary makes a difference
        search = zstandard.ZstdCompressionParameters(
            window_log=16, chain_log=16, hash_log=16, search_log=6, min_match=3, target_length=256, strategy=zstandard.STRATEGY_BTULTRA2,
            write_content_size=False, write_checksum=False, write_dict_id=False,
        )
        self.alone = zstandard.ZstdCompressor(compression_params=search)
        self.known, self.worth, self.wording = {}, {}, {}
        for name, template in TEMPLATES.items():
            self.wording[name] = _WORD.findall(template.lower())
            plain = " ".join(self.wording[name]).encode()
            data = zstandard.ZstdCompressionDict(plain, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            self.known[name] = zstandard.ZstdCompressor(compression_params=search, dict_data=data)
            self.worth[name] = len(self.alone.compress(plain)) - len(self.known[name].compress(plain))
        self.names, least = {}, 0
        for most, reach in REACH.items():
            self.names[reach] = [name for name, template in TEMPLATES.items() if least < len(template) <= most]
            least = most

    def ranked(self, block: bytes, reach: int) -> list[tuple[float, str]]:
        """The templates that blocks of this reach are for, by what they save, the best first."""
        size = len(self.alone.compress(block))
        saved = [((size - len(self.known[name].compress(block))) / self.worth[name], name) for name in self.names[reach]]
        return sorted((x for x in saved if x[0] >= LEAST_SAVED), key=lambda x: (-x[0], x[1]))


def licenses_of(text: str, compressor: Compressor) -> list[dict]:
    """The confirmed licenses of a text with their places; of those that overlap, the one with the most agreeing words."""
    found = []
    for reach, (start, end) in ((r, b) for r in REACH.values() for b in blocks(text, r)):
        places = [(m.group().lower(), start + m.start(), start + m.end()) for m in _WORD.finditer(text[start:end])]
        block = [word for word, _, _ in places]
        for saved, name in compressor.ranked(" ".join(block).encode(), reach):
            wording = compressor.wording[name]
            for different, first, last in runs(wording, block):
                if wording[-1][-1].isdigit() and _GOES_ON.match(text, places[last - 1][2]):
                    continue
                found.append((different - len(wording), places[first][1], places[last - 1][2], name, saved, different))
    out: list[dict] = []
    for _, start, end, name, saved, different in sorted(set(found)):
        if not any(x["start"] < end and start < x["end"] for x in out):
            out.append({"license": name, "start": start, "end": end, "saved": round(saved, 6), "differences": different})
    return sorted(out, key=lambda x: x["start"])


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    compressor = Compressor()
    kind = pa.list_(pa.struct([("license", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("saved", pa.float64()), ("differences", pa.int64())]))
    for piece in words.pieces(batches, "text"):
        found = [licenses_of(text, compressor) if text else [] for text in piece.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(found, kind)], ["doc_id", "licenses"])


def license_scan(docs: DataFrame) -> DataFrame:
    """``docs (doc_id, text)`` to ``(doc_id, licenses)``, one row for each row of ``docs``.

    ``licenses`` are ``(license, start, end, saved, differences)`` by place, in code points, the end exclusive. Null and empty texts have none.
    Rows with equal or null ids are documents of their own; other columns are ignored; an empty table gives no rows.
    """
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_scan, f"doc_id long, licenses {_FOUND}")
