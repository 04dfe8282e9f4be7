"""Licence scans: fuzzy search for short notices.

A notice of at most ``k`` edits, cut into ``k + 1`` pieces, keeps at least one
piece whole (pigeonhole). All pieces of all notices form one Aho-Corasick
automaton; where a piece occurs, the ``regex`` library's bounded-error matching
decides, within the stretch that a match around the piece could cover.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import positional
from pyspark.sql import functions as F

#: notice name -> (text, most edits)
NOTICES: dict[str, tuple[str, int]] = {
    "apache-2.0": ("Licensed under the Apache License, Version 2.0", 4),
    "mit": ("Released under the MIT License", 2),
    "gpl-3": ("licensed under the GNU General Public License, version 3", 5),
    "cc-by-nc-4.0": ("Licensed under CC BY-NC 4.0", 2),
    "cc-by-4.0": ("Licensed under CC BY 4.0", 1),
    "cc-by-sa-4.0": ("Licensed under CC BY-SA 4.0", 1),
    "mpl-2.0": ("subject to the terms of the Mozilla Public License, v. 2.0", 5),
    "bsd": ("Redistribution and use in source and binary forms", 4),
    "mit-grant": ("Permission is hereby granted, free of charge, to any person", 5),
    "all-rights-reserved": ("All rights reserved", 1),
    "spdx": ("SPDX-License-Identifier:", 2),
    "gpl-2": ("either version 2 of the License, or (at your option) any later version", 6),
    "lgpl": ("GNU Lesser General Public License", 3),
    "agpl-3": ("GNU Affero General Public License", 3),
    "bsd-endorse": ("may be used to endorse or promote products derived from this software", 6),
    "isc": ("Permission to use, copy, modify, and/or distribute this software", 6),
    "zlib": ("This software is provided 'as-is', without any express or implied warranty", 6),
    "boost-1.0": ("Boost Software License - Version 1.0", 3),
    "epl-2.0": ("Eclipse Public License - v 2.0", 2),
    "unlicense": ("This is free and unencumbered software released into the public domain", 6),
    "cc0-1.0": ("CC0 1.0 Universal", 1),
    "artistic-2.0": ("The Artistic License 2.0", 2),
}


def fold(text: str) -> str:
    """Lower case of the same length, so that spans hold for the text itself."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def pieces(notice: str, edits: int) -> list[tuple[int, str]]:
    """``edits + 1`` pieces of nearly equal length with their places."""
    n, m = len(notice), edits + 1
    if n < m:
        raise ValueError("a notice needs more characters than edits")
    cuts = [round(j * n / m) for j in range(m + 1)]
    return [(a, notice[a:b]) for a, b in zip(cuts, cuts[1:])]


@lru_cache(maxsize=8)
def _machine(notices: tuple[tuple[str, str, int], ...]):
    import ahocorasick
    import regex

    auto, seeds = ahocorasick.Automaton(), {}
    for n, (_, text, edits) in enumerate(notices):
        for at, piece in pieces(fold(text), edits):
            seeds.setdefault(piece, []).append((n, at))
    for piece, where in seeds.items():
        auto.add_word(piece, (len(piece), where))
    auto.make_automaton()
    rx = [regex.compile(f"(?e)(?:{regex.escape(fold(t), special_only=True)}){{e<={k}}}") for _, t, k in notices]
    return auto, rx


def find_notices(text: str, notices: tuple[tuple[str, str, int], ...]) -> list[tuple[str, int, int, int]]:
    """(name, start, end, edits) of each match, by notice and place.

    Stretches that could hold a match are merged and searched from the left;
    matches of one notice don't overlap.
    """
    auto, rx = _machine(notices)
    low = fold(text)
    windows: dict[int, list[list[int]]] = {}
    for last, (length, where) in auto.iter(low):
        begin = last - length + 1
        for n, at in where:
            _, notice, k = notices[n]
            a, b = max(0, begin - at - k), min(len(low), begin - at + len(notice) + k)
            own = windows.setdefault(n, [])
            own.append([a, b])
    found = []
    for n, own in sorted(windows.items()):
        own.sort()
        merged = [own[0]]
        for a, b in own[1:]:
            if a <= merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], b)
            else:
                merged.append([a, b])
        for a, b in merged:
            while (m := rx[n].search(low, a, b)) is not None:
                found.append((notices[n][0], m.start(), m.end(), sum(m.fuzzy_counts)))
                a = max(m.end(), m.start() + 1)
    return found


SCHEMA = "doc_id {id}, notice string, start int, end int, edits int, matched string"


def license_scan(docs: DataFrame, notices: dict[str, tuple[str, int]] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, notice, start, end, edits, matched) for each place of each text that
    is within the notice's number of edits, regardless of case. Positions count
    characters; ``matched`` is the text as it stands.

    One pass over the texts, without a shuffle. Null and empty texts give no row;
    a null id stays null; repeated rows give repeated results; extra columns are
    not read. Different notices may overlap, each is reported; matches of one
    notice don't.
    """
    table = tuple((n, t, k) for n, (t, k) in (notices or NOTICES).items())
    d, (i, t) = positional(docs, id_col, text_col)
    d = d.select(F.col(i).alias("doc_id"), F.col(t).alias("text"))
    out = pa.schema([("notice", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("edits", pa.int32()), ("matched", pa.string())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            take, rows = [], []
            for k, text in enumerate(b.column(1)):
                text = text.as_py()
                if not text:
                    continue
                for name, lo, hi, edits in find_notices(text, table):
                    take.append(k)
                    rows.append((name, lo, hi, edits, text[lo:hi]))
            cols = [pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [[]] * 5, out)]
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(take, pa.int64())), *cols], ["doc_id", *out.names])

    return d.mapInArrow(scan, SCHEMA.format(id=d.schema["doc_id"].dataType.simpleString()))
