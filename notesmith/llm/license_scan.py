"""License scans by conditional compression.

Sentences that mention licensing become candidate blocks. Each block is compressed alone and with every template as a raw
zstandard dictionary; the part of the size that a template saves ranks the templates. The best ``RANKED`` are then
compared word by word: a block is confirmed for the template whose wording it has with the fewest differing words, when
these are few. Single line ends are white space, as notices are usually wrapped; a block with several notices gives one row
for each. Texts are judged one by one, so nothing is shuffled.
"""

from __future__ import annotations

import difflib
import itertools
import re
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from notesmith.llm.common import documents, only, ship

# Usual wordings of notices and grants, as (license, text).
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT license."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
            "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
            "permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                   "compliance with the License. You may obtain a copy of the License at"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
                "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
                "option) any later version."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
                     "that the following conditions are met:"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("proprietary", "All rights reserved."),
)
MENTION = (r"licen[sc]|copyright|permission|redistribut|public\W+domain|creative\W+commons|cc\W+by|all\W+rights\W+reserved|"
           r"free\W+software")
#: Sentences longer than this are read as windows of this many words on either side of a mention.
WINDOW_WORDS = 60
#: Templates compared word by word, the largest share of differing words, and zstandard's level.
RANKED, MOST_DIFFERENT, LEVEL = 4, 0.1, 19

_MENTION = re.compile(MENTION, re.I)
#: Sentences go on over single line ends, so hard-wrapped notices stay whole; the second reading ends them at every line end.
_END = re.compile(r"(?<=[.!?:])\s+|\n\s*\n\s*")
_LINE_END = re.compile(r"(?<=[.!?:])\s+|\n\s*")
_WORD = re.compile(r"[^\W_]+(?:[.+-][^\W_]+)*")


def words_of(text: str) -> list[str]:
    return [w.lower() for w in _WORD.findall(text)]


def blocks_of(text: str, window: int = WINDOW_WORDS, ends: re.Pattern = _END) -> list[tuple[int, int]]:
    """(start, end) in code points of the candidate blocks: sentences with a mention, joined where they follow each other."""
    out: list[list[int]] = []
    cuts = [0, *[m.end() for m in ends.finditer(text)], len(text)]
    sentence = 0
    for m in _MENTION.finditer(text):
        while cuts[sentence + 1] <= m.start():
            sentence += 1
        a, b = cuts[sentence], cuts[sentence + 1]
        if b - a > 8 * window:  # only then can the sentence have more words than the window
            before = [w.start() for w in re.finditer(r"\S+", text[max(a, m.start() - 40 * window):m.start()])]
            after = [w.end() for w in re.finditer(r"\S+", text[m.start():min(b, m.start() + 40 * window)])]
            lo = max(a, m.start() - 40 * window)
            a, b = lo + before[-window] if len(before) > window else lo, m.start() + after[min(window, len(after)) - 1]
        if out and a <= out[-1][1]:
            out[-1][1] = max(b, out[-1][1])
        else:
            out.append([a, b])
    return [(a, a + len(text[a:b].rstrip())) for a, b in out]


@lru_cache(maxsize=8)
def _tools(templates: tuple, level: int):
    import zstandard

    def made(raw: bytes | None):
        d = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT) if raw else None
        return zstandard.ZstdCompressor(level=level, dict_data=d, write_checksum=False, write_content_size=False, write_dict_id=False)

    return made(None), [made(text.encode()) for _, text in templates], [words_of(text) for _, text in templates]


def differences(wanted: list[str], found: list[str]) -> int:
    """Differing words between a template and the part of a block it lies in: words changed, left out or put between."""
    ops = difflib.SequenceMatcher(None, wanted, found, autojunk=False).get_opcodes()
    if ops and ops[0][0] == "insert":
        ops = ops[1:]
    if ops and ops[-1][0] == "insert":
        ops = ops[:-1]
    n = 0
    for k, (op, a, b, c, d) in enumerate(ops):
        if op != "equal":
            # At either end of the template, block words beyond as many as the template lacks are not its wording.
            n += b - a if k in (0, len(ops) - 1) else max(b - a, d - c)
    return n


def judge(block: str, templates: tuple = TEMPLATES, ranked: int | None = RANKED, level: int = LEVEL,
          most: float = MOST_DIFFERENT) -> tuple:
    """(license, template number, plain size, conditional size, differing words, confirmed) of a block."""
    plain, given, wordings = _tools(templates, level)
    data = block.encode("utf-8", "surrogatepass")
    alone = len(plain.compress(data))
    sizes = sorted((len(c.compress(data)), k) for k, c in enumerate(given))
    found = words_of(block)
    best = None
    for size, k in sizes[:ranked]:
        n = differences(wordings[k], found)
        share = n / len(wordings[k])
        # Of confirmed templates the one that explains most words wins, then fewer differences, then the smaller size.
        rank = (share > most, -(len(wordings[k]) - n) if share <= most else share, n, size, k)
        if best is None or rank < best[0]:
            best = (rank, k, size, n, share <= most)
    _, k, size, n, ok = best
    return templates[k][0], k, alone, size, n, ok


def _extent(block: str, wording: list[str]) -> tuple[int, int]:
    """(start, end) of the part of a block that a template's wording lies in."""
    at = [m.span() for m in _WORD.finditer(block)]
    same = [x for x in difflib.SequenceMatcher(None, wording, words_of(block), autojunk=False).get_matching_blocks() if x.size]
    return at[same[0].b][0], at[same[-1].b + same[-1].size - 1][1]


def notices(text: str, templates: tuple = TEMPLATES) -> list[tuple[int, int, tuple]]:
    """(start, end, ``judge``) of every block, in order.

    A block may hold several notices. What lies before and behind a confirmed one is read again, and a block that is not
    confirmed is read line by line; a block is divided only where that confirms a further notice.
    """
    window = max(WINDOW_WORDS, *(len(w) for w in _tools(templates, LEVEL)[2]))
    out, todo = [], [(a, b, True) for a, b in blocks_of(text, window)]
    while todo:
        a, b, first = todo.pop()
        got = judge(text[a:b], templates)
        if not got[-1]:
            lines = [(a + c, a + d) for c, d in blocks_of(text[a:b], window, _LINE_END)]
            parts = [(c, d, judge(text[c:d], templates)) for c, d in lines] if lines != [(a, b)] else []
            if any(part[2][-1] for part in parts):
                out += parts
            elif first:
                out.append((a, b, got))
            continue
        c, d = _extent(text[a:b], words_of(templates[got[1]][1]))
        rest = [(lo + x, lo + y) for lo, hi in ((a, a + c), (a + d, b)) for x, y in blocks_of(text[lo:hi], window)]
        out.append((a, b, got))
        todo += [(x, y, False) for x, y in rest]
    # A block ends where a further notice inside it starts, and starts where one ends.
    out.sort(key=lambda r: (r[0], -r[1]))
    return _apart(text, out, templates)


def _apart(text: str, found: list[tuple[int, int, tuple]], templates: tuple) -> list[tuple[int, int, tuple]]:
    out = []
    for k, (a, b, got) in enumerate(found):
        inner = []
        for c, d, _ in itertools.islice(found, k + 1, None):
            if c >= b:
                break
            inner.append((c, d))
        if inner:
            c, d = _extent(text[a:b], words_of(templates[got[1]][1]))
            lo = max([y for _, y in inner if y <= a + c], default=a)
            hi = min([x for x, _ in inner if x >= a + d], default=b)
            lo += len(text[lo:hi]) - len(text[lo:hi].lstrip())
            a, b = lo, lo + len(text[lo:hi].rstrip())
            got = judge(text[a:b], templates)
        out.append((a, b, got))
    return sorted(out, key=lambda r: r[:2])


def license_scan(docs: DataFrame, templates: tuple = TEMPLATES) -> DataFrame:
    """One row per candidate block: doc_id, block, start, end (code points, end exclusive), license, template, plain_bytes,
    conditional_bytes, reduction, n_different, confirmed.

    Null, empty and plain texts have no blocks. Repeated rows give repeated blocks; a null doc_id is passed on. Texts are
    read whole at any length. Ties between templates fall to the earlier one. Other columns, whatever their names, are
    not read. An empty table gives no rows.
    """
    ship(docs.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for doc_id, text in zip(pdf["doc_id"].array, pdf["text"]):
                for k, (a, b, (lic, t, plain, size, n, ok)) in enumerate(notices(text, templates)):
                    rows.append((doc_id, k, a, b, lic, t, plain, size, 1 - size / plain, n, ok))
            yield pd.DataFrame(rows, columns=["doc_id", "block", "start", "end", "license", "template", "plain_bytes",
                                              "conditional_bytes", "reduction", "n_different", "confirmed"])

    # As text, so that a null id survives pandas.
    t = only(docs, "doc_id", "text").where(F.col("text").rlike("(?i)" + MENTION))
    t = t.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    out = t.mapInPandas(run, "doc_id string, block int, start int, end int, license string, template int, plain_bytes int, "
                             "conditional_bytes int, reduction double, n_different int, confirmed boolean")
    return out.withColumn("doc_id", F.col("doc_id").cast("long"))


def op1_license_scan(spark, sf_dir: str) -> DataFrame:
    return license_scan(documents(spark, sf_dir))
