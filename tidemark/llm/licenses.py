"""License notices by conditional compression.

A template is cut into one piece more than the words that may differ, so every stretch that may be
confirmed holds one of its pieces word for word. Candidate blocks are the words around all pieces. Every
template with a piece in a block claims the stretches there that differ from it in few words. A stretch
is compressed by zstandard alone and again with the template as a raw dictionary, and what the dictionary
saves ranks the claims: the one that saves most takes its words, then the next one that still has them free.
The words that differ are what confirms a claim, and they are reported. A block may hold several notices.

The word that holds a license's version must be there. A claim without it is ranked behind all others and
reported as another version of the license, not as the license.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from difflib import SequenceMatcher

import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Short notices as their licenses ask for them, or as they are in common use. A year stands for any year.
_BSD = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"
_BSD_2 = _BSD + " 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
_GNU = "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {} as published by the Free Software Foundation, either version {} of the License, or (at your option) any later version."
TEMPLATES = {
    "AGPL-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "AGPL-3.0 (file header)": _GNU.format("Affero General Public License", "3"),
    "All rights reserved": "All rights reserved.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0 (file header)": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    "BSD (conditions not given)": _BSD,
    "BSD-2-Clause": _BSD_2,
    "BSD-2-Clause (name)": "Released under the BSD 2-Clause License.",
    "BSD-3-Clause": _BSD_2 + " 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "BSD-3-Clause (name)": "Released under the BSD 3-Clause License.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-NC-ND-4.0": "Licensed under CC BY-NC-ND 4.0.",
    "CC-BY-NC-SA-4.0": "Licensed under CC BY-NC-SA 4.0.",
    "CC-BY-ND-4.0": "Licensed under CC BY-ND 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC0-1.0": "Licensed under CC0 1.0.",
    "CC0-1.0 (waiver)": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "Copyright": "Copyright 2000",
    "Copyright (c)": "Copyright (c)",
    "Copyright (sign)": "Copyright ©",
    "Copyright (sign and year)": "© 2000",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-2.0 (file header)": _GNU.format("General Public License", "2"),
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0 (file header)": _GNU.format("General Public License", "3"),
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "ISC (name)": "Released under the ISC License.",
    "LGPL-2.1": "This work is licensed under the GNU Lesser General Public License, version 2.1.",
    "LGPL-2.1 (file header)": _GNU.format("Lesser General Public License", "2.1").replace("program", "library"),
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "LGPL-3.0 (file header)": _GNU.format("Lesser General Public License", "3"),
    "MIT": "Released under the MIT License.",
    "MIT (permission)": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "Public domain": "in the public domain",
    "Public domain (dedicated)": "dedicated to the public domain",
    "Public domain (released)": "released into the public domain",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "Unlicense (name)": "Released under the Unlicense.",
    "Apache-2.0 (heading)": "Apache License Version 2.0",
    "AGPL-3.0 (short)": "GNU Affero General Public License v3",
    "GPL-2.0 (short)": "GNU General Public License v2",
    "GPL-3.0 (short)": "GNU General Public License v3",
    "LGPL-2.1 (short)": "GNU Lesser General Public License v2.1",
    "LGPL-3.0 (short)": "GNU Lesser General Public License v3",
    "MIT (heading)": "The MIT License",
    "MIT (name)": "MIT License",
}
# Names that stand in the license line of a source file.
SPDX = (
    "AGPL-3.0-only", "AGPL-3.0-or-later", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "CC-BY-4.0", "CC-BY-SA-4.0", "CC0-1.0", "GPL-2.0-only",
    "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later", "ISC", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later",
    "MIT", "MPL-2.0", "Unlicense",
)
TEMPLATES |= {f"{name} (file line)": f"SPDX-License-Identifier: {name}" for name in SPDX}
OTHER = " (other version)"
RIGHTS = ("All rights reserved", "Copyright", "Public domain")  # names of statements that grant no license begin so
LEVEL = 3
DIFFERENT = 0.2  # of the template's words, at most

_WORD = re.compile(r"\S+")
_STRIP = ".,;:()[]\"'*#/-"
_YEAR = "(?:19|20)[0-9]{2}(?:[-–](?:(?:19|20)?[0-9]{2})?)?"
_IS_YEAR = re.compile(_YEAR)
_SPACE = r"\s\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def _plain(word: str) -> str:
    return word.lower().strip(_STRIP) or word


def _key(word: str) -> str:
    """What words are compared by: any year is like any other."""
    word = _plain(word)
    return "<year>" if _IS_YEAR.fullmatch(word) else word


def version_words(words: list[str]) -> set[int]:
    """Places of the words of a template that tell versions of a license apart: a number with a point in it or
    after "version" or "v", "v3" and "2-clause". Numbers of conditions are none."""
    found = set()
    for i, word in enumerate(words):
        number = re.fullmatch(r"(v?)([0-9]+(?:\.[0-9]+)*)(-clause)?", word)
        if number and (number[1] or number[3] or "." in number[2] or (i and words[i - 1] in ("version", "v"))):
            found.add(i)
    return found


def pieces(words: list[str]) -> list[tuple[str, ...]]:
    """One piece more than the words that may differ: at least one is whole in any stretch that is confirmed."""
    parts = int(DIFFERENT * len(words)) + 1
    cuts = [len(words) * i // parts for i in range(parts + 1)]
    return [tuple(words[a:b]) for a, b in zip(cuts[:-1], cuts[1:])]


def mark(templates: dict[str, str]) -> str:
    """Pattern (Java and Python) that finds a piece of any template; pieces that begin alike share a branch."""
    strip = re.escape(_STRIP)
    gap = f"[{strip}]*[{_SPACE}]+[{strip}]*"
    one = lambda word: _YEAR if word == "<year>" else re.escape(word)
    tree: dict[str, dict[str, set[str]]] = {}
    for text in templates.values():
        for first, *rest in pieces([_key(w) for w in text.split()]):
            tree.setdefault(first[0], {}).setdefault(first, set()).add("".join(gap + one(w) for w in rest))
    by_letter = []
    for _, by_word in sorted(tree.items()):
        words = [one(first) + f"(?:{'|'.join(sorted(rests))})" for first, rests in sorted(by_word.items())]
        by_letter.append(f"(?={'[12]' if '<year>' in by_word else re.escape(min(by_word)[0])})(?:{'|'.join(words)})")
    return f"(?i)(?<![^{_SPACE}{strip}])(?:{'|'.join(by_letter)})(?![^{_SPACE}{strip}])"


class Scanner:
    def __init__(self, templates: dict[str, str]):
        self.names = sorted(templates)
        texts = [" ".join(templates[n].lower().split()) for n in self.names]
        self.words = [[_key(w) for w in t.split()] for t in texts]
        self.versions = [version_words(w) for w in self.words]
        self.reach = max(len(w) + int(DIFFERENT * len(w)) for w in self.words)
        self.pieces: dict[str, dict[tuple[str, ...], set[int]]] = {}
        for j, words in enumerate(self.words):
            for piece in pieces(words):
                self.pieces.setdefault(piece[0], {}).setdefault(piece, set()).add(j)
        plain = zstandard.ZstdCompressor(level=LEVEL, write_content_size=False)
        self.alone = lambda data: len(plain.compress(data))
        self.with_one = []
        for text in texts:
            held = zstandard.ZstdCompressionDict(text.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            self.with_one.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=held, write_content_size=False, write_dict_id=False))

    def blocks(self, text: str) -> Iterator[tuple[list[str], list[tuple[int, int]], set[int]]]:
        """Words, their places and the templates with a piece there; stretches that overlap are one block."""
        places = [m.span() for m in _WORD.finditer(text)]
        keys = [_key(text[a:b]) for a, b in places]
        marks = []
        for at, word in enumerate(keys):
            for piece, owners in self.pieces.get(word, {}).items():
                if tuple(keys[at : at + len(piece)]) == piece:
                    marks.append((at, owners))
        near: list[list[int]] = []
        for at, _ in marks:
            lo, hi = max(0, at - self.reach), min(len(places), at + self.reach + 3)
            if near and lo <= near[-1][1]:
                near[-1][1] = hi
            else:
                near.append([lo, hi])
        for lo, hi in near:
            step = 4 * self.reach  # long blocks come in stretches that overlap by more than a template
            for start in range(lo, hi, step):
                end = min(hi, start + step + 2 * self.reach)
                part = places[start:end]
                yield [text[a:b] for a, b in part], part, set().union(*(owners for at, owners in marks if start <= at < end))

    def scan(self, text: str) -> list[tuple]:
        """(license, kind, first character, end, bytes saved, words missing, words extra), by place."""
        found: dict[tuple, tuple] = {}
        for words, places, owners in self.blocks(text):
            plain, keys = [_plain(w) for w in words], [_key(w) for w in words]
            free = [True] * len(plain)
            hits = {j: [self.ranked(j, words, h) for h in self.confirm(j, plain, keys, free)] for j in sorted(owners)}
            while any(hits.values()):
                (other, less, _, j), (lo, hi, missing, extra) = min((h for mine in hits.values() for h in mine), key=lambda h: (h[0], h[1][0]))
                free[lo:hi] = [False] * (hi - lo)
                key = (places[lo][0], places[hi - 1][1])
                name, kind = self.names[j] + OTHER * other, "rights" if self.names[j].startswith(RIGHTS) else "license"
                lost = " ".join(self.words[j][i] for i in missing)
                found.setdefault(key, (name, kind, *key, -less, lost, " ".join(extra)))
                for k, mine in hits.items():
                    kept = [h for h in mine if h[1][1] <= lo or hi <= h[1][0]]
                    if len(kept) < len(mine):  # what is left of a stretch may still be a notice: look around the words taken
                        left, span = list(free), 2 * len(self.words[k])
                        for _, (a, b, *_) in kept:
                            left[a:b] = [False] * (b - a)
                        again = self.confirm(k, plain, keys, left, max(0, lo - span), min(len(keys), hi + span))
                        hits[k] = kept + [self.ranked(k, words, h) for h in again]
        out: list[tuple] = []
        for hit in sorted(found.values(), key=lambda h: (h[2], -h[3])):
            if not out or hit[2] >= out[-1][3]:
                out.append(hit)
        return out

    def ranked(self, j: int, words: list[str], hit: tuple) -> tuple[tuple, tuple]:
        """A stretch behind what ranks it, least first: another version, bytes saved (negative), differing words, name."""
        lo, hi, missing, extra = hit
        data = " ".join(words[lo:hi]).lower().encode()
        less = len(self.with_one[j].compress(data)) - self.alone(data)
        return (not self.versions[j].isdisjoint(missing), less, len(missing) + len(extra), j), hit

    def confirm(
        self, j: int, plain: list[str], keys: list[str], free: list[bool], first: int = 0, last: int | None = None
    ) -> Iterator[tuple[int, int, list[int], list[str]]]:
        """Stretches of free words that differ from template j in few words and begin at ``first`` to ``last``:
        places of the template's words that are missing, and the words that it does not have."""
        template, most = self.words[j], DIFFERENT * len(self.words[j])
        rare = set(template)
        left = list(free)
        for start in range(first, len(keys) if last is None else last):
            if not left[start] or keys[start] not in rare or (start and left[start - 1] and keys[start] != template[0] and keys[start - 1] in rare):
                continue
            lo = -1
            while lo != start:  # words before the first that agrees are not of the notice
                start = max(start, lo)
                end = start
                while end < len(keys) and left[end] and end - start < len(template) + int(most):
                    end += 1
                blocks = [b for b in SequenceMatcher(None, template, keys[start:end], autojunk=False).get_matching_blocks() if b.size]
                lo = start + blocks[0].b
            hi = start + blocks[-1].b + blocks[-1].size
            same = {b.a + i for b in blocks for i in range(b.size)}
            inside = {start + b.b + i for b in blocks for i in range(b.size)}
            missing = [i for i in range(len(template)) if i not in same]
            extra = [plain[i] for i in range(lo, hi) if i not in inside]
            if len(missing) + len(extra) <= most:
                left[lo:hi] = [False] * (hi - lo)
                yield lo, hi, missing, extra


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: dict[str, str] | None = None) -> DataFrame:
    """One row for each notice found: doc_id, nth (from 0), license, kind (``rights`` for statements that grant
    no license, else ``license``), begin, end (characters), saved (bytes that the template saves on
    these words), missing, extra (differing words; both empty: exact).

    Only texts with a piece of a template go to Python. Notices do not overlap. Defined results: null and
    empty texts, and texts without a notice, have no row; a notice whose version is of no template has the
    nearest name and ``(other version)``; of equal claims the first name wins;
    repeated rows give repeated results; an empty table gives an empty table. Other columns are not read.
    """
    known = dict(templates or TEMPLATES)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scanner = Scanner(known)
        for part in parts:
            rows = [(i, n, *hit) for i, text in zip(part["doc_id"], part["text"]) for n, hit in enumerate(scanner.scan(text))]
            yield pd.DataFrame(rows, columns=["doc_id", "nth", "license", "kind", "begin", "end", "saved", "missing", "extra"])

    texts = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).filter(F.col("text").rlike(mark(known)))
    kind = df.schema[id_col].dataType.simpleString()
    return texts.mapInPandas(run, f"doc_id {kind}, nth int, license string, kind string, begin bigint, end bigint, saved int, missing string, extra string")
