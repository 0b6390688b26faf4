"""Licence scans by sentences and rules.

A text is cut into sentences, and each is normalised: lower case, runs of anything but letters and
digits to one space. Sentences known from licences and their notices become identifiers, the rest
are gaps. Rules are ordered: a sequence of identifiers with at most `max_gap` other sentences between
two of them. Names of holders and works are slots in them. At each place the first rule that matches wins, so longer and more specific rules stand
before their parts; what it covers is not matched again.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

_OTHER = re.compile(r"[^a-z0-9]+")


def normalise(sentence: str) -> str:
    return _OTHER.sub(" ", sentence.lower()).strip()


# Sentences of well-known licences and of the notices that name them. A sentence of
# the text matches if it is the whole known sentence after normalisation.
SENTENCES = {
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions",
    "mit-notice": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software",
    "as-is": "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT",
    "bsd-grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution",
    "bsd-endorse": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "apache-grant": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License",
    "apache-copy": "You may obtain a copy of the License at",
    "apache-as-is": "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied",
    "gpl-free": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "gpl-hope": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE",
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
    "named-mit": "Released under the MIT License",
    "named-mit-2": "Licensed under the MIT License",
    "named-mit-3": "This project is licensed under the MIT License",
    "named-apache": "Licensed under the Apache License, Version 2.0",
    "named-apache-2": "This project is licensed under the Apache License 2.0",
    "named-gpl3": "This work is licensed under the GNU General Public License, version 3",
    "named-gpl3-2": "Licensed under the GNU General Public License v3",
    "named-cc-by": "Licensed under CC BY 4.0",
    "named-cc-by-sa": "Licensed under CC BY-SA 4.0",
    "named-cc-by-nc": "Licensed under CC BY-NC 4.0",
    "named-cc0": "This work is dedicated to the public domain under CC0 1.0",
    "named-bsd": "Released under the BSD License",
    "bsd-endorse#any": "Neither the name of the copyright holder nor the names of any contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "bsd-endorse#contributors": "Neither the name of the copyright holder nor the names of contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "bsd-endorse#other": "Neither the name of the copyright holder nor the names of other contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "bsd-endorse#their": "Neither the name of the copyright holder nor the names of their contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "bsd-endorse#not": "The name of the copyright holder may not be used to endorse or promote products derived from this software without specific prior written permission",
    "bsd-advert": "All advertising materials mentioning features or use of this software must display the following acknowledgement",
    "isc-grant#and": "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
    "0bsd-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
    "mit-0-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so",
    "bsl-grant": "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following",
    "bsl-notice": "Distributed under the Boost Software License, Version 1.0",
    "unlicense": "This is free and unencumbered software released into the public domain",
    "unlicense-anyone": "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means",
    "zlib-grant": "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions",
    "zlib-origin": "The origin of this software must not be misrepresented; you must not claim that you wrote the original software",
    "zlib-altered": "Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software",
    "apache-title": "Apache License Version 2.0, January 2004",
    "mpl2": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "mpl2-title": "Mozilla Public License Version 2.0",
    "mpl11": "The contents of this file are subject to the Mozilla Public License Version 1.1 (the \"License\"); you may not use this file except in compliance with the License",
    "epl2": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at",
    "epl2#v": "This program and the accompanying materials are made available under the terms of the Eclipse Public License v2.0 which accompanies this distribution, and is available at",
    "epl1": "This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0 which accompanies this distribution, and is available at",
    "wtfpl": "DO WHAT THE FUCK YOU WANT TO PUBLIC LICENSE",
    "cc0-waiver": "To the extent possible under law, the person who associated CC0 with this work has waived all copyright and related or neighboring rights to this work",
}
# A part after # tells wordings of one identifier apart.
RULES = [
    ("MIT", ("mit-grant", "mit-notice", "as-is")),
    ("BSD-4-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-advert", "bsd-endorse")),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")),
    ("Apache-2.0", ("apache-grant", "apache-copy", "apache-as-is")),
    ("Apache-2.0", ("apache-grant",)),
    ("GPL-3.0-or-later", ("gpl-free", "gpl-hope")),
    ("GPL-3.0-or-later", ("gpl-free",)),
    ("ISC", ("isc-grant",)),
    ("MIT", ("mit-grant",)),
    ("MIT", ("named-mit",)),
    ("MIT", ("named-mit-2",)),
    ("MIT", ("named-mit-3",)),
    ("Apache-2.0", ("named-apache",)),
    ("Apache-2.0", ("named-apache-2",)),
    ("GPL-3.0-only", ("named-gpl3",)),
    ("GPL-3.0-only", ("named-gpl3-2",)),
    ("CC-BY-4.0", ("named-cc-by",)),
    ("CC-BY-SA-4.0", ("named-cc-by-sa",)),
    ("CC-BY-NC-4.0", ("named-cc-by-nc",)),
    ("CC0-1.0", ("named-cc0",)),
    ("BSD", ("named-bsd",)),
    ("0BSD", ("0bsd-grant",)),
    ("MIT-0", ("mit-0-grant",)),
    ("BSL-1.0", ("bsl-grant",)),
    ("BSL-1.0", ("bsl-notice",)),
    ("Unlicense", ("unlicense", "unlicense-anyone")),
    ("Unlicense", ("unlicense",)),
    ("Zlib", ("zlib-grant", "zlib-origin", "zlib-altered")),
    ("Zlib", ("zlib-grant",)),
    ("Apache-2.0", ("apache-title",)),
    ("MPL-2.0", ("mpl2",)),
    ("MPL-2.0", ("mpl2-title",)),
    ("MPL-1.1", ("mpl11",)),
    ("EPL-2.0", ("epl2",)),
    ("EPL-1.0", ("epl1",)),
    ("WTFPL", ("wtfpl",)),
    ("CC0-1.0", ("cc0-waiver",)),
]
MAX_GAP = 3


def _add(licence: str, identifier: str, texts: list[str], *then: str) -> None:
    """Further wordings of one identifier, and its rules: the sequence with `then`, then it alone.
    Wordings that are known already keep their identifier."""
    known = {normalise(text) for text in SENTENCES.values()}
    new = [text for text in texts if normalise(text) not in known]
    SENTENCES.update({f"{identifier}#{n}": text for n, text in enumerate(new)})
    if new:
        RULES.extend([(licence, (identifier, *then))] * bool(then) + [(licence, (identifier,))])


def _gnu() -> None:
    """Notices and titles of the GNU licences. The work's name is a slot, see `SLOTS`."""
    freely = "This program is free software; you can redistribute it and/or modify it under the terms of"
    by = "as published by the Free Software Foundation"
    for code, name, version, dated in [
        ("GPL-1.0", "General", "1", "February 1989"), ("GPL-2.0", "General", "2", "June 1991"),
        ("GPL-3.0", "General", "3", "29 June 2007"), ("LGPL-2.0", "Library General", "2", "June 1991"),
        ("LGPL-2.1", "Lesser General", "2.1", "February 1999"), ("LGPL-3.0", "Lesser General", "3", "29 June 2007"),
        ("AGPL-3.0", "Affero General", "3", "19 November 2007"),
    ]:
        full, key, versions = f"GNU {name} Public License", code.lower(), {version, code.split("-")[1]}
        later = [f"{freely} the {full} {by}; either version {v} of the License, or (at your option) any later version" for v in versions]
        later += [f"{freely} the {full} {by}; either version {v}, or (at your option) any later version" for v in versions]
        only = [f"{freely} the {full} version {v} {by}" for v in versions]
        only += [f"{freely} the {full} version {v} only, {by}" for v in versions]
        only += [f"{freely} version {v} of the {full} {by}" for v in versions]
        only += [f"{freely} the {full} {by}; version {v} of the License" for v in versions]
        only += [f"{freely} the {full} {by}; version {v}" for v in versions]
        _add(f"{code}-or-later", f"{key}-later", later, "gpl-hope")
        _add(f"{code}-only", f"{key}-only", only, "gpl-hope")
        _add(f"{code}-only", f"{key}-title", [f"{full} Version {version}, {dated}"])


def _named() -> None:
    """Notices that name a licence. How it is given is a slot, see `SLOTS`."""
    names = {
        "MIT": ["the MIT License", "MIT License", "MIT"], "ISC": ["the ISC License", "ISC"],
        "BSD": ["the BSD License", "a BSD License"],
        "Apache-2.0": ["the Apache License, Version 2.0", "the Apache License 2.0", "Apache License 2.0", "Apache 2.0", "the Apache 2.0 License", "Apache-2.0"],
        "BSD-2-Clause": ["the BSD 2-Clause License", "the 2-Clause BSD License", "BSD-2-Clause", "the Simplified BSD License"],
        "BSD-3-Clause": ["the BSD 3-Clause License", "the 3-Clause BSD License", "BSD-3-Clause", "the New BSD License", "the Modified BSD License"],
        "MPL-2.0": ["the Mozilla Public License 2.0", "the Mozilla Public License, Version 2.0", "the Mozilla Public License, v. 2.0", "MPL 2.0", "the MPL 2.0"],
        "EPL-1.0": ["the Eclipse Public License 1.0", "the Eclipse Public License, Version 1.0", "the Eclipse Public License v1.0"],
        "EPL-2.0": ["the Eclipse Public License 2.0", "the Eclipse Public License, Version 2.0", "the Eclipse Public License v2.0"],
        "BSL-1.0": ["the Boost Software License 1.0", "the Boost Software License, Version 1.0"],
        "Unlicense": ["the Unlicense"], "Zlib": ["the zlib License", "the zlib/libpng License"], "WTFPL": ["the WTFPL"],
        "CC0-1.0": ["CC0", "CC0 1.0", "CC0 1.0 Universal", "Creative Commons Zero v1.0 Universal"],
    }
    for code, name, versions in [
        ("GPL", "General", ("2", "3")), ("LGPL", "Lesser General", ("2.1", "3")), ("AGPL", "Affero General", ("3",)),
    ]:
        for v in versions:
            full = [f"the GNU {name} Public License", f"the {code}", code, f"the GNU {code}", f"GNU {code}"]
            forms = [f"{f}{join}{v}{end}" for f in full for join in (" version ", " v", " ") for end in ("", "" if "." in v else ".0")]
            names[f"{code}-{v if '.' in v else v + '.0'}-only"] = forms
            names[f"{code}-{v if '.' in v else v + '.0'}-or-later"] = [f"{f} or{any_} later" for f in forms for any_ in ("", " any")] + [f"{f} or any later version" for f in forms]
    long = {"BY": "Attribution", "SA": "ShareAlike", "NC": "NonCommercial", "ND": "NoDerivatives"}
    for kind in ("BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND"):
        words = "-".join(long[part] for part in kind.split("-"))
        for v in ("1.0", "2.0", "2.5", "3.0", "4.0"):
            wordy = {words, words.replace("NoDerivatives", "NoDerivs")}
            names[f"CC-{kind}-{v}"] = [f"CC {kind} {v}", f"a CC {kind} {v} License", f"the CC {kind} {v} License"] + [
                f"{article} Creative Commons {w} {v}{port} License"
                for article in ("a", "the") for w in wordy for port in ("", " International", " Unported", " Generic")
            ]
    for licence, forms in names.items():
        _add(licence, f"named-{licence.lower()}", [f"Licensed under {form}" for form in forms])

# Names of holders and works, which differ from text to text, become those of the known sentences.
# The first must hold for a sentence to be looked at; a sentence that begins as `_OPEN` and lacks its
# second half may be cut by a name ("Google Inc. nor ..."), so the next pieces are taken in.
SLOTS = [
    ("neither the name", re.compile(r"^neither the names? of .+? nor the names? of"), "neither the name of the copyright holder nor the names of"),
    ("may not be used to endorse", re.compile(r"^the names? of .+? may not be used"), "the name of the copyright holder may not be used"),
    (" is free software", re.compile(r"^.+? is free software(?= you can redistribute|$)"), "this program is free software"),
    (" is distributed in the hope", re.compile(r"^.+? is distributed in the hope"), "this program is distributed in the hope"),
    (" see ", re.compile(r"^((?:this [a-z]+ is )?(?:licensed|released|distributed) under .+?) (?:please )?see (?:the )?(?:accompanying )?(?:licen[cs]e|copying)\b.*$"), r"\1"),
]
SLOTS.append((" under ", re.compile(r"^(?:this [a-z]+ is )?(?:licensed|released|distributed) under (?:the terms of )?"), "licensed under "))
_OPEN = [("neither the name of ", " nor the name"), ("neither the names of ", " nor the name"), ("the name of ", " may not be used"), ("the names of ", " may not be used")]

# A sentence ends at a line break, or at . ! ? : ; before white space or the end of the text. Known
# sentences that this cuts are put together again.
_END = re.compile(r"[.!?:;]+(?=\s|$)|\n")


def _filled(words: str) -> str:
    for sign, pattern, known in SLOTS:
        if sign in words:
            words = pattern.sub(known, words)
    return words


def _name_ends(pieces: list) -> dict[int, int]:
    """For each piece in which a sentence with a name begins and does not go on: the piece in which
    it does, however many pieces the name breaks into. A name holds no second beginning, so all pieces
    are looked through once."""
    begun = [
        (i, goes_on) for i, (words, _, _) in enumerate(pieces) for begins, goes_on in _OPEN
        if f"{words} ".startswith(begins) and goes_on not in words
    ]
    if not begun:
        return {}
    starts = list(accumulate((len(words) + 1 for words, _, _ in pieces), initial=0))
    whole = " ".join(words for words, _, _ in pieces)
    places = {goes_on: [m.start() for m in re.finditer(re.escape(goes_on), whole)] for _, goes_on in begun}
    last_before: dict[tuple[str, int], int] = {}
    for i, goes_on in begun:
        at = bisect_left(places[goes_on], starts[i])
        if at < len(places[goes_on]):
            last_before[goes_on, places[goes_on][at]] = i
    return {i: bisect_left(starts, at + len(goes_on)) - 1 for (goes_on, at), i in last_before.items()}


_gnu()
_named()


@dataclass(frozen=True)
class Sentence:
    identifier: str | None
    start: int
    end: int


class Scanner:
    """Known sentences and ordered rules, compiled."""

    def __init__(self, sentences: dict[str, str], rules: list[tuple[str, tuple[str, ...]]], max_gap: int):
        self.rules, self.max_gap = rules, max_gap
        self.known = {}
        for form in (normalise, lambda text: _filled(normalise(text))):
            for name, text in sentences.items():
                self.known.setdefault(form(text), name.split("#")[0])
        self.prefixes = {" ".join(k.split(" ")[:n]) for k in self.known for n in range(1, len(k.split(" ")) + 1)}
        self.by_first: dict[str, list[int]] = {}
        for i, (_, sequence) in enumerate(rules):
            self.by_first.setdefault(sequence[0], []).append(i)

    def sentences(self, text: str) -> list[Sentence]:
        """The text's sentences with their identifiers. Pieces that together are a known sentence,
        broken over lines or cut at a colon or semicolon, are one; the longest such wins."""
        pieces, at = [], 0
        for end in [*(m.end() for m in _END.finditer(text)), len(text)]:
            words = normalise(text[at:end])
            if words:
                pieces.append((words, at, end))
            at = end
        ends, found, i = _name_ends(pieces), [], 0
        while i < len(pieces):
            best, after = None, i + 1
            if i in ends:
                best, after = self._longest(pieces, i, ends[i])
            # What a name's end turned up too far off is no part of the sentence.
            if best is None:
                best, after = self._longest(pieces, i, i)
            found.append(Sentence(best, pieces[i][1], pieces[after - 1][2]))
            i = after
        return found

    def _longest(self, pieces: list, i: int, last: int) -> tuple[str | None, int]:
        """The longest known sentence that begins with the pieces from `i` to `last`, and the place
        behind it; just those pieces if there is none."""
        words = " ".join(p[0] for p in pieces[i : last + 1])
        for whole in (words, _filled(words)):
            best, after, j = self.known.get(whole), last + 1, last + 1
            if whole in self.prefixes:
                while j < len(pieces) and (whole := f"{whole} {pieces[j][0]}") in self.prefixes:
                    j += 1
                    if whole in self.known:
                        best, after = self.known[whole], j
            if best:
                return best, after
        return None, i + 1

    def scan_text(self, text: str | None) -> list[tuple[str, int, int, int, int]]:
        """(licence, rule number, sentences matched, start, end) of the matches in order; start and
        end are places in the text, the end just after the last matched sentence."""
        if not text:
            return []
        # Gaps are counted in sentences, so only known ones need be kept, with their places.
        marks = [(i, s) for i, s in enumerate(self.sentences(text)) if s.identifier]
        found, at = [], 0
        while at < len(marks):
            for rule in self.by_first.get(marks[at][1].identifier, ()):
                last = self._follow(marks, at, self.rules[rule][1])
                if last is not None:
                    name, sequence = self.rules[rule]
                    found.append((name, rule, len(sequence), marks[at][1].start, marks[last][1].end))
                    at = last
                    break
            at += 1
        return found

    def _follow(self, marks: list, at: int, sequence: tuple[str, ...]) -> int | None:
        """Place of the last identifier of the sequence that begins at `at`, the next one each time
        being the nearest; None if one is missing or too far."""
        for wanted in sequence[1:]:
            here, nxt = marks[at][0], at + 1
            while nxt < len(marks) and marks[nxt][0] - here - 1 <= self.max_gap:
                if marks[nxt][1].identifier == wanted:
                    break
                nxt += 1
            else:
                return None
            at = nxt
        return at


def scan_licences(
    docs: DataFrame,
    sentences: dict[str, str] = SENTENCES,
    rules: list[tuple[str, tuple[str, ...]]] = RULES,
    max_gap: int = MAX_GAP,
) -> DataFrame:
    """One row per match in every row of `docs`: doc_id, match (its number in the text), licence,
    rule, sentences, start and end (in characters).

    Whole texts are read, map-side. Null and empty texts have no match; repeated rows repeat their
    matches; other columns are not read.
    """
    scanner = Scanner(sentences, rules, max_gap)

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.columns
            of, rows = [], []
            for i, text in enumerate(texts):
                for n, match in enumerate(scanner.scan_text(text.as_py())):
                    of.append(i)
                    rows.append((n, *match))
            columns = list(zip(*rows)) or [[]] * 6
            kinds = [pa.int32(), pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int64()]
            arrays = [ids.take(pa.array(of, pa.int64()))]
            arrays += [pa.array(c, k) for c, k in zip(columns, kinds)]
            yield pa.RecordBatch.from_arrays(
                arrays, names=["doc_id", "match", "licence", "rule", "sentences", "start", "end"]
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, match int, licence string, rule int, sentences int, start long, end long"
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(scan, schema)
