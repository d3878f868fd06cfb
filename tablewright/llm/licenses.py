"""Licence notices: fixed phrases, and templates with optional and replaceable regions."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Sequence
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame

from tablewright.llm.common import slices, take

#: Phrases and their labels.
PHRASES = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)

#: Wordings of common notices. <<beginOptional>> ... <<endOptional>> may be absent;
#: <<var;n>> stands for 1 to n words of any kind.
TEMPLATES = (
    ("mit", "<<beginOptional>>released<<endOptional>> <<beginOptional>>licensed<<endOptional>> under the <<beginOptional>>terms of the<<endOptional>> mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of <<var;6>> and associated documentation files"),
    ("apache-2", "<<beginOptional>>licensed under the<<endOptional>> apache license <<beginOptional>>version<<endOptional>> 2 <<beginOptional>>0<<endOptional>>"),
    ("cc-by-nc", "<<beginOptional>>licensed under<<endOptional>> cc by nc <<beginOptional>><<var;1>> 0<<endOptional>>"),
    ("cc-by-nc", "creative commons attribution <<beginOptional>>non<<endOptional>> noncommercial <<beginOptional>><<var;1>> 0<<endOptional>> <<beginOptional>>international<<endOptional>> license"),
    ("cc-by-nc", "creative commons attribution non commercial <<beginOptional>><<var;1>> 0<<endOptional>> <<beginOptional>>international<<endOptional>> license"),
    ("cc-by", "creative commons attribution <<beginOptional>><<var;1>> 0<<endOptional>> <<beginOptional>>international<<endOptional>> license"),
    ("gpl-3", "gnu general public license <<beginOptional>>as published by the free software foundation<<endOptional>> <<beginOptional>>either<<endOptional>> version 3"),
    ("gpl-2", "gnu general public license <<beginOptional>>as published by the free software foundation<<endOptional>> <<beginOptional>>either<<endOptional>> version 2"),
    ("lgpl", "gnu lesser general public license"),
    ("agpl-3", "gnu affero general public license"),
    ("mpl-2", "mozilla public license <<beginOptional>>v<<endOptional>> <<beginOptional>>version<<endOptional>> 2 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("bsd", "under the <<beginOptional>>terms of the<<endOptional>> bsd <<beginOptional>><<var;1>> clause<<endOptional>> license"),
    ("isc", "permission to use copy modify and <<beginOptional>>or<<endOptional>> distribute this software for any purpose with or without fee is hereby granted"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("proprietary", "<<beginOptional>>copyright <<beginOptional>>c<<endOptional>> <<var;6>><<endOptional>> all rights reserved"),
)

#: Whole texts of common licences, in their public wording. Names and years are replaceable,
#: titles and notices that are often left out are optional.
TEXTS = (
    ("mit", """<<beginOptional>>MIT License<<endOptional>>
        <<beginOptional>>Copyright <<beginOptional>>(c)<<endOptional>> <<var;12>><<endOptional>>
        Permission is hereby granted, free of charge, to any person obtaining a copy of <<var;8>> and associated documentation files
        <<beginOptional>>(the "Software")<<endOptional>>, to deal in <<var;2>> without restriction, including without limitation the rights to
        use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of <<var;2>>, and to permit persons to whom
        <<var;2>> is furnished to do so, subject to the following conditions:
        The above copyright notice and this permission notice <<beginOptional>>(including the next paragraph)<<endOptional>> shall be
        included in all copies or substantial portions of <<var;2>>.
        <<var;2>> IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
        MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL <<var;12>> BE LIABLE FOR ANY CLAIM,
        DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH
        <<var;2>> OR THE USE OR OTHER DEALINGS IN <<var;2>>."""),
    ("isc", """<<beginOptional>>ISC License<<endOptional>> <<beginOptional>>Copyright <<beginOptional>>(c)<<endOptional>> <<var;16>><<endOptional>>
        Permission to use, copy, modify, <<beginOptional>>and<<endOptional>><<beginOptional>>/or<<endOptional>> distribute this software for
        any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
        THE SOFTWARE IS PROVIDED "AS IS" AND <<var;12>> DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED
        WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL <<var;12>> BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR
        CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT,
        NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
    ("bsd", """<<beginOptional>>Copyright <<beginOptional>>(c)<<endOptional>> <<var;16>><<endOptional>> <<beginOptional>>All rights reserved.<<endOptional>>
        Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
        conditions are met: <<beginOptional>><<var;1>><<endOptional>> Redistributions of source code must retain the above copyright notice,
        this list of conditions and the following disclaimer. <<beginOptional>><<var;1>><<endOptional>> Redistributions in binary form must
        reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other
        materials provided with the distribution. <<beginOptional>><<beginOptional>><<var;1>><<endOptional>> Neither the name of <<var;12>> nor
        the names of its contributors may be used to endorse or promote products derived from this software without specific prior
        written permission.<<endOptional>>
        THIS SOFTWARE IS PROVIDED BY <<var;12>> "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED
        WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL <<var;12>> BE LIABLE FOR ANY
        DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF
        SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF
        LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF
        THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""),
    ("zlib", """<<beginOptional>>Copyright <<beginOptional>>(c)<<endOptional>> <<var;16>><<endOptional>>
        This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any
        damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including
        commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:
        <<beginOptional>><<var;1>><<endOptional>> The origin of this software must not be misrepresented; you must not claim that you wrote
        the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated
        but is not required. <<beginOptional>><<var;1>><<endOptional>> Altered source versions must be plainly marked as such, and must not
        be misrepresented as being the original software. <<beginOptional>><<var;1>><<endOptional>> This notice may not be removed or
        altered from any source distribution."""),
    ("apache-2", """<<beginOptional>>Copyright <<var;16>><<endOptional>> Licensed under the Apache License, Version 2.0 (the "License"); you may not use this
        file except in compliance with the License. You may obtain a copy of the License at <<beginOptional>>http://www.apache.org/licenses/LICENSE-2.0<<endOptional>>
        <<beginOptional>>https://www.apache.org/licenses/LICENSE-2.0<<endOptional>>
        Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS,
        WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing
        permissions and limitations under the License."""),
    ("gpl-3", """<<beginOptional>>This program is<<endOptional>> free software: you can redistribute it and/or modify it under the terms of the GNU General
        Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.
        This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of
        MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.
        <<beginOptional>>You should have received a copy of the GNU General Public License along with this program.<<endOptional>>"""),
    ("unlicense", """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile,
        sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or
        non-commercial, and by any means. <<beginOptional>>In jurisdictions that recognize copyright laws, the author or authors of this
        software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of
        the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of
        relinquishment in perpetuity of all present and future rights to this software under copyright law.<<endOptional>>
        THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
        MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM,
        DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE
        SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
)


def unpunctuated(template: str) -> str:
    """A text's words with its mark-up, which is left as it is."""
    return re.sub(r"(<<[^>]*>>)|[^<A-Za-z0-9\u0080-\U0010ffff]+|<", lambda m: f" {m[1] or ''} ", template)


NOTICES = (*TEMPLATES, *((label, unpunctuated(text)) for label, text in TEXTS))

_SEPARATOR = bytes.maketrans(
    bytes(range(256)),
    bytes(
        32 if not (0x30 <= b <= 0x39 or 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A or b >= 0x80)
        else b + 32 if 0x41 <= b <= 0x5A
        else b
        for b in range(256)
    ),
)


def words_in(text: bytes) -> list[bytes]:
    """Words of letters, digits and all beyond ASCII; A to Z in lower case."""
    return text.translate(_SEPARATOR).split()


class Automaton(NamedTuple):
    """States of one template: what each word leads to, what any word leads to, where it ends."""

    label: str
    start: frozenset[int]
    by_word: tuple[dict[bytes, frozenset[int]], ...]
    by_any: tuple[frozenset[int], ...]
    final: frozenset[int]
    mandatory: int

    def longest(self, words: list[bytes], at: int) -> tuple[int, int] | None:
        """End of the longest accepted run from ``at``, and how many words matched by wording."""
        states: dict[int, int] = dict.fromkeys(self.start, 0)
        best = None
        while states:
            if done := [n for s, n in states.items() if s in self.final]:
                best = at, max(done)
            if at == len(words):
                break
            after: dict[int, int] = {}
            for s, n in states.items():
                for t in self.by_word[s].get(words[at], ()):
                    after[t] = max(after.get(t, 0), n + 1)
                for t in self.by_any[s]:
                    after[t] = max(after.get(t, 0), n)
            states, at = after, at + 1
        return best


def compile_template(label: str, template: str) -> Automaton:
    """A token automaton without empty moves.

    The template is read from its end, so that what may follow each word is
    known when the word is met: an optional region adds what follows it to
    what may come instead of it. Mandatory words match exactly; a replaceable
    region takes 1 to n words.
    """
    parts = re.findall(r"<<[^>]*>>|[^<\s]+", template)
    edges: list[list[tuple[bytes | None, frozenset[int]]]] = []
    accept = -1
    ends = {accept}
    # ``entry``: states in which a reader may stand before the part to come; state k has the edges[k]
    entry = frozenset(ends)
    outer: list[frozenset[int]] = []
    mandatory = depth = 0

    def add(word: bytes | None, to: frozenset[int]) -> frozenset[int]:
        edges.append([(word, to)])
        return frozenset({len(edges) - 1})

    for part in reversed(parts):
        if part == "<<endOptional>>":
            outer.append(entry)
            depth += 1
        elif part == "<<beginOptional>>":
            entry |= outer.pop()
            depth -= 1
        elif m := re.fullmatch(r"<<var;(\d+)>>", part):
            after = entry
            for k in range(int(m[1])):
                entry = add(None, after if k == 0 else after | entry)
        elif part.startswith("<<"):
            raise ValueError(f"unknown mark-up {part}")
        else:
            entry = add(part.lower().encode(), entry)
            mandatory += not depth
    if outer:
        raise ValueError(f"regions of {template!r} don't close")
    if not mandatory or accept in entry:
        raise ValueError(f"nothing in {template!r} is mandatory")
    by_word, by_any = [], []
    for moves in edges:
        words: dict[bytes, frozenset[int]] = {}
        anything: frozenset[int] = frozenset()
        for word, to in moves:
            if word is None:
                anything |= to
            else:
                words[word] = words.get(word, frozenset()) | to
        by_word.append(words)
        by_any.append(anything)
    by_word.append({})  # the accepting state, number -1
    by_any.append(frozenset())
    last = len(edges)
    number = lambda states: frozenset(last if s == accept else s for s in states)
    return Automaton(
        label,
        number(entry),
        tuple({w: number(to) for w, to in words.items()} for words in by_word),
        tuple(number(x) for x in by_any),
        frozenset({last}),
        mandatory,
    )


class Match(NamedTuple):
    """A notice in a text: words ``start`` to ``end`` (exclusive); ``exact`` of them by wording."""

    label: str
    start: int
    end: int
    exact: int


class Scanner:
    """All phrases and templates, by the words they may begin with."""

    def __init__(self, phrases: Sequence[tuple[str, str]], templates: Sequence[tuple[str, str]]) -> None:
        self.phrases: dict[bytes, list[tuple[list[bytes], str]]] = {}
        for phrase, label in phrases:
            words = phrase.encode().split()
            self.phrases.setdefault(words[0], []).append((words, label))
        self.templates: dict[bytes, list[Automaton]] = {}
        for label, template in templates:
            automaton = compile_template(label, template)
            first = {w for s in automaton.start for w in automaton.by_word[s]}
            if any(automaton.by_any[s] for s in automaton.start):
                raise ValueError(f"{template!r} must begin with a word")
            for word in first:
                self.templates.setdefault(word, []).append(automaton)
        # a text without any first word that is rare enough to tell holds nothing
        firsts = {w for w in [*self.phrases, *self.templates]}
        self.any_first = re.compile(b"|".join(re.escape(w) for w in sorted(firsts)))

    def base(self, words: list[bytes], places: Iterable[int]) -> list[Match]:
        out = []
        for i in places:
            for phrase, label in self.phrases.get(words[i], ()):
                if words[i : i + len(phrase)] == phrase:
                    out.append(Match(label, i, i + len(phrase), len(phrase)))
        return out

    def notices(self, words: list[bytes], places: Iterable[int]) -> list[Match]:
        out = []
        for i in places:
            for automaton in self.templates.get(words[i], ()):
                if found := automaton.longest(words, i):
                    out.append(Match(automaton.label, i, *found))
        return out

    def scan(self, text: bytes) -> tuple[int, list[Match], list[Match]]:
        """Number of words, base matches, matches of templates."""
        plain = text.translate(_SEPARATOR)
        words = plain.split()
        if not self.any_first.search(plain):
            return len(words), [], []
        places = [i for i, w in enumerate(words) if w in self.phrases or w in self.templates]
        return len(words), self.base(words, places), self.notices(words, places)


def scan_licenses(
    docs: DataFrame,
    phrases: Sequence[tuple[str, str]] = PHRASES,
    templates: Sequence[tuple[str, str]] = NOTICES,
) -> DataFrame:
    """Licence notices in every row.

    Returns doc_id, n_words, n_base (places of phrases), first_word and
    last_word (smallest and largest start of these, else null), base_labels,
    labels (with those of templates; both distinct, sorted and joined by
    commas, empty if none), spans (label, start, end of each match of a
    template, ends exclusive) and score: 0 without any match, else the largest
    share of a match's words that its wording fixes. A template matches
    anywhere in a text; of several ends the longest counts. NOTICES has short notices
    and whole texts of licences. Null and empty texts have no
    words. Rows that repeat are scanned each; doc_id may be null.
    """
    scanner = Scanner(phrases, templates)

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, to, data, offsets in slices(batch.column("text")):
                joined, rows = data.tobytes(), []
                for low, high in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
                    n, base, more = scanner.scan(joined[low:high])
                    starts = [m.start for m in base]
                    known = {m.label for m in base}
                    rows.append(
                        (
                            n,
                            len(base),
                            min(starts, default=None),
                            max(starts, default=None),
                            ",".join(sorted(known)),
                            ",".join(sorted(known | {m.label for m in more})),
                            [{"label": m.label, "start": m.start, "end": m.end} for m in more],
                            max((m.exact / (m.end - m.start) for m in [*base, *more]), default=0.0),
                        )
                    )
                columns = [
                    pa.array(values, kind) for values, kind in zip(zip(*rows), [t for _, t in _SCHEMA])
                ]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(at, to - at), *columns], ["doc_id", *[n for n, _ in _SCHEMA]]
                )

    rows = take(docs, "doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        scan,
        f"doc_id {kind}, n_words long, n_base long, first_word long, last_word long, base_labels string,"
        " labels string, spans array<struct<label: string, start: long, end: long>>, score double",
    )


_SCHEMA = (
    ("n_words", pa.int64()),
    ("n_base", pa.int64()),
    ("first_word", pa.int64()),
    ("last_word", pa.int64()),
    ("base_labels", pa.string()),
    ("labels", pa.string()),
    ("spans", pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))),
    ("score", pa.float64()),
)
