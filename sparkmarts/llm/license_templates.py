"""License recognition by template markup.

A license text is written as a template of words with markup:
``[...]`` is an optional region, ``{a|b}`` one of several wordings, and ``<n>``
a replaceable region of at most n words. Each template is compiled to an
automaton over words; a place in a document is accepted when the mandatory
wording matches exactly. Automata run only where the template's first
mandatory words stand."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame

from sparkmarts.llm.common import WORD_BYTES, map_slices, texts_of

# Phrases with their labels, and public license wordings.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

TEMPLATES = {
    "Apache-2.0": [
        "{licensed|released|distributed} under the [terms of the] apache license [version] 2 0",
        """licensed under the apache license version 2 0 the license you may not use this file except in compliance
        with the license [you may obtain a copy of the license at <12>] unless required by applicable law or agreed to
        in writing software distributed under the license is distributed on an as is basis without warranties or
        conditions of any kind either express or implied see the license for the specific language governing
        permissions and limitations under the license""",
        "spdx license identifier apache 2 0",
    ],
    "BSD-2-Clause": [
        """redistribution and use in source and binary forms with or without modification are permitted provided that
        the following conditions are met [1] redistributions of source code must retain the above copyright notice this
        list of conditions and the following disclaimer [2] redistributions in binary form must reproduce the above
        copyright notice this list of conditions and the following disclaimer in the documentation and or other
        materials provided with the distribution this software is provided by <12> as is""",
        "spdx license identifier bsd 2 clause",
    ],
    "BSD-3-Clause": [
        """redistribution and use in source and binary forms with or without modification are permitted provided that
        the following conditions are met [1] redistributions of source code must retain the above copyright notice this
        list of conditions and the following disclaimer [2] redistributions in binary form must reproduce the above
        copyright notice this list of conditions and the following disclaimer in the documentation and or other
        materials provided with the distribution [3] neither the name of <12> may be used to endorse or promote
        products derived from this software without specific prior written permission""",
        "spdx license identifier bsd 3 clause",
    ],
    "CC-BY-4.0": ["licensed under [a] {cc by|creative commons attribution} 4 0 [international license]"],
    "CC-BY-NC-4.0": [
        "licensed under [a] {cc by nc|creative commons attribution noncommercial} 4 0 [international license]",
        "spdx license identifier cc by nc 4 0",
    ],
    "GPL-2.0": [
        """licensed under [the terms of] the gnu general public license version 2""",
        """free software you can redistribute it and or modify it under the terms of the gnu general public license as
        published by the free software foundation {either version 2 of the license or at your option any later version|
        version 2 of the license}""",
        "spdx license identifier gpl 2 0 [{only|or later}]",
    ],
    "GPL-3.0": [
        """licensed under [the terms of] the gnu general public license version 3""",
        """free software you can redistribute it and or modify it under the terms of the gnu general public license as
        published by the free software foundation {either version 3 of the license or at your option any later version|
        version 3 of the license}""",
        "spdx license identifier gpl 3 0 [{only|or later}]",
    ],
    "ISC": [
        """permission to use copy modify and or distribute this software for any purpose with or without fee is hereby
        granted provided that the above copyright notice and this permission notice appear in all copies""",
        "spdx license identifier isc",
    ],
    "MIT": [
        "{licensed|released|distributed} under the [terms of the] mit license",
        """permission is hereby granted free of charge to any person obtaining a copy of this software and associated
        documentation files the software to deal in the software without restriction including without limitation the
        rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit
        persons to whom the software is furnished to do so subject to the following conditions the above copyright
        notice and this permission notice [including the next paragraph] shall be included in all copies or substantial
        portions of the software [the software is provided as is without warranty of any kind <80>]""",
        "spdx license identifier mit",
    ],
    "MPL-2.0": [
        "subject to the terms of the mozilla public license v 2 0",
        "spdx license identifier mpl 2 0",
    ],
}

#: score of a document with an accepted template, or with phrases alone
FULL, PHRASE_ONLY = 1.0, 0.5


# --- templates to automata ------------------------------------------------------


@dataclass
class Automaton:
    """States 0..n-1; ``words[s]`` word -> next states, ``any_word[s]`` next
    states on every word, ``free[s]`` next states without a word."""

    words: list[dict[bytes, list[int]]] = field(default_factory=list)
    any_word: list[list[int]] = field(default_factory=list)
    free: list[list[int]] = field(default_factory=list)
    accept: int = 0

    def state(self) -> int:
        self.words.append({})
        self.any_word.append([])
        self.free.append([])
        return len(self.words) - 1

    def closure(self, states: set[int]) -> set[int]:
        todo = list(states)
        while todo:
            for s in self.free[todo.pop()]:
                if s not in states:
                    states.add(s)
                    todo.append(s)
        return states

    def longest(self, words: list[bytes], at: int) -> int:
        """End of the longest accepted run of words from ``at``; -1 if none."""
        now, best = self.closure({0}), -1
        for i in range(at, len(words)):
            step = {t for s in now for t in (*self.words[s].get(words[i], ()), *self.any_word[s])}
            if not step:
                break
            now = self.closure(step)
            if self.accept in now:
                best = i + 1
        return best

    def first_words(self) -> set[bytes]:
        return {w for s in self.closure({0}) for w in self.words[s]}


_TOKEN = re.compile(r"\[|\]|\{|\}|\||<\d+>|[^\s\[\]{}|<>]+")


def compile_template(template: str) -> Automaton:
    """A template must begin with mandatory wording or an alternative."""
    tokens = _TOKEN.findall(template.lower())
    a = Automaton()
    here = a.state()
    open_: list[tuple[str, int, int]] = []  # (kind, entry, exit)
    for t in tokens:
        if t in "[{":
            open_.append((t, here, a.state()))
            if t == "[":
                a.free[here].append(open_[-1][2])
            first = a.state()
            a.free[here].append(first)
            here = first
        elif t == "|":
            _, entry, leave = open_[-1]
            a.free[here].append(leave)
            here = a.state()
            a.free[entry].append(here)
        elif t in "]}":
            _, _, leave = open_.pop()
            a.free[here].append(leave)
            here = leave
        elif t[0] == "<":
            leave = a.state()
            a.free[here].append(leave)
            for _ in range(int(t[1:-1])):
                nxt = a.state()
                a.any_word[here].append(nxt)
                a.free[nxt].append(leave)
                here = nxt
            here = leave
        else:
            nxt = a.state()
            a.words[here].setdefault(t.encode(), []).append(nxt)
            here = nxt
    if open_:
        raise ValueError(f"region not closed: {template[:40]}")
    a.accept = here
    return a


@dataclass
class Matcher:
    """Automata by the word they may begin with; a document without any of
    the words ``marks`` holds no phrase and no template."""

    by_word: dict[bytes, list[tuple[str, Automaton]]]
    phrases: list[tuple[bytes, int, str]]
    marks: re.Pattern

    def find(self, data: bytes) -> tuple[list[bytes], list[tuple[int, str]], list[tuple[int, int, str]]]:
        """Words; phrase places (first word, label); templates (first word, end, label)."""
        words = data.translate(WORD_BYTES).split()
        text = b" " + b" ".join(words) + b" "
        if not self.marks.search(text):
            return words, [], []
        places = []
        for phrase, _, label in self.phrases:
            at = text.find(phrase)
            seen = index = 0
            while at >= 0:
                index += text.count(b" ", seen, at)
                seen = at
                places.append((index, label))
                at = text.find(phrase, at + 1)
        accepted = []
        for first, automata in self.by_word.items():
            needle = b" " + first + b" "
            at, seen, index = text.find(needle), 0, 0
            while at >= 0:
                index += text.count(b" ", seen, at)
                seen = at
                for label, a in automata:
                    end = a.longest(words, index)
                    if end >= 0:
                        accepted.append((index, end, label))
                at = text.find(needle, at + 1)
        return words, sorted(places), sorted(accepted)


def matcher(templates: dict[str, list[str]] = TEMPLATES, phrases: dict[str, str] = PHRASES) -> Matcher:
    by_word: dict[bytes, list[tuple[str, Automaton]]] = {}
    for label, texts in templates.items():
        for text in texts:
            a = compile_template(text)
            if not a.first_words():
                raise ValueError(f"{label}: a template must begin with wording")
            for w in a.first_words():
                by_word.setdefault(w, []).append((label, a))
    spaced = [(b" " + p.encode() + b" ", len(p.split()), label) for p, label in phrases.items()]
    marks = sorted({*(p for p, _, _ in spaced), *(b" " + w + b" " for w in by_word)})
    return Matcher(by_word, spaced, re.compile(b"|".join(map(re.escape, marks))))


def licenses(
    docs: DataFrame,
    text_col: str = "text",
    keep: list[str] | None = None,
    templates: dict[str, list[str]] = TEMPLATES,
    phrases: dict[str, str] = PHRASES,
) -> DataFrame:
    """Each row of ``docs`` (columns ``keep``, all by default) with n_words;
    n_base (all places of phrases), first_word and last_word (smallest and
    largest of their places, null without any), base_labels; matches: every
    place where a template accepts its longest run of words (first_word,
    end_word exclusive, label); labels (of phrases and templates); and score:
    1 with an accepted template, 0.5 with phrases alone, else 0. Labels are
    distinct, sorted and comma-joined. Null and empty texts have no words."""

    def run(part: pa.RecordBatch) -> dict:
        m = matcher(templates, phrases)
        out = {k: [] for k in ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "matches")}
        for data in texts_of(part, "__text"):
            words, places, accepted = m.find(data)
            base = {label for _, label in places}
            out["n_words"].append(len(words))
            out["n_base"].append(len(places))
            out["first_word"].append(places[0][0] if places else None)
            out["last_word"].append(places[-1][0] if places else None)
            out["base_labels"].append(",".join(sorted(base)))
            out["labels"].append(",".join(sorted(base | {label for *_, label in accepted})))
            out["score"].append(FULL if accepted else PHRASE_ONLY if places else 0.0)
            out["matches"].append([{"first_word": a, "end_word": b, "label": x} for a, b, x in accepted])
        return out

    added = (
        "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
        "score double, matches array<struct<first_word:bigint,end_word:bigint,label:string>>"
    )
    return map_slices(docs, text_col, run, added, keep)
