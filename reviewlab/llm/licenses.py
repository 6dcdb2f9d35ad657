"""Licence scan: known sentences, then ordered rules over their numbers.

A text is cut into sentences; each is normalised and looked up in a table of sentences known
from licences and their notices. What is left of the text is a short sequence of sentence
numbers, in which a rule finds its own sequence. All of it is one projection.

Edge cases: a null or empty text has no sentences and no licence; repeated rows are each
scanned; other columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import re
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from reviewlab.llm.common import let

# Known sentences by name, in normal form (lower case, letters, digits and
# single spaces). Each is a piece as ``ENDED`` cuts them: none holds the end of another.
SENTENCES = {
    "apache-ref": "licensed under the apache license version 2 0",
    "apache-header": "licensed under the apache license version 2 0 the license",
    "apache-comply": "you may not use this file except in compliance with the license",
    "apache-copy": "you may obtain a copy of the license at http www apache org licenses license 2 0",
    "apache-unless": (
        "unless required by applicable law or agreed to in writing software distributed under "
        "the license is distributed on an as is basis without warranties or conditions of any "
        "kind either express or implied"
    ),
    "apache-see": (
        "see the license for the specific language governing permissions and limitations "
        "under the license"
    ),
    "mit-ref": "mit license",
    "mit-title": "the mit license",
    "mit-released": "released under the mit license",
    "mit-licensed": "licensed under the mit license",
    "mit-grant": (
        "permission is hereby granted free of charge to any person obtaining a copy of this "
        "software and associated documentation files the software to deal in the software "
        "without restriction including without limitation the rights to use copy modify merge "
        "publish distribute sublicense and or sell copies of the software and to permit "
        "persons to whom the software is furnished to do so subject to the following conditions"
    ),
    "mit-notice": (
        "the above copyright notice and this permission notice shall be included in all "
        "copies or substantial portions of the software"
    ),
    "mit-as-is": (
        "the software is provided as is without warranty of any kind express or implied "
        "including but not limited to the warranties of merchantability fitness for a "
        "particular purpose and noninfringement"
    ),
    "gpl3-ref": "gnu general public license version 3",
    "gpl3-licensed": "licensed under the gnu general public license version 3",
    "gpl3-released": "released under the gnu general public license version 3",
    "gpl2-ref": "gnu general public license version 2",
    "gpl-free": (
        "you can redistribute it and or modify it under the terms of the gnu general public "
        "license as published by the free software foundation either version 3 of the license "
        "or at your option any later version"
    ),
    "gpl-hope": (
        "this program is distributed in the hope that it will be useful but without any warranty"
    ),
    "gpl-even": (
        "without even the implied warranty of merchantability or fitness for a particular purpose"
    ),
    "gpl-see": "see the gnu general public license for more details",
    "lgpl3-ref": "gnu lesser general public license version 3",
    "agpl3-ref": "gnu affero general public license version 3",
    "mpl2-ref": (
        "this source code form is subject to the terms of the mozilla public license v"
    ),
    "bsd-redistribute": (
        "redistribution and use in source and binary forms with or without modification are "
        "permitted provided that the following conditions are met"
    ),
    "bsd-source": (
        "redistributions of source code must retain the above copyright notice this list of "
        "conditions and the following disclaimer"
    ),
    "bsd-binary": (
        "redistributions in binary form must reproduce the above copyright notice this list of "
        "conditions and the following disclaimer in the documentation and or other materials "
        "provided with the distribution"
    ),
    "cc-by-ref": "licensed under cc by 4 0",
    "cc-by-sa-ref": "licensed under cc by sa 4 0",
    "cc-by-nc-ref": "licensed under cc by nc 4 0",
    "cc-by-nc-sa-ref": "licensed under cc by nc sa 4 0",
    "cc-by-nd-ref": "licensed under cc by nd 4 0",
}

# What follows "licensed under the" in notices of each licence, and its SPDX names.
NOTICES = {
    "Apache-2.0": (["the apache license version 2 0", "the apache license 2 0"], ["Apache-2.0"]),
    "MIT": (["the mit license"], ["MIT"]),
    "GPL-3.0": (
        ["the gnu general public license version 3", "the gnu general public license v3 0",
         "the gnu gpl v3"],
        ["GPL-3.0", "GPL-3.0-only", "GPL-3.0-or-later", "GPL-3.0+"],
    ),
    "GPL-2.0": (
        ["the gnu general public license version 2", "the gnu general public license v2 0",
         "the gnu gpl v2"],
        ["GPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-2.0+"],
    ),
    "LGPL-3.0": (
        ["the gnu lesser general public license version 3"],
        ["LGPL-3.0", "LGPL-3.0-only", "LGPL-3.0-or-later", "LGPL-3.0+"],
    ),
    "AGPL-3.0": (
        ["the gnu affero general public license version 3"],
        ["AGPL-3.0", "AGPL-3.0-only", "AGPL-3.0-or-later", "AGPL-3.0+"],
    ),
    "MPL-2.0": (
        ["the mozilla public license version 2 0", "the mozilla public license 2 0"], ["MPL-2.0"]
    ),
    "BSD": (
        ["the bsd license", "the bsd 2 clause license", "the bsd 3 clause license"],
        ["BSD-2-Clause", "BSD-3-Clause"],
    ),
    **{
        f"CC-{short.upper().replace(' ', '-')}-4.0": (
            [f"cc {short} 4 0", f"a creative commons {full} 4 0 international license"],
            [f"CC-{short.upper().replace(' ', '-')}-4.0"],
        )
        for short, full in {
            "by": "attribution",
            "by sa": "attribution sharealike",
            "by nc": "attribution noncommercial",
            "by nc sa": "attribution noncommercial sharealike",
            "by nd": "attribution noderivatives",
        }.items()
    },
}
SUBJECTS = ["", *(f"this {what} is " for what in "work project software file program".split())]
VERBS = ["licensed", "released", "distributed"]


def _normal(text: str) -> str:
    return re.sub("[^a-z0-9]+", " ", text.lower()).strip()


def _notices() -> dict[str, list[str]]:
    """Names of the notice sentences of each licence, which are added to the known ones."""
    known = {sentence: name for name, sentence in SENTENCES.items()}
    listed = {}
    for licence, (full, spdx) in NOTICES.items():
        said = [
            f"{subject}{verb} under {name}"
            for name in full for subject in SUBJECTS for verb in VERBS
        ]
        # The colon after the identifier is dropped by WRAPPED.
        said += [f"spdx license {_normal(name)}" for name in spdx]
        said = [x for x in dict.fromkeys(said) if x not in known]
        listed[licence] = [f"{licence.lower()}-{i}" for i in range(1, len(said) + 1)]
        SENTENCES.update(zip(listed[licence], said))
        known.update(zip(said, listed[licence]))
    return listed


_NOTICE_NAMES = _notices()


class Rule(NamedTuple):
    """A licence and the sentences that must follow one another among the known ones."""

    licence: str
    sequence: tuple[str, ...]


# The rules, whole texts before notices and references.
RULES = [
    Rule("Apache-2.0", ("apache-header", "apache-comply", "apache-unless", "apache-see")),
    Rule("Apache-2.0", ("apache-header", "apache-comply", "apache-copy", "apache-unless")),
    Rule("Apache-2.0", ("apache-ref",)),
    Rule("MIT", ("mit-grant", "mit-notice", "mit-as-is")),
    Rule("MIT", ("mit-title",)),
    Rule("MIT", ("mit-released",)),
    Rule("MIT", ("mit-licensed",)),
    Rule("MIT", ("mit-ref",)),
    Rule("GPL-3.0", ("gpl-free", "gpl-hope", "gpl-even", "gpl-see")),
    Rule("GPL-3.0", ("gpl3-licensed",)),
    Rule("GPL-3.0", ("gpl3-released",)),
    Rule("GPL-3.0", ("gpl3-ref",)),
    Rule("GPL-2.0", ("gpl2-ref",)),
    Rule("LGPL-3.0", ("lgpl3-ref",)),
    Rule("AGPL-3.0", ("agpl3-ref",)),
    Rule("MPL-2.0", ("mpl2-ref",)),
    Rule("BSD", ("bsd-redistribute", "bsd-source", "bsd-binary")),
    Rule("CC-BY-4.0", ("cc-by-ref",)),
    Rule("CC-BY-SA-4.0", ("cc-by-sa-ref",)),
    Rule("CC-BY-NC-4.0", ("cc-by-nc-ref",)),
    Rule("CC-BY-NC-SA-4.0", ("cc-by-nc-sa-ref",)),
    Rule("CC-BY-ND-4.0", ("cc-by-nd-ref",)),
]

RULES += [Rule(licence, (name,)) for licence, names in _NOTICE_NAMES.items() for name in names]

#: Every known sentence holds one of these stems; other sentences are not looked up.
STEMS = r"(?i)licens|compliance|permission|copyright|warrant|redistribut|under\s+cc\s+by|gnu\s+gpl"


def _tails() -> str:
    """A pattern of what begins the next line when a known sentence is wrapped: its following
    words, as many, two at least, as no known sentence begins with."""
    begun = set()
    for sentence in SENTENCES.values():
        words = sentence.split()
        begun.update(tuple(words[:n]) for n in range(1, len(words) + 1))
    tails = set()
    for sentence in SENTENCES.values():
        words = sentence.split()
        for at in range(1, len(words)):
            tail = words[at:]
            n = next((n for n in range(2, len(tail) + 1) if tuple(tail[:n]) not in begun), 0)
            if n:
                tails.add((tuple(tail[:n]), n == len(tail)))
            elif len(tail) == 1 and tuple(tail) not in begun:
                tails.add((tuple(tail), True))

    def pattern(tails: set) -> str:
        """Alternatives by their first word."""
        firsts: dict[str, set] = {}
        for words, last in sorted(tails):
            firsts.setdefault(words[0], set()).add((words[1:], last))
        parts = []
        for word, rest in firsts.items():
            ends = [last for words, last in rest if not words]
            more = {(words, last) for words, last in rest if words}
            choices = [rf"[^a-z0-9\n]+{pattern(more)}"] if more else []
            if ends:
                # A whole tail ends there; a part of one goes on.
                choices.append(r"\b" if not all(ends) else r"[ \t\r]*(?:[^a-z0-9 \t\r]|$)")
            parts.append(word + (choices[0] if len(choices) == 1 else f"(?:{'|'.join(choices)})"))
        return f"(?:{'|'.join(parts)})"

    return pattern(tails)


_SPDX = "|".join(
    re.escape(name).replace(r"\-", "-") for _, names in NOTICES.values() for name in names
)
#: A line that ends in a comma, or is followed by a small letter or by what goes on in a known
#: sentence, goes on in the next line. A SPDX line ends with its line, and loses its colon.
WRAPPED = (
    r",[ \t\r]*\n[ \t#*/;]*|(?:[ \t\r]*\n[ \t#*/;]*[\"(]*|-Identifier:[ \t]+)"
    rf"((?:{_SPDX})[ \t\r*/>-]*(?:\n|$)|[a-z(]|(?i:{_tails()}))"
)
ENDED = r"([.!?;:])[ \t\r]+"


def sentence_numbers(text: Column) -> Column:
    """Numbers, from 1, of the known sentences of a text, in their order."""
    known = F.array(*map(F.lit, SENTENCES.values()))
    joined = F.regexp_replace(text, WRAPPED, " $1")
    pieces = F.split(F.regexp_replace(joined, ENDED, "$1\n"), "\n")
    asked = F.filter(pieces, lambda s: s.rlike(STEMS))
    normal = F.transform(asked, lambda s: F.trim(F.regexp_replace(F.lower(s), "[^a-z0-9]+", " ")))
    numbers = F.transform(normal, lambda s: F.array_position(known, s))
    return F.filter(numbers, lambda n: n > 0)


def rule_sequence(rule: Rule) -> str:
    numbers = {name: i for i, name in enumerate(SENTENCES, 1)}
    return "," + ",".join(str(numbers[s]) for s in rule.sequence) + ","


def scan(
    df: DataFrame, rules: list[Rule] = RULES, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(id, sentences, licences)``: names of the known sentences in order, and the licences
    whose rules match, sorted."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    names = F.array(*map(F.lit, SENTENCES))
    none = F.array().cast("array<bigint>")

    def judge(numbers: Column) -> Column:
        # A comma on both sides of each number: sequences may share their border.
        line = F.concat(F.lit(","), F.array_join(numbers.cast("array<string>"), ","), F.lit(","))

        def match(line: Column) -> Column:
            hits = [
                F.when(F.instr(line, rule_sequence(r)) > 0, F.lit(r.licence)) for r in rules
            ]
            return F.array_sort(F.array_distinct(F.array_compact(F.array(*hits))))

        return F.struct(
            F.transform(numbers, lambda n: F.element_at(names, n.cast("int"))).alias("sentences"),
            let(line, match).alias("licences"),
        )

    found = F.when(text.rlike(STEMS), sentence_numbers(text)).otherwise(none)
    return df.select(F.col(id_col), let(found, judge).alias("found")).select(id_col, "found.*")
