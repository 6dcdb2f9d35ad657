"""The standard notices of licences as they stand in files, each wrapped in several ways."""

import textwrap

import pytest

from reviewlab.llm import licenses

#: The standard notices, each paragraph in one line.
NOTICES = {
    "Apache-2.0": [
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file '
        "except in compliance with the License. You may obtain a copy of the License at",
        "    http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the "
        'License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, '
        "either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License.",
    ],
    "MIT": [
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        'software and associated documentation files (the "Software"), to deal in the Software '
        "without restriction, including without limitation the rights to use, copy, modify, merge, "
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
        "persons to whom the Software is furnished to do so, subject to the following conditions:",
        "The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software.",
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, '
        "INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR "
        "PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE "
        "FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY.",
    ],
    "GPL-3.0": [
        "This program is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU General Public License as published by the Free Software Foundation, either "
        "version 3 of the License, or (at your option) any later version.",
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; "
        "without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. "
        "See the GNU General Public License for more details.",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a "
        "copy of the MPL was not distributed with this file, You can obtain one at "
        "https://mozilla.org/MPL/2.0/.",
    ],
    "BSD": [
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met:",
        "1. Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer.",
        "2. Redistributions in binary form must reproduce the above copyright notice, this list of "
        "conditions and the following disclaimer in the documentation and/or other materials "
        "provided with the distribution.",
    ],
}

def found(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    return [r.licences for r in sorted(licenses.scan(df).collect())]


def wrapped(paragraphs, width, sign=""):
    parts = [textwrap.fill(p, width, initial_indent="    " * p.startswith(" ")) for p in paragraphs]
    return "\n".join(f"{sign}{line}".rstrip() for line in "\n\n".join(parts).split("\n"))


@pytest.mark.parametrize("licence", NOTICES)
def test_standard_notices(spark, licence):
    texts = [
        wrapped(NOTICES[licence], width, sign)
        for width in [*range(40, 90), 2000]
        for sign in ("", "# ", " * ", "// ")
    ]
    texts += ["Some words.\n\n" + t + "\n\nMore words." for t in texts[::5]]
    assert [x for x in found(spark, texts)] == [[licence]] * len(texts)


def test_standard_wrapping(spark):
    mit = wrapped(NOTICES["MIT"], 78)
    assert "OR\nIMPLIED" in mit
    assert "Public\nLicense" in (mpl := wrapped(NOTICES["MPL-2.0"], 70))
    assert found(spark, ["MIT License\n\nCopyright (c) 2020 A\n\n" + mit, mpl]) == [["MIT"], ["MPL-2.0"]]


def test_every_known_sentence_is_one_piece(spark):
    texts = list(licenses.SENTENCES.values())
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    assert [r.sentences for r in sorted(licenses.scan(df).collect())] == [[n] for n in licenses.SENTENCES]
