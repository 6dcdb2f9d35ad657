"""Licence lines as they stand in texts and files."""

from reviewlab.llm import licenses

LINES = {
    "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0",
    "This project is released under the MIT License": "MIT",
    "This software is distributed under the Apache License, Version 2.0.": "Apache-2.0",
    "This file is licensed under the Mozilla Public License, version 2.0.": "MPL-2.0",
    "This program is licensed under the GNU Affero General Public License, version 3.": "AGPL-3.0",
    "Released under the GNU Lesser General Public License, version 3.": "LGPL-3.0",
    "Distributed under the GNU General Public License, version 2.": "GPL-2.0",
    "Released under the BSD 3-Clause License.": "BSD",
    "This work is released under CC BY-SA 4.0.": "CC-BY-SA-4.0",
    "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.": "CC-BY-NC-4.0",
    "Released under the MIT License.": "MIT",
    "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0",
    "MIT License": "MIT",
    "// SPDX-License-Identifier: MIT": "MIT",
    "# SPDX-License-Identifier: Apache-2.0": "Apache-2.0",
    "/* SPDX-License-Identifier: GPL-2.0-only */": "GPL-2.0",
    "SPDX-License-Identifier: BSD-3-Clause": "BSD",
}


def found(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    return [r.licences for r in sorted(licenses.scan(df).collect())]


def test_lines_between_other_lines(spark):
    around = ["{}", "A line before.\n{}\nA line after.", "No end here!!\n\n{}\n\nAnd after", "from from\n{}\nThe other"]
    texts = [form.format(line) for form in around for line in LINES]
    assert found(spark, texts) == [[x] for _ in around for x in LINES.values()]


def test_code_goes_on_below_an_identifier(spark):
    assert found(spark, ["// SPDX-License-Identifier: MIT\nimport os\n", "# SPDX-License-Identifier: MIT\n# Copyright"]) == [["MIT"]] * 2


def test_other_words_are_no_licence(spark):
    texts = ["This work is not licensed under the MIT License.", "Ask for a license: MIT has one.", "Licensed under nothing."]
    assert found(spark, texts) == [[]] * 3
