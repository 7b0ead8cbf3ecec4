"""Licence sentences: what names a licence and what does not, order, odd rows, and the planted lines of the driver's table."""

from pathlib import Path

import pytest

from driftwright.llm import license_scan

FOLDER = "/root/testdata/sf0.01"
CASES = [
    ("GPL players are a football league.", []),
    ("This is not licensed under the MIT License.", []),
    ("MIT License. Apache License, Version 2.0.", ["MIT", "Apache-2.0"]),
    ("Apache License 2.0 or MIT License", ["Apache-2.0", "MIT"]),
    ("You may not use this file except in compliance with the Apache License, Version 2.0.", ["Apache-2.0"]),
    ("It is no longer released into the public domain.", []),
    ("Unlike code under the GPL, this is free.", []),
    ("The history of the BSD license is long and many people told it.", []),
    ("We never asked under the terms of the Foo agreement.", []),
    ("Distributed under the GNU Lesser General Public License v2.1.", ["LGPL-2.1"]),
    ("SPDX-License-Identifier: Apache-2.0", ["Apache-2.0"]),
    ("CC BY 4.0", ["CC-BY-4.0"]),
    ("GNU General Public License version 2, or (at your option) any later version. The MIT License.", ["GPL-2-or-later", "MIT"]),
    ("The MIT License. Nothing. Released under the MIT License.", ["MIT"]),
    ("Proprietary and confidential. Licensed under the Mozilla Public License 2.0.", ["Proprietary", "MPL-2.0"]),
    ("", []),
    (None, []),
]


def test_what_names_a_licence(spark):
    rows = [(k, t, "a", "b") for k, (t, _) in enumerate(CASES)]
    df = spark.createDataFrame(rows + rows[:3], "ids int, text string, sentence_ids string, licenses string")
    found = license_scan.scan(df, ["ids", "licenses"]).toDF("ids", "own", "sentence_ids", "found").collect()
    assert {r.ids: r.found for r in found} == {k: expected for k, (_, expected) in enumerate(CASES)}
    assert len(found) == len(rows) + 3 and {r.own for r in found} == {"b"}
    assert license_scan.scan(df.limit(0), ["ids"]).count() == 0


def test_long_texts_in_order(spark):
    filler = "word " * 40_000
    text = f"{filler}. Licensed under the Apache License, Version 2.0. {filler}. Released under the MIT License. {filler}"
    row = license_scan.scan(spark.createDataFrame([(1, text)], "doc_id int, text string"), ["doc_id"]).first()
    assert row.licenses == ["Apache-2.0", "MIT"]


@pytest.mark.skipif(not Path(FOLDER).exists(), reason="no driver tables here")
def test_planted_lines_are_found_and_nothing_else(spark):
    planted = {"This work is licensed under the GNU General Public License, version 3.": "GPL-3", "Released under the MIT License.": "MIT", "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0", "Licensed under the Apache License, Version 2.0.": "Apache-2.0"}
    df = spark.read.parquet(f"{FOLDER}/documents.parquet")
    texts = {r.doc_id: r.text or "" for r in df.collect()}
    for r in license_scan.scan(df, ["doc_id"]).collect():
        expected = sorted((texts[r.doc_id].index(line), licence) for line, licence in planted.items() if line in texts[r.doc_id])
        assert r.licenses == [licence for _, licence in expected]
