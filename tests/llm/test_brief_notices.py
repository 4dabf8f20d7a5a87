"""Licence notices of three and four words."""

from billframe.llm import licence_scan


def names(scanner, *texts):
    return [sorted({m["license"] for m in found}) for found in scanner.scan([t.encode() for t in texts])]


def test_brief_notices_are_found_whole(spark, empty):
    scanner = licence_scan.Scanner(sorted((k, t.encode()) for k, t in licence_scan.TEMPLATES), licence_scan.CONTAINMENT)
    got = names(
        scanner, "// SPDX-License-Identifier: MIT", "Licensed under GPLv3.", "License: BSD 3-Clause", "x\nDual licensed under the MIT and GPL licenses\ny",
        "SPDX-License-Identifier: Zlib", "# spdx-license-identifier: unlicense", "", "MIT", "a license bsd", "the SPDX license", "identifier: MIT",
    )
    assert got == [["MIT"], ["GPL-3.0"], ["BSD-3-Clause"], ["GPL", "MIT"], ["Zlib"], ["Unlicense"], [], [], [], [], []]
    # a notice does not reach over the border of two texts
    assert names(scanner, "see SPDX license", "identifier MIT", "one more") == [[], [], []]
    found = scanner.scan([b"one two SPDX-License-Identifier: ISC three"])[0]
    assert [(m["license"], m["containment"], m["first_word"], m["last_word"]) for m in found] == [("ISC", 1.0, 2, 5)]
    frame = spark.createDataFrame([(1, "SPDX-License-Identifier: MIT"), (2, None), (3, "two words")], "doc_id long, text string")
    rows = {r.doc_id: r.matches for r in licence_scan.license_matches(frame, licence_scan.template_table(spark)).collect()}
    assert [m["license"] for m in rows[1]] == ["MIT"] and rows[2] == rows[3] == []
