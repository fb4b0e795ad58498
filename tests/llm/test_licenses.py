from __future__ import annotations

import re

from pressroom.llm import licenses


def test_every_template_is_found_in_text():
    compressor = licenses.Compressor()
    for name, template in licenses.TEMPLATES.items():
        noisy = "Some words before it, on many things. " * 20 + template.replace(" ", "\n", 3) + " And words that follow it. " * 20
        found = licenses.licenses_of(noisy, compressor)
        assert [x["license"] for x in found] == [name], (name, found)
        assert found[0]["differences"] == 0
        assert noisy[found[0]["start"] : found[0]["end"]].split() == template.rstrip(":.").split()


def test_changed_wording_is_counted_and_other_wording_is_not_found():
    compressor = licenses.Compressor()
    changed = "This work is licenced under the GNU General Public License, version 3."
    assert [(x["license"], x["differences"]) for x in licenses.licenses_of(changed, compressor)] == [("GPL-3.0", 1)]
    for clean in ("He had a license to fish.", "The copyright office moved to a new street.", "no permission was given to anybody", ""):
        assert licenses.licenses_of(clean, compressor) == []


def test_repeated_notices_equal_brute_force():
    compressor = licenses.Compressor()
    for name in ("MIT", "GPL-3.0", "reserved", "CC-BY-4.0", "GPL-header"):
        notice = licenses.TEMPLATES[name]
        for between in ("\n", " And some other words. "):
            for n in (2, 4, 6, 9):
                text = "Words before. " + between.join([notice] * n) + " Words after."
                wanted = [m.span() for m in re.finditer(re.escape(notice.rstrip(".")), text)]
                found = licenses.licenses_of(text, compressor)
                assert [(x["start"], x["end"]) for x in found] == wanted and {x["license"] for x in found} == {name}, (name, n)


def test_another_version_or_name_is_another_license():
    compressor = licenses.Compressor()
    for notice, name in {
        "This work is licensed under the GNU General Public License, version 2.": "GPL-2.0",
        "This program is licensed under the GNU General Public License, version 3.0.": "GPL-3.0",
        "This work is licensed under the GNU Lesser General Public License, version 2.1.": "LGPL-2.1",
        "This work is licensed under the GNU Affero General Public License, version 3.": "AGPL-3.0",
        "This work is licensed under the GNU General Public License, version 7.": None,
        "This work is licensed under the GNU General Public License, version 3.1.": None,
        "Licensed under the Apache License, Version 1.1.": "Apache-1.1",
        "Licensed under the Apache License, Version 9.0.": None,
        "Distributed under the MIT License.": "MIT",
        "Released under the BSD License.": "BSD-notice",
        "Released under the Foo License.": None,
        "Licensed under CC BY-SA 4.0.": "CC-BY-SA-4.0-notice",
        "Licensed under CC BY-NC 3.0.": "CC-BY-NC-3.0-notice",
        "This work is licensed under a Creative Commons Attribution 3.0 Unported License.": "CC-BY-3.0",
        "This is free and unencumbered software released into the public domain.": "Unlicense",
    }.items():
        found = licenses.licenses_of(f"Words before. {notice} Words after.", compressor)
        assert [x["license"] for x in found] == ([name] if name else []), (notice, found)


def test_differences_equal_brute_force():
    assert licenses.differences(["a", "b", "c"], ["x", "a", "b", "c", "y"]) == (0, 1, 4)
    assert licenses.differences(["a", "b", "c"], ["x", "a", "q", "c", "y"])[0] == 1
    assert licenses.differences(["a", "b"], []) == (2, 0, 0)


def test_long_texts_are_cut_with_overlap():
    text = ("license " + "word " * 30) * 400
    parts = licenses.blocks(text, 100)
    cues = [m.span() for m in licenses.CUE.finditer(text)]
    assert len(cues) == 400 and all(any(a <= i and j <= b for a, b in parts) for i, j in cues)
    parts = licenses.blocks("license " * 3000, 320, 900)
    assert parts[0][0] == 0 and parts[-1][1] == 24_000 and max(b - a for a, b in parts) <= 960


def test_odd_rows(session, odd, nothing):
    assert licenses.license_scan(odd).filter("size(licenses) > 0").count() == 0
    assert licenses.license_scan(odd).count() == odd.count()
    assert licenses.license_scan(nothing).count() == 0
