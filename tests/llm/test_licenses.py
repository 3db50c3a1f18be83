"""License notices in long texts, altered notices, overlaps of versions, and text without any."""

import random

from custodia.llm import licenses
from custodia.llm.queries import QUERIES
from tests.llm.helpers import DOCUMENTS, ROWS, clashing, documents


def prose(rng, n):
    return " ".join(f"w{rng.randrange(4000)}{'.' if rng.random() < 0.1 else ''}" for _ in range(n))


def test_notices_are_found_anywhere(spark):
    rng = random.Random(5)
    rows, want = [], {}
    for k in range(120):
        name, text = rng.choice(licenses.TEMPLATES)
        before, after = prose(rng, rng.choice([0, 1, 7, 300])), prose(rng, rng.choice([0, 3, 5000]))
        rows.append((k, f"{before}\n{text.upper() if k % 3 == 0 else text} {after}", "en", "a", 0))
        want[k] = (name, len(licenses.normal_words(before)))
    rows.append((500, prose(rng, 40_000), "en", "a", 0))
    got = {r.doc_id: r for r in licenses.scan_licenses(spark.createDataFrame(rows, DOCUMENTS)).collect()}
    for k, (name, first) in want.items():
        assert name in got[k].licenses.split(","), rows[k][1][:200]
        assert any(s.startswith(f"{name}:{first}:") for s in got[k].spans.split(","))
    assert (got[500].licenses, got[500].n_matches, got[500].containment) == ("", 0, 0.0)


def test_altered_notices(spark):
    long = next(t for n, t in licenses.TEMPLATES if n == "ISC")
    words = long.split()
    close = " ".join([*words[:12], "really", *words[12:]])
    far = " ".join(w if i % 6 else "changed" for i, w in enumerate(words))
    rows = [(1, close, "en", "a", 0), (2, far, "en", "a", 0)]
    got = {r.doc_id: r.licenses for r in licenses.scan_licenses(documents(spark, rows)).collect()}
    assert got == {1: "ISC", 2: ""}


def test_the_better_version_wins(spark):
    rows = [(1, "This work is licensed under the GNU General Public License, version 3.", "en", "a", 0)]
    (r,) = licenses.scan_licenses(documents(spark, rows)).collect()
    assert (r.licenses, r.n_matches, r.containment) == ("GPL-3.0", 1, 1.0)


def test_adjacent_notices_are_both_found():
    library = licenses.Library.of(licenses.TEMPLATES, 0.75, 0.999)
    sizes = [len(licenses.normal_words(t)) for _, t in licenses.TEMPLATES]
    hashes = licenses.WordHashes()
    for i, (_, one) in enumerate(licenses.TEMPLATES):
        for j, (_, two) in enumerate(licenses.TEMPLATES):
            for before in ("", "some words come first "):
                at = len(before.split())
                found = [m[:3] for m in library.matches(f"{before}{one} {two} and more", hashes)]
                assert found == [(i, at, at + sizes[i]), (j, at + sizes[i], at + sizes[i] + sizes[j])], (one, two)


def test_altered_notice_beside_another():
    library = licenses.Library.of(licenses.TEMPLATES, 0.75, 0.999)
    gpl = "This work is licensed under the GNU General Public License, version 3."
    lgpl = "Our work is licensed under the GNU Lesser General Public License, version 3."
    found = library.matches(f"{gpl} {lgpl}", licenses.WordHashes())
    assert [(library.names[t], first, end) for t, first, end, _ in found] == [("GPL-3.0", 0, 12), ("LGPL-3.0", 13, 25)]


def test_bands_reach_the_probability():
    for containment in (0.6, 0.75, 1.0):
        bands = licenses.bands_for(list(range(1, 200)), containment, 0.999)
        assert all(1 - (1 - licenses.least_similarity(n, containment)) ** bands >= 0.999 for n in range(1, 200))


def test_awkward_rows(spark):
    assert licenses.scan_licenses(clashing(documents(spark), "licenses", "spans")).count() == len(ROWS)
    assert licenses.scan_licenses(documents(spark, [])).count() == 0


def test_table(spark, base):
    known = {"MIT": "Released under the MIT License.", "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
             "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.", "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0."}
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{base}/documents.parquet").collect()}
    got = {r.doc_id: r.licenses for r in QUERIES["op6_license_windows"](spark, base).collect()}
    assert got == {d: ",".join(sorted(n for n, line in known.items() if line in t)) for d, t in texts.items()}


FSF = "{0} is free software{1} you can redistribute it and/or modify it under the terms of the {2} as published by the Free Software Foundation{3} either version {4} of the License, or (at your option) any later version. It is distributed in the hope"
CLAUSES = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
 * Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
 * Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the
   documentation and/or other materials provided with the distribution.
"""
THIRD = " * Neither the name of the University nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.\n"
AS_IS = "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS ``AS IS'' AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED."
VERSIONS = [
    ("GPL-2.0", FSF.format("This program", ";", "GNU General Public License", ";", "2")),
    ("GPL-3.0", FSF.format("Foobar", ":", "GNU General Public License", ",", "3")),
    ("AGPL-3.0", FSF.format("This program", ":", "GNU Affero General Public License", ",", "3")),
    ("LGPL-3.0", FSF.format("This program", ":", "GNU Lesser General Public License", ",", "3")),
    ("LGPL-2.1", FSF.format("This library", ";", "GNU Lesser General Public License", ";", "2.1")),
    ("LGPL-2.0", FSF.format("This library", ";", "GNU Library General Public License", ";", "2")),
    ("BSD-2-Clause", CLAUSES + AS_IS),
    ("BSD-3-Clause", CLAUSES + THIRD + AS_IS),
    ("Unlicense", "This is free and unencumbered software released into the public domain.\n\nAnyone is free to copy, modify, publish, use, compile, sell, or\ndistribute this software, either in source code form or as a compiled\nbinary, for any purpose, commercial or non-commercial, and by any\nmeans."),
]


def test_versions_are_told_apart(spark):
    rng = random.Random(8)
    rows = [(i, f"{prose(rng, 50)} {text} {prose(rng, 50)}", "en", "a", 0) for i, (_, text) in enumerate(VERSIONS)]
    got = {r.doc_id: r.licenses for r in licenses.scan_licenses(documents(spark, rows)).collect()}
    assert got == {i: name for i, (name, _) in enumerate(VERSIONS)}


def test_whole_texts_on_this_machine():
    """Bodies as distributions install them, where they are installed."""
    from pathlib import Path

    library = licenses.Library.of(licenses.TEMPLATES, 0.75, 0.999)
    files = {"GPL-2": "GPL-2.0", "GPL-3": "GPL-3.0", "LGPL-2": "LGPL-2.0", "LGPL-2.1": "LGPL-2.1", "LGPL-3": "LGPL-3.0",
             "Apache-2.0": "Apache-2.0", "MPL-2.0": "MPL-2.0", "CC0-1.0": "CC0-1.0", "BSD": "BSD-3-Clause"}
    for file, name in files.items():
        path = Path("/usr/share/common-licenses") / file
        if path.exists():
            found = library.matches(path.read_text(), licenses.WordHashes())
            assert {library.names[t] for t, *_ in found} == {name}, file


def brute_matches(library, text):
    """Every stretch of every length, by its distinct shingles: which templates hold enough somewhere?"""
    hashes = licenses.WordHashes()
    shingles = licenses.windows(hashes.of(licenses.normal_words(text)), 5).tolist()
    names = set()
    for name, wanted in zip(library.names, library.shingles):
        wanted, reach = set(wanted.tolist()), 2 * licenses.stride_of(len(wanted))
        for start in range(0, max(len(shingles) - reach, 0) + 1):
            if len(wanted & set(shingles[start : start + reach])) >= 0.75 * len(wanted):
                names.add(name)
                break
    return names


def test_recall_against_every_window(spark):
    """Notices with words changed, dropped and put in: of the templates that some window holds, the bands find at least 0.9;
    what is found is always among them."""
    rng = random.Random(14)
    library = licenses.Library.of(licenses.TEMPLATES, 0.75, 0.999)
    rows = []
    for i in range(300):
        words = rng.choice(licenses.TEMPLATES)[1].split()
        for _ in range(rng.randrange(0, 1 + len(words) // 12)):
            k = rng.randrange(len(words))
            words[k : k + 1] = rng.choice([[], ["changed"], [words[k], "more"]])
        rows.append((i, f"{prose(rng, rng.randrange(60))} {' '.join(words)} {prose(rng, rng.randrange(60))}", "en", "a", 0))
    got = {r.doc_id: set(filter(None, r.licenses.split(","))) for r in licenses.scan_licenses(documents(spark, rows)).collect()}
    wanted = {r[0]: brute_matches(library, r[1]) for r in rows}
    assert all(got[i] <= wanted[i] for i in got)
    found = [bool(got[i]) for i in got if wanted[i]]
    print(f"recall {sum(found) / len(found):.3f} of {len(found)} texts")
    assert len(found) > 150 and sum(found) >= 0.9 * len(found)


def test_templates_as_a_table(spark):
    table = spark.createDataFrame([("House", "you may show this leaflet to anyone in the house but not take it away"), ("House", None), (None, "x"), ("Blank", " . ")], "license string, wording string")
    rows = [(1, "note: You may show this leaflet to anyone in the house, but not take it away! Released under the MIT License.", "en", "a", 0)]
    (r,) = licenses.scan_licenses(documents(spark, rows), table).collect()
    assert (r.licenses, r.n_matches, r.containment) == ("House", 1, 1.0)
    import pytest

    with pytest.raises(ValueError):
        licenses.listed(table, most_characters=10)
