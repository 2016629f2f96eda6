"""Whole units match after normalisation, parts of units don't."""

from __future__ import annotations

from pathlib import Path

from riskloom.llm import licenses
from tests.llm import helpers


def test_units(spark):
    mit = licenses.KNOWN["MIT"][0]
    texts = [
        "Copyright (c) 2019-2021 Jane Doe\n\n" + mit.upper(), "code\n\n" + "Released under the mit licence!\nmore", "All rights reserved. Or not.",
        "a\nALL RIGHTS RESERVED", mit[:-20], "Licensed under the Apache License, Ver. 2.0",
    ]
    known = licenses.registry(spark)
    got = {r["doc_id"]: r for r in licenses.summary(helpers.docs(spark, texts + helpers.AWKWARD), known).collect()}
    assert got[0]["text_license"] == "MIT"
    assert got[1]["licenses"] == "MIT" and got[1]["text_license"] is None
    assert got[2]["n_matches"] == 0 and got[4]["n_matches"] == 0
    assert got[3]["licenses"] == "Proprietary"
    assert got[5]["text_license"] == "Apache-2.0"
    assert all(got[i]["n_matches"] == 0 for i in range(len(texts), len(got))) and len(got) == len(texts) + len(helpers.AWKWARD)


def test_empty_tables(spark):
    known = licenses.registry(spark)
    assert licenses.summary(helpers.empty(spark), known).count() == 0
    assert licenses.summary(helpers.docs(spark, ["All rights reserved."]), known.limit(0)).first()["n_matches"] == 0


def test_published_texts_and_notice_forms(spark):
    folder = Path(licenses.__file__).parent / "license_texts"
    texts = {
        "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.", "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
        "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "AGPL-3.0": "Released under the GNU AGPL version 3", "LGPL-2.1": (folder / "LGPL-2.1.txt").read_text(), "GPL-2.0": (folder / "GPL-2.0.txt").read_text(),
        "BSD-3-Clause": "Copyright (c) 2001 A\n\n" + licenses._BSD_3 + licenses._BSD_END, "Unlicense": (folder / "Unlicense.txt").read_text(),
    }
    got = licenses.summary(helpers.docs(spark, list(texts.values())), licenses.registry(spark)).collect()
    assert [r["text_license"] for r in sorted(got, key=lambda r: r["doc_id"])] == list(texts)


def test_holders_without_year_and_passages(spark):
    mit, isc = licenses.KNOWN["MIT"][0], licenses.KNOWN["ISC"][0]
    commented = "\n".join(" * " + line for line in mit.split("\n"))
    gpl = (Path(licenses.__file__).parent / "license_texts" / "GPL-3.0.txt").read_text()
    whole = ["Copyright (c) Jane Doe\n\n" + mit, "Copyright The Authors\nAll rights reserved.\n" + isc, "MIT License\n\n(c) Jane Doe\n\n" + mit]
    inside = [mit + "\n\nint main() {}", "Some words.\n\n" + isc + "\n\nmore", "/*\n * Copyright Jane\n *\n" + commented + "\n */\nint x;\n", "intro\n\n" + gpl]
    nothing = [mit.split("\n\n")[0] + "\n\n" + mit.split("\n\n")[2], "\n\n".join(reversed(isc.split("\n\n"))), "Copyright notice and more words\n\nof a text"]
    got = licenses.summary(helpers.docs(spark, whole + inside + nothing + [inside[0]]), licenses.registry(spark)).collect()
    got = [r for r in sorted(got, key=lambda r: r["doc_id"])]
    assert [(r["text_license"], r["n_matches"]) for r in got[:3]] == [("MIT", 1), ("ISC", 2), ("MIT", 1)]  # and the line "All rights reserved."
    assert [(r["text_license"], r["licenses"]) for r in got[3:7]] == [(None, "MIT"), (None, "ISC"), (None, "MIT"), (None, "GPL-3.0")]
    assert [r["n_matches"] for r in got[7:10]] == [0, 0, 0] and got[10]["n_matches"] == 1
