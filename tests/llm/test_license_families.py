"""Every family and version of a license is told apart from its neighbours."""

import pytest

from caretide.llm import licenses, queries

GNU = ("This {} is free software; you can redistribute it and/or modify it under the terms of the "
       "GNU {} Public License as published by the Free Software Foundation; either version {} of "
       "the License, or (at your option) any later version.")
TEXTS = {
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3",
    "LGPL-2.1": "It is licensed under the GNU Lesser General Public License, version 2.1.",
    "AGPL-3.0": "licensed under the GNU Affero General Public License, version 3",
    "GPL-2.0-header": GNU.format("program", "General", "2"),
    "GPL-3.0-header": GNU.format("program", "General", "3"),
    "LGPL-2.1-header": GNU.format("library", "Lesser General", "2.1"),
    "LGPL-3.0-header": GNU.format("program", "Lesser General", "3"),
    "AGPL-3.0-header": GNU.format("program", "Affero General", "3"),
    "ISC-SPDX": "// SPDX-License-Identifier: ISC",
    "LGPL-3.0-SPDX": "# SPDX-License-Identifier: LGPL-3.0-only",
    "EPL-2.0": "Licensed under the Eclipse Public License, Version 2.0",
    "CC0-1.0": "released under CC0 1.0 Universal",
    "ISC-text": (
        "Permission to use, copy, modify, and distribute this software for any purpose with or "
        "without fee is hereby granted, provided that the above copyright notice and this "
        "permission notice appear in all copies."),
}


@pytest.mark.parametrize("block", [1_000, 40])
def test_each_notice_under_its_own_name(spark, block):
    names = sorted(TEXTS)
    rows = [(n, "foo bar " * 30 + TEXTS[name] + " baz" * 40) for n, name in enumerate(names)]
    # in one text, each of two neighbours keeps its own place
    rows.append((99, TEXTS["GPL-2.0-header"] + " x" * 60 + TEXTS["AGPL-3.0-header"]))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = licenses.scan(docs, licenses.notices(spark), block=block, best=True).collect()
    found = {r.doc_id: [m.license_id for m in r.matches] for r in got}
    assert {name: found[n] for n, name in enumerate(names)} == {name: [name] for name in names}
    assert found[99] == ["AGPL-3.0-header", "GPL-2.0-header"]


def test_registered_query_names_the_version(spark, tmp_path):
    rows = [(1, TEXTS["GPL-2.0"]), (2, TEXTS["LGPL-3.0-header"])]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(
        f"{tmp_path}/documents.parquet")
    got = queries.op7_license_scan(spark, str(tmp_path)).collect()
    assert {r.doc_id: r.licenses for r in got} == {1: "GPL-2.0", 2: "LGPL-3.0-header"}


def test_better_matches_displace_only_in_the_same_place():
    found = [("a", 1.0, 0, 10), ("b", 0.9, 1, 11), ("c", 0.8, 9, 19), ("d", 0.9, 0, 40),
             ("e", 1.0, 0, 9), ("f", 0.85, 5, 15)]
    # b is in a's place; f overlaps a by half only and stays; c is in f's place
    assert [m[0] for m in licenses.best_matches(found)] == ["e", "a", "d", "f"]
