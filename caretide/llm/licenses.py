"""License scans: MinHash bands retrieve templates, shingle containment verifies them.

A template is known by its ``SHINGLE``-word shingles (a shorter one by all its words).
A document is cut into overlapping windows whose size follows the template's: they
start every quarter of its length and are long enough that any stretch of that
length lies in one of them. A template matches a window that holds at least
``containment`` of its shingles.

For such a window and template the Jaccard similarity has a lower bound; the number
of bands (of one MinHash each) is set from it so that a match is missed with a
probability of at most ``miss``. A window with a template's value in any band is
verified by counting the template's shingles in it, word by word. A window can share a
value with a template only if it holds one of its shingles, so that the bands of other
windows are not computed.

Notices of one family differ in a few words, so several templates match where one
stands. With ``best``, of matches in the same place (their stretches overlap by more
than half of the longer) only those with the highest containment stay, across blocks;
a notice inside a much longer one stays beside it.

Templates are taken in blocks of at most ``block``; documents stay where they are and
carry their matches from block to block.

Words: A-Z lower-cased, then runs of digits, a-z and characters beyond ASCII.

Cases: a null or empty text matches nothing, a template without words neither;
templates without an id are left out, equal ones all named; repeated rows give
repeated rows; a very long text is cut into more windows and read whole; an empty
table gives no rows. Other columns are dropped, but for those to be kept; one of these
named ``matches``, ``doc_id`` or ``text`` gives way.
"""

from __future__ import annotations

import math
from bisect import bisect_left, bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from caretide.llm import repeats
from caretide.llm.common import Batches, map_batches, texts
from caretide.llm.decontaminate import _TABLE, words
from caretide.session import ship

SHINGLE = 5
CONTAINMENT = 0.8
MISS = 1e-9
BLOCK = 1_000
#: Templates whose numbers of shingles differ by less than this share one window size.
SIZE_STEP = 1.25

# Notices by which common licenses are declared. Of a long license text the
# opening stands for the whole.
_NAMED = {
    "AGPL-3.0": "GNU Affero General Public License, version 3",
    "Apache-2.0": "Apache License, Version 2.0",
    "BSD-2-Clause": "BSD 2-Clause License",
    "BSD-3-Clause": "BSD 3-Clause License",
    "CC-BY-4.0": "CC BY 4.0",
    "CC-BY-NC-4.0": "CC BY-NC 4.0",
    "CC-BY-NC-ND-4.0": "CC BY-NC-ND 4.0",
    "CC-BY-NC-SA-4.0": "CC BY-NC-SA 4.0",
    "CC-BY-ND-4.0": "CC BY-ND 4.0",
    "CC-BY-SA-4.0": "CC BY-SA 4.0",
    "EPL-1.0": "Eclipse Public License, version 1.0",
    "EPL-2.0": "Eclipse Public License, version 2.0",
    "GPL-1.0": "GNU General Public License, version 1",
    "GPL-2.0": "GNU General Public License, version 2",
    "GPL-3.0": "GNU General Public License, version 3",
    "ISC": "ISC License",
    "LGPL-2.0": "GNU Library General Public License, version 2",
    "LGPL-2.1": "GNU Lesser General Public License, version 2.1",
    "LGPL-3.0": "GNU Lesser General Public License, version 3",
    "MIT-licensed": "MIT License",
    "MPL-1.1": "Mozilla Public License, version 1.1",
    "MPL-2.0": "Mozilla Public License, version 2.0",
}
# what is free software, how it is called, and the version
_GNU_HEADERS = {
    "AGPL-3.0": ("program", "Affero General", "3"),
    "GPL-1.0": ("program", "General", "1"),
    "GPL-2.0": ("program", "General", "2"),
    "GPL-3.0": ("program", "General", "3"),
    "LGPL-2.0": ("library", "Library General", "2"),
    "LGPL-2.1": ("library", "Lesser General", "2.1"),
    "LGPL-3.0": ("program", "Lesser General", "3"),
}
_SPDX = (
    "AGPL-3.0 AGPL-3.0-or-later Apache-2.0 BSD-2-Clause BSD-3-Clause CC-BY-4.0 CC-BY-SA-4.0 "
    "CC0-1.0 EPL-1.0 EPL-2.0 GPL-1.0 GPL-2.0 GPL-2.0-or-later GPL-3.0 GPL-3.0-or-later ISC "
    "LGPL-2.0 LGPL-2.1 LGPL-2.1-or-later LGPL-3.0 LGPL-3.0-or-later MIT MPL-1.1 MPL-2.0 "
    "Unlicense Zlib").split()
_BSD_OPENING = (
    "Redistribution and use in source and binary forms, with or without modification, are "
    "permitted provided that the following conditions are met")
_BSD_CONDITIONS = (
    f"{_BSD_OPENING}: 1. Redistributions of source code must retain the above copyright notice, "
    "this list of conditions and the following disclaimer. 2. Redistributions in binary form "
    "must reproduce the above copyright notice, this list of conditions and the following "
    "disclaimer in the documentation and/or other materials provided with the distribution.")
_MIT_PERMISSION = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
    "software and associated documentation files (the \"Software\"), to deal in the Software "
    "without restriction")
NOTICES = {
    **{name: f"Licensed under the {called}" for name, called in _NAMED.items()
       if not name.startswith("CC")},
    **{name: f"Licensed under {called}" for name, called in _NAMED.items()
       if name.startswith("CC")},
    **{f"{name}-header": (
        f"This {what} is free software: you can redistribute it and/or modify it under the terms "
        f"of the GNU {called} Public License as published by the Free Software Foundation, either "
        f"version {version} of the License, or (at your option) any later version")
       for name, (what, called, version) in _GNU_HEADERS.items()},
    **{f"{name}-SPDX": f"SPDX-License-Identifier: {name}" for name in _SPDX},
    "Apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this "
        "file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0"),
    "Apache-2.0-text": (
        "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND "
        "CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION 1. Definitions. \"License\" shall mean "
        "the terms and conditions for use, reproduction, and distribution as defined by Sections "
        "1 through 9 of this document"),
    "AGPL-3.0-text": (
        "Preamble The GNU Affero General Public License is a free, copyleft license for software "
        "and other kinds of works, specifically designed to ensure cooperation with the community "
        "in the case of network server software"),
    "BSD-2-Clause-text": (
        f"{_BSD_CONDITIONS} THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "
        "\"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES"),
    "BSD-3-Clause-text": (
        f"{_BSD_CONDITIONS} 3. Neither the name of the copyright holder nor the names of its "
        "contributors may be used to endorse or promote products derived from this software "
        "without specific prior written permission"),
    "BSD-4-Clause-advertising": (
        "All advertising materials mentioning features or use of this software must display the "
        "following acknowledgement: This product includes software developed by"),
    "BSD-redistribution": _BSD_OPENING,
    "CC0-1.0": "Released under CC0 1.0 Universal",
    "CC0-1.0-text": (
        "Statement of Purpose The laws of most jurisdictions throughout the world automatically "
        "confer exclusive Copyright and Related Rights (defined below) upon the creator and "
        "subsequent owner(s) (each and all, an \"owner\") of an original work of authorship "
        "and/or a database (each, a \"Work\")"),
    "EPL-1.0-header": (
        "This program and the accompanying materials are made available under the terms of the "
        "Eclipse Public License v1.0 which accompanies this distribution, and is available at "
        "http://www.eclipse.org/legal/epl-v10.html"),
    "EPL-2.0-header": (
        "This program and the accompanying materials are made available under the terms of the "
        "Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"),
    "GPL-1.0-text": (
        "Preamble The license agreements of most software companies try to keep users at the "
        "mercy of those companies. By contrast, our General Public License is intended to "
        "guarantee your freedom to share and change free software"),
    "GPL-2.0-only-header": (
        "This program is free software; you can redistribute it and/or modify it under the terms "
        "of the GNU General Public License version 2 as published by the Free Software Foundation"),
    "GPL-2.0-text": (
        "Preamble The licenses for most software are designed to take away your freedom to share "
        "and change it. By contrast, the GNU General Public License is intended to guarantee your "
        "freedom to share and change free software--to make sure the software is free for all its "
        "users. This General Public License applies to most of the Free Software Foundation's "
        "software"),
    "GPL-3.0-text": (
        "Preamble The GNU General Public License is a free, copyleft license for software and "
        "other kinds of works. The licenses for most software and other practical works are "
        "designed to take away your freedom to share and change the works"),
    "ISC-text": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted, provided that the above copyright notice and this "
        "permission notice appear in all copies"),
    "LGPL-2.0-text": (
        "By contrast, the GNU General Public Licenses are intended to guarantee your freedom to "
        "share and change free software--to make sure the software is free for all its users. "
        "This license, the Library General Public License, applies to some specially designated "
        "Free Software Foundation software"),
    "LGPL-2.1-text": (
        "By contrast, the GNU General Public Licenses are intended to guarantee your freedom to "
        "share and change free software--to make sure the software is free for all its users. "
        "This license, the Lesser General Public License, applies to some specially designated "
        "software packages--typically libraries"),
    "LGPL-3.0-text": (
        "This version of the GNU Lesser General Public License incorporates the terms and "
        "conditions of version 3 of the GNU General Public License, supplemented by the "
        "additional permissions listed below"),
    "MIT": "Released under the MIT License",
    "MIT-permission": _MIT_PERMISSION,
    "MIT-text": (
        f"{_MIT_PERMISSION}, including without limitation the rights to use, copy, modify, merge, "
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
        "persons to whom the Software is furnished to do so, subject to the following conditions: "
        "The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software"),
    "MPL-1.1-header": (
        "The contents of this file are subject to the Mozilla Public License Version 1.1 (the "
        "\"License\"); you may not use this file except in compliance with the License. You may "
        "obtain a copy of the License at http://www.mozilla.org/MPL/"),
    "MPL-2.0-header": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    "MPL-2.0-text": (
        "Mozilla Public License Version 2.0 1. Definitions 1.1. \"Contributor\" means each "
        "individual or legal entity that creates, contributes to the creation of, or owns Covered "
        "Software"),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free "
        "to copy, modify, publish, use, compile, sell, or distribute this software"),
    "Zlib": (
        "Permission is granted to anyone to use this software for any purpose, including "
        "commercial applications, and to alter it and redistribute it freely, subject to the "
        "following restrictions"),
}

MATCHES = T.ArrayType(T.StructType([
    T.StructField("license_id", T.StringType()), T.StructField("containment", T.DoubleType())]))
#: Every match with its words, the end exclusive: what is carried until all blocks are known.
_PLACED = T.ArrayType(T.StructType([
    *MATCHES.elementType.fields,
    T.StructField("start", T.LongType()), T.StructField("stop", T.LongType())]))


def notices(spark: SparkSession) -> DataFrame:
    """The built-in templates: ``license_id`` and ``text``."""
    return spark.createDataFrame(sorted(NOTICES.items()), "license_id string, text string")


def shingle_set(found: list[bytes], size: int) -> set[bytes]:
    return {b" ".join(found[i:i + size]) for i in range(len(found) - size + 1)}


class Scanner:
    """The windows, bands and shingles for templates of about one size."""

    def __init__(self, size: int, most: int, least: int, containment: float, miss: float):
        self.shingle, self.step = size, max(1, least // 4)
        self.blocks = -(-(most + self.step - 1) // self.step)
        held = math.ceil(containment * least - 1e-9)
        # the template's other shingles and the window's others are all that is not shared
        similar = held / (least - held + self.blocks * self.step)
        self.bands = 1 if similar >= 1 else math.ceil(math.log(miss) / math.log(1 - similar))
        self.containment = containment
        self.names: list[str] = []
        self.sets: list[set[bytes]] = []
        self.by_value: list[dict[int, set[int]]] = [{} for _ in range(self.bands)]
        self.values: list[np.ndarray] = []
        self.hashes = np.zeros(0, np.uint64)

    def band(self, hashes: np.ndarray, number: int) -> np.ndarray:
        salt = (number * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % (1 << 64)
        h = (hashes ^ np.uint64(salt)) * np.uint64(0xD6E8FEB86659FD93)
        return h ^ (h >> np.uint64(32))

    def add(self, name: str, shingles: set[bytes]) -> None:
        hashes = np.concatenate([
            repeats.Hasher(np.frombuffer(s, np.uint8))(np.array([0]), np.array([len(s)]))
            for s in sorted(shingles)])
        self.hashes = np.union1d(self.hashes, hashes)
        for number in range(self.bands):
            lowest = int(self.band(hashes, number).min())
            self.by_value[number].setdefault(lowest, set()).add(len(self.names))
        self.names.append(name)
        self.sets.append(shingles)

    def close(self) -> None:
        self.values = [np.array(sorted(v), np.uint64) for v in self.by_value]

    def candidates(
        self, hashed: np.ndarray, inside: np.ndarray, hits: np.ndarray
    ) -> dict[int, set[int]]:
        """By window number, the templates retrieved; ``hits`` are places of their shingles."""
        found: dict[int, set[int]] = {}
        hits = hits[np.isin(hashed[hits], self.hashes)]
        if not len(hits):
            return found
        none, reach = np.iinfo(np.uint64).max, np.arange(self.blocks)
        windows = np.unique(hits[:, None] // self.step - reach)
        windows = windows[windows >= 0]
        steps = np.unique(windows[:, None] + reach)
        steps = steps[steps * self.step < len(hashed)]
        place = np.searchsorted(steps, windows[:, None] + reach)  # past the end: the last
        at = steps[:, None] * self.step + np.arange(self.step)
        whole = at < len(hashed)
        at = np.minimum(at, len(hashed) - 1)
        whole &= inside[at]
        own = hashed[at]
        for number, values in enumerate(self.values):
            low = np.where(whole, self.band(own, number), none).min(axis=1)
            lowest = np.append(low, none)[place].min(axis=1)
            nearest = np.searchsorted(values, lowest)
            hit = values[np.minimum(nearest, len(values) - 1)] == lowest
            for window, value in zip(windows[hit].tolist(), lowest[hit].tolist()):
                found.setdefault(window, set()).update(self.by_value[number][value])
        return found

    def verify(self, units: repeats.Units, raw: bytes, window: int, templates: set[int]):
        """(owner, template, containment, start, stop) of the templates that the window holds.

        The stretch reaches from the first to the last word of the shingles held.
        """
        low = window * self.step
        high = min(low + self.blocks * self.step + self.shingle - 1, len(units))
        for owner in np.unique(units.owners(low, high)).tolist():
            first = int(units.first[owner])
            a, b = max(low, first), min(high, int(units.first[owner + 1]))
            if b - a < self.shingle:
                continue
            have: dict[bytes, list[int]] = {}
            found = raw[units.start[a]:units.stop[b - 1]].split(b" ")
            for n in range(len(found) - self.shingle + 1):
                have.setdefault(b" ".join(found[n:n + self.shingle]), []).append(n)
            for number in templates:
                held = self.sets[number] & have.keys()
                share = len(held) / len(self.sets[number])
                if share >= self.containment:
                    start, last = min(have[h][0] for h in held), max(have[h][-1] for h in held)
                    yield (owner, self.names[number], share, a - first + start,
                           a - first + last + self.shingle)


class Retrieval:
    """The scanners of all templates; a shingle length's hashes are computed once for them."""

    def __init__(self, made: list[Scanner]):
        self.by_size: dict[int, list[Scanner]] = {}
        for scanner in made:
            self.by_size.setdefault(scanner.shingle, []).append(scanner)
        self.known = {
            size: np.unique(np.concatenate([s.hashes for s in group]))
            for size, group in self.by_size.items()}
        self.marked = {}
        for size, known in self.known.items():  # most hashes fail a look into a small table
            self.marked[size] = np.zeros(1 << 16, bool)
            self.marked[size][(known & np.uint64(0xFFFF)).astype(np.int64)] = True

    def matches(self, units: repeats.Units):
        """All that ``Scanner.verify`` yields, over all windows that may hold a template."""
        raw = None
        for size, group in self.by_size.items():
            n = len(units) - size + 1
            if n < 1:
                continue
            hashed = repeats.Hasher(units.data)(units.start[:n], units.stop[size - 1:])
            hits = np.flatnonzero(self.marked[size][(hashed & np.uint64(0xFFFF)).view(np.int64)])
            hits = hits[np.isin(hashed[hits], self.known[size])]
            if not len(hits):
                continue
            owner = units.owners(0, len(units))
            inside = owner[:n] == owner[size - 1:]
            hits = hits[inside[hits]]
            raw = raw or units.data.tobytes()
            for scanner in group:
                for window, templates in scanner.candidates(hashed, inside, hits).items():
                    yield from scanner.verify(units, raw, window, templates)


def best_matches(found: list[tuple]) -> list[tuple]:
    """Of (name, containment, start, stop) those without a better one in the same place.

    Stretches are in the same place if they overlap by more than half of the longer;
    what a better match displaced displaces nothing itself.
    """
    order = sorted(found, key=lambda m: m[2:])
    starts = [m[2] for m in order]
    kept = [False] * len(order)
    for n in sorted(range(len(order)), key=lambda n: -order[n][1]):
        _, share, start, stop = order[n]
        # starts of stretches in the same place differ by less than the stretch's length
        near = range(bisect_left(starts, 2 * start - stop), bisect_right(starts, stop))
        kept[n] = not any(
            kept[o] and order[o][1] > share
            and 2 * (min(stop, order[o][3]) - max(start, order[o][2]))
            > max(stop - start, order[o][3] - order[o][2])
            for o in near)
    return [m for m, stays in zip(order, kept) if stays]


def scanners(templates: list, containment: float, miss: float) -> list[Scanner]:
    """One scanner for each shingle length and size class of the templates."""
    classes: dict[tuple[int, int], list] = {}
    for name, text in templates:
        found = words(text)
        if found:
            size = min(SHINGLE, len(found))
            shingles = shingle_set(found, size)
            place = math.floor(math.log(len(shingles), SIZE_STEP) + 1e-9)
            classes.setdefault((size, place), []).append((name, shingles, len(found) - size + 1))
    out = []
    for (size, _), group in sorted(classes.items(), key=lambda c: c[0]):
        # where a shingle repeats, the stretch is longer than the set
        most = max(stretch for _, _, stretch in group)
        scanner = Scanner(size, most, min(len(s) for _, s, _ in group), containment, miss)
        for name, shingles, _ in group:
            scanner.add(name, shingles)
        scanner.close()
        out.append(scanner)
    return out


def _scan(shared, first: bool, last: bool, best: bool):
    """Adds a block's matches to those that a document carries."""
    named, placed = _cells(MATCHES), _cells(_PLACED)

    def run(batches: Batches) -> Batches:
        retrieval = Retrieval(shared())

        def lay(group: list[bytes]) -> repeats.Units:
            return repeats.word_units([t.translate(_TABLE) for t in group])

        for batch in batches:
            # by name, or of every match with its stretch, the highest containment
            found: list[dict] = [{} for _ in range(batch.num_rows)] if first else [
                {(m["license_id"], m["start"], m["stop"]) if best else m["license_id"]:
                 m["containment"] for m in row}
                for row in batch.column("matches").to_pylist()]
            for units, rows in repeats._laid(batch, lay):
                for owner, name, share, start, stop in retrieval.matches(units):
                    own, key = found[rows.start + owner], (name, start, stop) if best else name
                    own[key] = max(own.get(key, 0.0), share)
            if best and last:
                found = [_by_name(row) for row in found]
            if best and not last:
                matches = pa.array([
                    [{"license_id": n, "containment": s, "start": a, "stop": b}
                     for (n, a, b), s in row.items()] for row in found], placed)
            else:
                matches = pa.array([
                    [{"license_id": n, "containment": s} for n, s in sorted(row.items())]
                    for row in found], named)
            names = [c for c in batch.schema.names if c != "matches"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), matches], names=[*names, "matches"])

    return run


def _cells(kind: T.ArrayType) -> pa.DataType:
    types = {T.StringType(): pa.string(), T.DoubleType(): pa.float64(), T.LongType(): pa.int64()}
    return pa.list_(pa.struct([(f.name, types[f.dataType]) for f in kind.elementType.fields]))


def _by_name(row: dict) -> dict[str, float]:
    out: dict[str, float] = {}
    for name, share, _, _ in best_matches([(n, s, a, b) for (n, a, b), s in row.items()]):
        out[name] = max(out.get(name, 0.0), share)
    return out


def scan(
    docs: DataFrame, templates: DataFrame, *keep: str, containment: float = CONTAINMENT,
    miss: float = MISS, block: int = BLOCK, best: bool = False,
) -> DataFrame:
    """``doc_id``, ``text``, the columns ``keep`` and ``matches``, sorted by license.

    A match has the highest containment found in a window. ``templates`` holds
    ``license_id`` and ``text``. With ``best``, a match gives way to a better one in the
    same place.
    """
    spark = docs.sparkSession
    carried = texts(docs, *keep, own=("matches",))
    fields = carried.schema.fields
    rows = templates.where(F.col("license_id").isNotNull()).select(
        F.col("license_id").cast("string").alias("license_id"),
        F.col("text").cast("string").alias("text")).distinct()
    blocks = math.ceil(rows.count() / block)
    part = F.pmod(F.xxhash64("license_id", "text"), F.lit(max(blocks, 1)))
    for number in range(blocks):
        held = [(r[0], r[1]) for r in rows.where(part == number).collect()]  # bounded by block
        shared = ship(spark, scanners(held, containment, miss))
        last = number == blocks - 1
        shape = T.StructType([
            *fields, T.StructField("matches", _PLACED if best and not last else MATCHES)])
        carried = map_batches(carried, _scan(shared, number == 0, last, best), shape)
    if not blocks:
        carried = carried.withColumn("matches", F.array().cast(MATCHES))
    return carried
