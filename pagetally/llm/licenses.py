"""License notices in texts: MinHash bands over overlapping windows, verified by containment.

Templates of similar length share a window size, chosen so that any occurrence of such a template
(up to a third longer than the template) lies whole in one window. A window and a template are
candidates if they agree in a band of MinHash values; the number of bands follows from the least
resemblance that a window with a match can have, so that a match is missed with a probability of
at most ``MISS``. A candidate counts if the window holds the share ``CONTAINED`` of the template's
five-word shingles, counted exactly. A template of fewer words is one shingle of its own width.
Of templates that are much alike, such as the notices of GPL and LGPL, one does not count where
the place that is most like it shows less of what only it has than of what only the other has.

Only windows that hold enough shingles of a group's templates for a match are signed. Texts are
read where they lie; nothing is shuffled.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator
from functools import lru_cache
from importlib import resources

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import hashing
from .common import as_bytes, slices
from .decontamination import WORDS

SHINGLE, CONTAINED, MISS = 5, 0.75, 1e-4
#: Resemblance from which two templates are told apart by what only one has.
ALIKE = 0.4

#: Notices, short texts and opening sentences of common licenses. Whole texts are in
#: the folder ``license_texts``.
TEMPLATES = {
    "agpl-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "agpl-notice":
        "This program is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU Affero General Public License as published by the Free Software Foundation, "
        "either version 3 of the License, or (at your option) any later version.",
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-notice":
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this "
        "file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0",
    "bsd-notice":
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met",
    "cc-by-4.0": "Licensed under CC BY 4.0.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "cc-by-sa-4.0": "Licensed under CC BY-SA 4.0.",
    "cc0": "has waived all copyright and related or neighboring rights to this work",
    "cc0-1.0": "Licensed under CC0 1.0 Universal.",
    "epl-1.0-notice":
        "This program and the accompanying materials are made available under the terms of the "
        "Eclipse Public License v1.0 which accompanies this distribution",
    "epl-2.0-notice":
        "This program and the accompanying materials are made available under the terms of the "
        "Eclipse Public License 2.0 which is available at",
    "gpl-1.0-notice":
        "This program is free software; you can redistribute it and/or modify it under the terms "
        "of the GNU General Public License as published by the Free Software Foundation; either "
        "version 1, or (at your option) any later version.",
    "gpl-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "gpl-2.0-notice":
        "This program is free software; you can redistribute it and/or modify it under the terms "
        "of the GNU General Public License as published by the Free Software Foundation; either "
        "version 2 of the License, or (at your option) any later version.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-notice":
        "This program is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU General Public License as published by the Free Software Foundation, either "
        "version 3 of the License, or (at your option) any later version.",
    "isc":
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted, provided that the above copyright notice and this "
        "permission notice appear in all copies.",
    "lgpl-2.0-notice":
        "This library is free software; you can redistribute it and/or modify it under the terms "
        "of the GNU Library General Public License as published by the Free Software Foundation; "
        "either version 2 of the License, or (at your option) any later version.",
    "lgpl-2.1": "This work is licensed under the GNU Lesser General Public License, version 2.1.",
    "lgpl-2.1-notice":
        "This library is free software; you can redistribute it and/or modify it under the terms "
        "of the GNU Lesser General Public License as published by the Free Software Foundation; "
        "either version 2.1 of the License, or (at your option) any later version.",
    "lgpl-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "lgpl-3.0-notice":
        "This program is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU Lesser General Public License as published by the Free Software Foundation, "
        "either version 3 of the License, or (at your option) any later version.",
    "mit": "Released under the MIT License.",
    "mit-notice":
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files (the \"Software\"), to deal in the Software "
        "without restriction, including without limitation the rights to use, copy, modify, "
        "merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so",
    "mpl-2.0":
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "ofl-1.1-notice":
        "This Font Software is licensed under the SIL Open Font License, Version 1.1.",
    "unlicense-notice": "This is free and unencumbered software released into the public domain.",
    "zlib":
        "This software is provided 'as-is', without any express or implied warranty. In no event "
        "will the authors be held liable for any damages arising from the use of this software. "
        "Permission is granted to anyone to use this software for any purpose, including "
        "commercial applications, and to alter it and redistribute it freely, subject to the "
        "following restrictions",
}
for _code, *_names in (
        ("cc-by", "Attribution"),
        ("cc-by-sa", "Attribution-ShareAlike", "Attribution-Share Alike"),
        ("cc-by-nc", "Attribution-NonCommercial", "Attribution-Non-Commercial"),
        ("cc-by-nd", "Attribution-NoDerivatives", "Attribution-NoDerivs"),
        ("cc-by-nc-sa", "Attribution-NonCommercial-ShareAlike",
         "Attribution-Non-Commercial-Share Alike"),
        ("cc-by-nc-nd", "Attribution-NonCommercial-NoDerivatives",
         "Attribution-NonCommercial-NoDerivs")):
    for _version in ("3.0 Unported", "4.0 International"):
        for _kind, _name in zip(("long", "variant"), _names):
            TEMPLATES[f"{_code}-{_version[:3]}-{_kind}"] = f"Creative Commons {_name} {_version}"
for _name in ("0BSD", "AGPL-3.0", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "BSL-1.0",
              "CC0-1.0", "EPL-2.0", "GPL-2.0", "GPL-3.0", "ISC", "LGPL-2.1", "LGPL-3.0", "MIT", "MPL-2.0",
              "Unlicense", "Zlib"):
    TEMPLATES[f"spdx-{_name.lower()}"] = f"SPDX-License-Identifier: {_name}"


@lru_cache(1)
def all_templates() -> dict[str, str]:
    """``TEMPLATES`` and the whole texts, as ``name-text``."""
    files = resources.files(__package__).joinpath("license_texts").iterdir()
    return TEMPLATES | {f"{f.name[:-4]}-text": f.read_text("utf-8") for f in files
                        if f.name.endswith(".txt")}


def text_words(text: bytes | None) -> np.ndarray:
    """Hashes of the words of a text: runs of letters, digits and other than ASCII."""
    return hashing.word_hashes([(text or b"").translate(WORDS)])[0]


def bands_for(resemblance: float, miss: float = MISS) -> tuple[int, int]:
    """(bands, rows): the fewest hashes with at most ``miss`` misses at that resemblance.

    Two sets of resemblance s agree in one of b bands of r rows with probability
    1 - (1 - s**r)**b.
    """
    choices = []
    for rows in (1, 2, 3):
        share = min(resemblance ** rows, 1 - 1e-9)
        choices.append((int(np.ceil(np.log(miss) / np.log1p(-share))), rows))
    # more rows mean fewer false candidates; they may double the hashes, not more
    least = min(b * r for b, r in choices)
    return max((c for c in choices if c[0] * c[1] <= 2 * least), key=lambda c: c[1])


class Group:
    """Templates of one length class and shingle size: window, step, bands, and the bands' keys."""

    def __init__(self, members: dict[str, np.ndarray], longest: int, shingle: int) -> None:
        self.members, self.shingle = members, shingle
        self.known = np.unique(np.concatenate(list(members.values())))
        occurrence = -(-4 * longest // 3) + 1
        self.step = max(1, occurrence // 2)
        #: shingles of a window: an occurrence, wherever it begins within a step
        self.width = max(1, occurrence + self.step - shingle + 1)
        least = min(len(set(t.tolist())) for t in members.values())
        #: distinct shingles of a template that a window with a match has at least
        self.held = int(np.ceil(CONTAINED * least))
        self.bands, self.rows = bands_for(self.held / (self.width + least - self.held))
        self.keys = defaultdict(set)
        for name, shingles in members.items():
            for key in self.signature(shingles):
                self.keys[key].add(name)

    def signature(self, shingles: np.ndarray) -> list[tuple[int, int]]:
        values = np.array([hashing.mixed(shingles, 1000 + k).min()
                           for k in range(self.bands * self.rows)])
        parts = values.reshape(self.bands, self.rows)
        key = parts[:, 0].copy()
        for k in range(1, self.rows):
            key = hashing.mixed(key ^ parts[:, k], k)
        return list(enumerate(key.tolist()))


class Scanner:
    """All templates, grouped by length, ready to scan texts."""

    def __init__(self, templates: dict[str, str]) -> None:
        by_length: dict[tuple[int, int], dict[str, np.ndarray]] = defaultdict(dict)
        longest: dict[tuple[int, int], int] = defaultdict(int)
        for name, text in sorted(templates.items()):
            words = text_words(text.encode())
            if len(words):
                shingle = min(SHINGLE, len(words))
                size = shingle, len(words).bit_length()
                by_length[size][name] = np.unique(hashing.runs(words, shingle))
                longest[size] = max(longest[size], len(words))
        self.groups = [Group(by_length[k], longest[k], k[0]) for k in sorted(by_length)]
        self.shingles = sorted({g.shingle for g in self.groups})
        self.rivals = self._rivals({n: t for g in self.groups if g.shingle == SHINGLE
                                    for n, t in g.members.items()})

    @staticmethod
    def _rivals(members: dict[str, np.ndarray]) -> dict[str, list[tuple[np.ndarray, np.ndarray]]]:
        """By template, for each other one that is much alike: what only it, only the other has."""
        found = defaultdict(list)
        for name, own in members.items():
            for other, its in members.items():
                small, large = sorted((len(own), len(its)))
                if other == name or small < ALIKE * large:
                    continue
                both = len(np.intersect1d(own, its, assume_unique=True))
                if both >= ALIKE * (small + large - both) and both < len(its):
                    found[name].append((np.setdiff1d(own, its, True), np.setdiff1d(its, own, True)))
        return dict(found)

    def _outdone(self, name: str, own: np.ndarray, part: np.ndarray) -> bool:
        """Whether the place that is most like the template shows more of what another has alone."""
        if name not in self.rivals:
            return False
        total = np.concatenate(([0], np.cumsum(np.isin(part, own))))
        size, slack = min(len(own), len(part)), max(SHINGLE, len(own) // 4)
        best = int((total[size:] - total[:len(total) - size]).argmax())
        part = part[max(0, best - slack):best + size + slack]

        def shown(shingles: np.ndarray) -> float:
            return float(np.isin(shingles, part).mean()) if len(shingles) else 1.0
        return any(shown(mine) < shown(its) for mine, its in self.rivals[name])

    def scan(self, words: np.ndarray) -> dict[str, tuple[float, int]]:
        """By template the best containment in a window, and the place of its first match."""
        found: dict[str, tuple[float, int]] = {}
        runs = {n: hashing.runs(words, n) for n in self.shingles}
        for group in self.groups:
            shingles = runs[group.shingle]
            at = np.minimum(np.searchsorted(group.known, shingles), len(group.known) - 1)
            hits = np.flatnonzero(group.known[at] == shingles)
            if len(hits) < group.held:
                continue
            first = np.maximum(0, (hits - group.width) // group.step + 1)
            windows = np.unique(np.concatenate(
                [first + k for k in range(-(-group.width // group.step) + 1)]))
            starts = windows[windows * group.step < len(shingles)] * group.step
            inside = np.searchsorted(hits, starts + group.width) - np.searchsorted(hits, starts)
            for start in starts[inside >= group.held].tolist():
                part = shingles[start:start + group.width]
                candidates = set()
                for key in group.signature(part):
                    candidates |= group.keys.get(key, set())
                for name in candidates:
                    own = group.members[name]
                    equal = np.isin(part, own)
                    share = len(np.unique(part[equal])) / len(own)
                    place = start + int(equal.argmax())
                    if share >= CONTAINED and (-share, place) < (
                            -found.get(name, (0.0, 0))[0], found.get(name, (0.0, 0))[1]) \
                            and not self._outdone(name, own, shingles[max(0, start - group.width):
                                                                      start + 2 * group.width]):
                        found[name] = (share, place)
        return found


def scan(docs: DataFrame, templates: dict[str, str] | None = None) -> DataFrame:
    """``doc_id, n_licenses, licenses, containments, first_words`` of each row's whole text.

    The arrays run in order of the template names; places count words from 0. Null and empty
    texts have no license; repeated rows and null ids give rows of their own; other columns are
    ignored; an empty table gives no rows. ``templates`` (name to text) go to every task: a list
    of notices, not a corpus.
    """
    templates = all_templates() if templates is None else templates
    if sum(map(len, templates.values())) > 8 << 20:
        raise ValueError("templates of more than 8 MiB are to be scanned for in parts")
    scanner = Scanner(templates)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            rows = [sorted(scanner.scan(text_words(t)).items())
                    for t in as_bytes(batch, "text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(r) for r in rows], pa.int32()),
                 pa.array([[n for n, _ in r] for r in rows], pa.list_(pa.string())),
                 pa.array([[x[0] for _, x in r] for r in rows], pa.list_(pa.float64())),
                 pa.array([[x[1] for _, x in r] for r in rows], pa.list_(pa.int64()))],
                names=["doc_id", "n_licenses", "licenses", "containments", "first_words"])
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, n_licenses int, licenses array<string>, containments array<double>, "
             "first_words array<long>")
