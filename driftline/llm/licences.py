"""Licence notices in texts, by Dice coefficient with templates."""

from __future__ import annotations

import pkgutil
import re
from collections import Counter
from collections.abc import Iterable, Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

WORDS = re.compile(r"[^\W_]+")
LEAST = 0.8

# Notices as their licences suggest them or as people write them, and whole texts.
TEMPLATES = {
    "MIT": "Released under the MIT License.",
    "MIT-licensed": "Licensed under the MIT License.",
    "MIT-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": "you may not use this file except in compliance with the License. You may obtain a copy of the License at",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
    "LGPL": "it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
    "AGPL": "it under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    **{
        f"CC-{short}-{version}": f"This work is licensed under a Creative Commons {name} {version} {scope} License."
        for short, name in (
            ("BY", "Attribution"), ("BY-SA", "Attribution-ShareAlike"), ("BY-ND", "Attribution-NoDerivatives"), ("BY-NC", "Attribution-NonCommercial"),
            ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"), ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"),
        )
        for version, scope in (("4.0", "International"), ("3.0", "Unported"))
        if (short, version) not in (("BY", "4.0"), ("BY-SA", "4.0"), ("BY-NC", "4.0"))
    },
    "CC-BY-NC-4.0-notice": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    **{
        f"CC-{short}-{version}-short": f"Licensed under CC {short} {version}."
        for short in ("BY", "BY-SA", "BY-ND", "BY-NC", "BY-NC-SA", "BY-NC-ND")
        for version in ("4.0", "3.0")
        if (short, version) != ("BY-NC", "4.0")
    },
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    **{
        f"{short}-{version}": f"This work is licensed under the GNU {name} General Public License, version {version.removesuffix('.0')}."
        for short, name, version in (("LGPL", "Lesser", "2.1"), ("LGPL", "Lesser", "3.0"), ("AGPL", "Affero", "3.0"))
    },
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "BSD": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "MIT-text": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy,
        modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is
        furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all
        copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED,
        INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL
        THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
        OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "ISC-text": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
        provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE
        AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO
        EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM
        LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION
        WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}

# Whole texts, as they are handed out with Debian.
for _name in ("Apache-2.0", "BSD", "CC0-1.0", "GPL-2", "GPL-3", "LGPL-2.1", "LGPL-3", "MPL-2.0"):
    TEMPLATES[f"{_name}-text"] = pkgutil.get_data(__name__, f"licence_texts/{_name}.txt").decode("utf-8")


def bigrams(text: str | None) -> list[tuple[str, str]]:
    """The pairs of neighbouring words of a text in lower case without punctuation."""
    words = WORDS.findall((text or "").lower())
    return list(zip(words, words[1:], strict=False))


class Matcher:
    def __init__(self, templates: Mapping[str, str], least: float) -> None:
        self.least = least
        counts = {name: Counter(bigrams(t)) for name, t in sorted(templates.items())}
        self.names, self.sizes = list(counts), [c.total() for c in counts.values()]
        self.index = {pair: i for i, pair in enumerate(dict.fromkeys(p for c in counts.values() for p in c))}
        # How often each template has each pair.
        self.often = np.zeros((len(counts), len(self.index) + 1), np.int32)
        for t, c in enumerate(counts.values()):
            for pair, n in c.items():
                self.often[t, self.index[pair]] = n

    def _common(self, at: np.ndarray, ids: np.ndarray, often: np.ndarray, size: int) -> np.ndarray:
        """What a window beginning at each of the places shares with a template, pairs counting as often as both have them.

        A pair at a place counts in the windows that hold it and begin after the `often`-th such pair before it: one is added where
        these beginnings start and taken away where they end.
        """
        order = np.lexsort((at, ids))
        places, own = at[order], ids[order]
        first = np.searchsorted(own, own)
        nth = np.arange(len(own))
        back = nth - often[own]
        before = np.where(back >= first, places[np.maximum(back, 0)], -1)
        begin = np.maximum(before, places - size) + 1
        # Windows begin at places alone, so their numbers stand for the words.
        change = np.bincount(np.searchsorted(at, begin), minlength=len(at) + 1) - np.bincount(np.searchsorted(at, places, "right"), minlength=len(at) + 1)
        return np.cumsum(change)[:-1]

    def __call__(self, text: str | None) -> list[tuple[str, int, float]]:
        """For each template found: its name, the word at which its best window begins, the coefficient."""
        pairs = bigrams(text)
        ids = np.fromiter((self.index.get(p, -1) for p in pairs), np.int64, len(pairs))
        places = np.flatnonzero(ids >= 0)
        ids = ids[places]
        windows = []
        for t, (name, size) in enumerate(zip(self.names, self.sizes, strict=True)):
            # Sizes that differ more than this cannot reach the coefficient, nor can so few common pairs.
            shortest = size * self.least / (2 - self.least)
            least_pairs = self.least * (size + shortest) / 2
            if len(pairs) < shortest or len(places) < least_pairs:
                continue
            often = self.often[t]
            held = often[ids] > 0
            at = places[held]
            if len(at) < least_pairs:
                continue
            common = self._common(at, ids[held], often, size)
            ends = np.minimum(at + size, len(pairs))
            dice = 2 * common / (size + ends - at)
            last = at[np.searchsorted(at, ends) - 1] + 1
            windows += [(-float(dice[i]), -size, int(at[i]), int(last[i]), name) for i in np.flatnonzero(dice >= self.least)]
        # The best windows first: what they claim is no other template's.
        found, claimed = {}, np.zeros(len(pairs), bool)
        for dice, _, begin, end, name in sorted(windows):
            if 2 * int(np.count_nonzero(claimed[begin:end])) <= end - begin:
                claimed[begin:end] = True
                found.setdefault(name, (name, begin, -dice))
        return [found[name] for name in sorted(found)]


# Templates of whole texts are named by their version's first number.
_SAME = {"GPL-2": "GPL-2.0", "GPL-3": "GPL-3.0", "LGPL-3": "LGPL-3.0", "BSD": "BSD-3-Clause"}


def licence_of(template: str) -> str:
    """The licence that a template tells: a notice, header or short form names the same one as the whole text. A header without a version
    names a licence without one."""
    name = re.sub(r"-(?:text|header|notice|short|grant|licensed)$", "", template)
    return _SAME.get(name, name)


def find_licences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, templates: Mapping[str, str] = TEMPLATES, least: float = LEAST) -> DataFrame:
    """One row per document and licence template found in it: `doc_id`, `licence` (the template's name), `names` (the licence it tells),
    `at_word`, `dice`.

    Text and templates are compared as bags of pairs of neighbouring words, in lower case and without punctuation.
    A window of the text is as long as the template (or what is left of the text) and begins with one of the
    template's pairs; a template matches if its best window has a Dice coefficient of `least` or more. A passage belongs to
    the template of the highest coefficient, the longer of equals: windows that lie in it by more than half are not counted for others.
    Templates too long for the text, or with too few of their pairs in it, are passed over.
    Null and empty texts match nothing, very long ones are read whole, and repeated rows give repeated results; other columns are
    not looked at. Work grows with the text and the pairs it shares, not with the templates' sizes. The templates are small and go to every task.
    """
    id_type = dict(docs.dtypes)[id_col]
    settings = dict(templates)

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        match = Matcher(settings, least)
        for batch in batches:
            found = [(i, m) for i, text in enumerate(batch.column(text_col)) for m in match(text.as_py())]
            yield pa.RecordBatch.from_arrays([
                batch.column(id_col).take(pa.array([i for i, _ in found], pa.int64())), pa.array([m[0] for _, m in found], pa.string()),
                pa.array([licence_of(m[0]) for _, m in found], pa.string()), pa.array([m[1] for _, m in found], pa.int32()),
                pa.array([m[2] for _, m in found], pa.float64()),
            ], names=["doc_id", "licence", "names", "at_word", "dice"])

    return docs.select(id_col, text_col).mapInArrow(work, f"doc_id {id_type}, licence string, names string, at_word int, dice double")
