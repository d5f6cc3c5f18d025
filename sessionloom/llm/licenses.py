"""Licence scan: lines and whole texts against licence notices by Dice coefficient over word bigrams.

Only texts within the size bounds of a notice are compared with it: with threshold t, a set of a bigrams can reach t
against b bigrams only if t*b <= (2-t)*a and t*a <= (2-t)*b. Before that, one set look-up per line drops texts that
cannot reach any notice (see ``_anchors``). Each row is scanned by itself, so nothing is shuffled.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, functions as F

from .common import let

THRESHOLD = 0.8
# fixed values: notices as the licences' publishers word them, and the usual short forms
NOTICES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0"],
    "BSD": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided "
            "that the following conditions are met:",
            "Released under the BSD License."],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.",
                  "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.",
                     "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International "
                     "License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.",
                     "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International "
                     "License."],
    "CC0-1.0": ["To the extent possible under law, the author has waived all copyright and related or neighboring "
                "rights to this work."],
    "GPL-2.0": ["This work is licensed under the GNU General Public License, version 2."],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version."],
    "ISC": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
            "hereby granted, provided that the above copyright notice and this permission notice appear in all "
            "copies."],
    "MIT": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of "
        "the Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions:"],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of "
                "the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
}
_SEPARATOR = r"[^\p{L}\p{N}]+"


def notice_bigrams(text: str) -> list[str]:
    words = re.findall(r"[^\W_]+", text.lower())
    return list(dict.fromkeys(f"{a} {b}" for a, b in zip(words, words[1:])))


def _anchors(notices: dict[str, list[str]], threshold: float) -> list[str]:
    """Words of which every text that reaches ``threshold`` against some notice has at least one.

    Such a text shares at least ``need`` of a notice's bigrams, so it holds one of any ``size - need + 1`` of them;
    those with the longest words are taken, as long words are rare.
    """
    words = set()
    for text in (t for texts in notices.values() for t in texts):
        bigrams = sorted(notice_bigrams(text), key=lambda b: (-max(map(len, b.split())), b))
        need = math.ceil(threshold * len(bigrams) / (2 - threshold) - 1e-9)
        words.update(max(b.split(), key=len) for b in bigrams[:len(bigrams) - need + 1])
    return sorted(words)


def _bigrams(words: Column) -> Column:
    pairs = F.transform(F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))),
                        lambda w, i: F.concat_ws(" ", w, F.get(words, i + 1)))
    return F.array_distinct(pairs)


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), _SEPARATOR), lambda w: w != "")


def scanned(docs: DataFrame, *keep: str, text: str = "text", notices: dict[str, list[str]] | None = None,
            threshold: float = THRESHOLD) -> DataFrame:
    """Columns ``keep`` of every row of ``docs`` with the licences its text carries.

    Adds matches (array of licence, dice: the best notice of each line, and of the whole text if it has several
    lines), licenses (sorted names joined by commas, empty if there are none), n_matches, best_license and best_dice
    (null if there are none). Equal coefficients go to the first name. A missing text is an empty one. Words are runs
    of letters and digits in lower case; a text of one word has no bigram and matches nothing. Repeated rows give
    repeated results, and other columns are not looked at.
    """
    notices = NOTICES if notices is None else notices
    known = [(name, notice_bigrams(t)) for name in sorted(notices) for t in notices[name]]
    templates = F.array(*[F.struct(
        F.lit(name).alias("license"), F.lit(k).alias("rank"), F.lit(len(b)).alias("n"),
        F.array(*map(F.lit, b)).alias("bigrams")) for k, (name, b) in enumerate(known)])
    anchors = F.array(*map(F.lit, _anchors(notices, threshold)))

    def best(bigrams: Column) -> Column:
        n = F.size(bigrams)
        inside = F.filter(templates, lambda t: (threshold * t["n"] <= (2 - threshold) * n)
                          & (threshold * n <= (2 - threshold) * t["n"]))
        scores = F.transform(inside, lambda t: F.struct(
            (2.0 * F.size(F.array_intersect(bigrams, t["bigrams"])) / (n + t["n"])).alias("dice"),
            (-t["rank"]).alias("rank"), t["license"].alias("license")))
        return F.array_max(F.filter(scores, lambda s: s["dice"] >= threshold))

    lines = docs.select(*keep, F.transform(
        F.split(F.coalesce(F.col(text), F.lit("")), "\n"), _words).alias("_lines"))
    units = lines.select(*keep, F.filter(
        F.when(F.size("_lines") > 1, F.concat("_lines", F.array(F.flatten("_lines")))).otherwise(F.col("_lines")),
        lambda w: F.arrays_overlap(w, anchors)).alias("_units"))
    found = units.select(*keep, F.filter(
        F.transform("_units", lambda w: let(_bigrams(w), best)), lambda m: m.isNotNull()).alias("_found"))
    top = F.array_max("_found")
    return found.select(
        *keep, F.transform("_found", lambda m: F.struct(
            m["license"].alias("license"), m["dice"].alias("dice"))).alias("matches"),
        F.array_join(F.array_sort(F.array_distinct(F.transform("_found", lambda m: m["license"]))), ",").alias("licenses"),
        F.size("_found").cast("long").alias("n_matches"), top["license"].alias("best_license"), top["dice"].alias("best_dice"))
