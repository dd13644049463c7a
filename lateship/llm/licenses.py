"""License scan: normalised text against license templates by Dice similarity.

A text is cut into its lines, and the whole text is a passage too. Passages
and templates become sets of word bigrams. A passage of ``a`` bigrams can
reach a similarity ``t`` with a template of ``b`` only if
``t / (2 - t) * b <= a <= (2 - t) / t * b``; these bounds prune the templates
before any sets are intersected, and passages that no template admits are
dropped before their bigrams are made.

The templates are a small fixed table and stand in the plan as literals: no
join, no shuffle, no Python.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

THRESHOLD = 0.8

#: Customary license notices and short license texts.
NOTICES: dict[str, tuple[str, ...]] = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ),
    "MIT": (
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version.",
    ),
    "CC-BY-NC-4.0": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under the Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "CC-BY-4.0": ("This work is licensed under a Creative Commons Attribution 4.0 International License.",),
    "CC-BY-SA-4.0": ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",),
    "BSD-3-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met:",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ),
    "ARR": ("All rights reserved.",),
}


@dataclass(frozen=True)
class Template:
    license: str
    number: int
    bigrams: tuple[str, ...]


def normal_words(text: str) -> list[str]:
    """Lower-cased runs of ASCII letters and digits; other characters part words."""
    return re.findall(r"[0-9a-z]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text))


def bigrams_of(words: list[str]) -> set[str]:
    return {f"{a} {b}" for a, b in zip(words, words[1:])}


def templates(notices=None) -> list[Template]:
    """The templates with at least one bigram."""
    out = []
    for name, texts in (notices or NOTICES).items():
        for n, t in enumerate(texts):
            grams = bigrams_of(normal_words(t))
            if grams:
                out.append(Template(name, n, tuple(sorted(grams))))
    return out


def size_bounds(size: int, threshold: float) -> tuple[int, int]:
    """The passage sizes that can reach ``threshold`` against ``size`` bigrams."""
    ratio = threshold / (2 - threshold)
    return math.ceil(ratio * size - 1e-9), math.floor(size / ratio + 1e-9)


def _words(text: Column) -> Column:
    lower = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.regexp_extract_all(lower, F.lit("[0-9a-z]+"), F.lit(0))


def scan_licenses(df: DataFrame, text_col: str = "text", threshold: float = THRESHOLD, notices=None) -> DataFrame:
    """``df`` with ``licenses``: one entry ``(license, template, line, dice)``
    per passage and template at ``threshold`` or more.

    ``line`` is the number of the line from 1 (0: the whole text, listed only
    if it has more than one line). Entries stand in the order of line, license
    and template.

    Defined results: a null or empty text has no entries; ties between
    templates are all listed; repeated rows are each scanned; an empty input
    gives an empty result; very long texts are scanned whole; other columns
    pass through, and one named ``licenses`` is replaced.
    """
    known = templates(notices)
    kept = [F.col(f"`{c}`") for c in df.columns if c != "licenses"]
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    bounds = [size_bounds(len(t.bigrams), threshold) for t in known]
    low, high = min(b[0] for b in bounds), max(b[1] for b in bounds)
    # A set of n bigrams needs n + 1 words at least, and these 2n + 1
    # characters, so short lines go before their words are made. There is no
    # such bound from above: a long passage may repeat few bigrams.
    lines = F.transform(F.split(text, "\n"), lambda x, i: F.struct((i + 1).alias("line"), x.alias("t")))
    whole = F.when(F.size(lines) > 1, F.array(F.struct(F.lit(0).alias("line"), text.alias("t"))))
    passages = F.concat(F.coalesce(whole, F.array().cast("array<struct<line:int,t:string>>")), lines)
    admitted = F.filter(passages, lambda p: F.length(p["t"]) >= int(2 * low + 1))

    def grams(words: Column) -> Column:
        at = F.when(F.size(words) > 1, F.sequence(F.lit(1), F.size(words) - 1)).otherwise(F.array().cast("array<int>"))
        return F.array_distinct(F.transform(at, lambda i: F.concat_ws(" ", F.element_at(words, i), F.element_at(words, i + 1))))

    def sized(p: Column) -> Column:
        return F.struct(p["line"].alias("line"), _words(p["t"]).alias("w"))

    step1 = df.select(*kept, F.transform(admitted, sized).alias("__p"))
    # n distinct words stand in n - 1 distinct bigrams at least: passages above
    # the upper size bound go before their bigrams are made. k words of the
    # templates make k * k bigrams at most, and a match shares low or more.
    least = math.ceil(math.sqrt(low))
    words_of = F.array(*[F.lit(w) for w in sorted({w for t in known for g in t.bigrams for w in g.split(" ")})])
    step2 = step1.select(*kept, F.filter("__p", lambda p: (F.size(F.array_distinct(p["w"])) - 1 <= high)
                                         & (F.size(F.array_intersect(p["w"], words_of)) >= least)).alias("__p"))
    step3 = step2.select(*kept, F.transform("__p", lambda p: F.struct(p["line"].alias("line"), grams(p["w"]).alias("g"))).alias("__p"))

    def entries(p: Column) -> Column:
        found = []
        for t, (a, b) in zip(known, bounds):
            common = F.size(F.array_intersect(p["g"], F.array(*[F.lit(g) for g in t.bigrams])))
            dice = 2 * common / (F.size(p["g"]) + len(t.bigrams))
            entry = F.struct(p["line"].alias("line"), F.lit(t.license).alias("license"), F.lit(t.number).alias("template"), dice.alias("dice"))
            found.append(F.when((F.size(p["g"]) >= a) & (F.size(p["g"]) <= b), F.when(dice >= threshold, entry)))
        return F.array_compact(F.array(*found))

    found = F.array_sort(F.flatten(F.transform("__p", entries)))
    return step3.select(*kept, F.transform(found, lambda e: F.struct(
        e["license"].alias("license"), e["template"].alias("template"), e["line"].alias("line"), e["dice"].alias("dice"))).alias("licenses"))
