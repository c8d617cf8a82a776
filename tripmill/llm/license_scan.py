"""License scan: normalised lines and texts against licence templates, by Dice coefficient.

A unit is a line, or a whole text of several lines. Its set is that of its distinct word
bigrams; a template matches if twice the common bigrams over the sum of both sizes reaches
``MIN_DICE``. Sizes bound the coefficient, so a template is compared only with units whose size
lies within its bounds, and two cheap bounds on a unit's size (its words, its distinct words)
decide before any bigram is built. All is one projection of a row: nothing is shuffled, and a
hot source or a group of copies is no different from other rows. The template list is a
parameter and travels with the plan; it is limited by ``MAX_TEMPLATES``.

Notices wrapped over lines and whole licence texts inside a document are *passages*: windows of as many
consecutive words as the template has, beginning at any of the template's bigrams. Those that match are taken from
left to right; of overlapping ones a better one replaces the one before. A text that lacks the words or bigrams that any match needs, three
fifths of the bigrams at 3/4, is not looked at further. The cost of a candidate is that of the template's length
for each place where a window begins.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Sequence
from functools import cache
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.llm.common import BETWEEN, bound, words_of

MIN_DICE = 0.75
MAX_TEMPLATES = 1000

#: The notices by which public licences ask to be applied.
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0. Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)


@cache
def complete_texts() -> tuple[tuple[str, str], ...]:
    """The complete licence texts that lie beside this file, named by their licences."""
    folder = Path(__file__).with_name("licenses")
    return tuple((file.stem, file.read_text("utf-8")) for file in sorted(folder.glob("*.txt")))


def _words(text: str | None) -> list[str]:
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [w for w in re.split(BETWEEN, lowered) if w]


def _fewest_words(words: Sequence[str], share: float) -> int:
    """How many different words hold ``share`` of a template's bigrams, at least.

    A bigram that is held has both its words, so the words' numbers of bigrams add up to twice the share.
    """
    pairs = {(a, b) for a, b in zip(words, words[1:], strict=False)}
    held = sorted(Counter(w for pair in pairs for w in pair).values(), reverse=True)
    need, k = 2 * share * len(pairs), 0
    while need > 1e-9:
        need -= held[k]
        k += 1
    return k


def _passages(words: Column, templates: Sequence[tuple[str, str]], min_dice: float) -> Column:
    """Windows of each template that match it: license, start, end (words) and dice."""
    sized = sorted({(name, tuple(w)) for name, t in templates if len(w := _words(t)) > 1})
    if not sized:
        return F.expr("cast(array() as array<struct<license:string,start:int,end:int,dice:double>>)")
    if len(sized) > MAX_TEMPLATES:
        raise ValueError(f"more than {MAX_TEMPLATES} templates")
    # what a window must hold of a template's bigrams, whatever else is in it
    share = min_dice / (2 - min_dice)

    def listed(texts) -> Column:
        return F.split(F.lit("\n".join(sorted(texts))), "\n")

    rows = [(name, {f"{a} {b}" for a, b in zip(w, w[1:], strict=False)}, w) for name, w in sized]
    known = F.array(*[
        F.struct(
            F.lit(name).alias("license"), listed(pairs).alias("pairs"), F.lit(len(pairs)).alias("n"), F.lit(len(w)).alias("words"),
            listed(set(w)).alias("vocabulary"), F.lit(_fewest_words(w, share)).alias("fewest"),
        )
        for name, pairs, w in rows
    ])
    every = listed({x for _, w in sized for x in w})
    in_order = F.zip_with(F.slice(words, 1, F.size(words) - 1), F.slice(words, 2, F.size(words) - 1), lambda a, b: F.concat_ws(" ", a, b))
    fewest = min(_fewest_words(w, share) for _, w in sized)
    kind = "array<struct<start:int,end:int,dice:double>>"

    def windows(t: Column, pairs: Column) -> Column:
        """Matching windows from left to right; of those that overlap, one that is better than the one before."""
        length = t["words"] - 1
        at = F.sequence(F.lit(0), F.size(pairs) - 1)
        hit = F.transform(pairs, lambda b: F.array_contains(t["pairs"], b))

        def begins(hits: Column) -> Column:
            # a window needs that many bigrams of the template before its distinct ones are worth counting
            enough = lambda i: F.size(F.filter(F.slice(hits, i + 1, length), lambda h: h)) >= share * t["n"] - 1e-9
            return F.filter(at, lambda i: F.get(hits, i) & enough(i))

        def scored(i: Column) -> Column:
            own = F.array_distinct(F.slice(pairs, i + 1, length))
            dice = 2.0 * F.size(F.array_intersect(t["pairs"], own)) / (t["n"] + F.size(own))
            return F.struct(i.alias("start"), F.least(i + t["words"], F.size(pairs) + 1).alias("end"), dice.alias("dice"))

        found = F.flatten(F.transform(F.array(hit), lambda hits: F.transform(begins(hits), scored)))

        def kept(taken: Column, w: Column) -> Column:
            return (
                F.when((F.size(taken) == 0) | (w["start"] >= F.coalesce(F.try_element_at(taken, F.lit(-1))["end"], F.lit(0))), F.concat(taken, F.array(w)))
                .when(w["dice"] > F.try_element_at(taken, F.lit(-1))["dice"], F.concat(F.slice(taken, 1, F.size(taken) - 1), F.array(w)))
                .otherwise(taken)
            )

        return F.aggregate(F.filter(found, lambda w: w["dice"] >= min_dice), F.expr(f"cast(array() as {kind})"), kept)

    def named(t: Column, pairs: Column) -> Column:
        return F.transform(
            windows(t, pairs),
            lambda w: F.struct(t["license"].alias("license"), w["start"].alias("start"), w["end"].alias("end"), w["dice"].alias("dice")),
        )

    def found(pairs: Column, able: Column) -> Column:
        enough = F.filter(able, lambda t: F.size(F.array_intersect(t["pairs"], pairs)) >= share * t["n"] - 1e-9)
        return F.flatten(F.transform(enough, lambda t: named(t, pairs)))

    def of(common: Column) -> Column:
        able = F.filter(known, lambda t: F.size(F.array_intersect(t["vocabulary"], common)) >= t["fewest"])
        return F.when(
            F.size(common) >= fewest,
            F.flatten(F.transform(F.array(able), lambda ts: F.when(F.size(ts) > 0, F.flatten(F.transform(F.array(in_order), lambda pairs: found(pairs, ts)))))),
        )

    none = F.expr("cast(array() as array<struct<license:string,start:int,end:int,dice:double>>)")
    # each array of one element binds what it holds, so that it is computed once
    held = F.flatten(F.transform(F.array(F.array_intersect(every, words)), of))
    return F.when(F.size(words) > 1, F.coalesce(held, none)).otherwise(none)


def _template_sets(templates: Sequence[tuple[str, str]]) -> list[tuple[str, list[str]]]:
    """Distinct (license, sorted bigrams); a template of fewer than two words matches nothing."""
    if len(templates) > MAX_TEMPLATES:
        raise ValueError(f"more than {MAX_TEMPLATES} templates")
    found = set()
    for name, text in templates:
        words = _words(text)
        pairs = tuple(sorted({f"{a} {b}" for a, b in zip(words, words[1:], strict=False)}))
        if pairs:
            found.add((name, pairs))
    return [(name, list(pairs)) for name, pairs in sorted(found)]


def license_scan(
    docs: DataFrame,
    templates: Sequence[tuple[str, str]] = TEMPLATES,
    min_dice: float = MIN_DICE,
    complete: Sequence[tuple[str, str]] | None = None,
) -> DataFrame:
    """``docs`` with n_matches, licenses, best_license, best_dice and passages.

    ``n_matches`` counts (unit, template) pairs, repeated lines each; ``licenses`` are the
    distinct names, sorted and comma-joined ('' if none); the best match is that of the highest
    coefficient, then of the first name (null if none). ``passages`` has the windows that match a
    template, or a text of ``complete`` (``complete_texts()``, unless given), without overlaps for one template:
    license, start, end (words of the text, end exclusive) and dice. It adds to the columns before, which
    are those of lines and whole texts with ``templates`` alone. Null and empty texts match nothing; equal
    rows get equal results; input columns with a result's name are replaced, others pass through.
    """
    results = ["n_matches", "licenses", "best_license", "best_dice", "passages"]
    base = docs.drop(*results)
    complete = complete_texts() if complete is None else complete
    lines = F.split(F.coalesce(F.col("text").cast("string"), F.lit("")), "\n", -1)
    # a line feed stands between words, so a text's words are those of its lines
    base_columns = [F.col(f"`{c}`") for c in base.columns]
    base = bound(bound(base, "_lines", F.transform(lines, words_of)), "_words", F.flatten("_lines"))
    passages = _passages(F.col("_words"), [*templates, *complete], min_dice)
    sets = _template_sets(templates)
    if not sets:
        none = F.lit(None)
        return base.select(*base_columns, F.lit(0).cast("long").alias("n_matches"), F.lit("").alias("licenses"),
                           none.cast("string").alias("best_license"), none.cast("double").alias("best_dice"), passages.alias("passages"))
    known = F.array(*[
        F.struct(F.lit(name).alias("license"), F.array(*map(F.lit, pairs)).alias("pairs"), F.lit(len(pairs)).alias("n"))
        for name, pairs in sets
    ])

    def able(n_template: Column, least: Column, most: Column) -> Column:
        """Whether a set with ``least`` to ``most`` members can reach the coefficient."""
        return (2 * F.least(n_template, most) >= min_dice * (n_template + F.least(n_template, most))) & (
            2 * n_template >= min_dice * (n_template + F.greatest(n_template, least))
        )

    def bigrams(words: Column) -> Column:
        at = F.sequence(F.lit(0), F.size(words) - 2)
        return F.array_distinct(F.transform(at, lambda i: F.concat_ws(" ", F.get(words, i), F.get(words, i + 1))))

    sizes = sorted({len(pairs) for _, pairs in sets})
    in_words = F.concat("_lines", F.when(F.size("_lines") > 1, F.array("_words")).otherwise(F.expr("cast(array() as array<array<string>>)")))
    # beyond so many different bigrams no template can match
    most_able = max(int(n * (2 - min_dice) / min_dice + 1e-9) for n in sizes)

    def possible(words: Column) -> Column:
        # every distinct word but the first ends a bigram of its own
        least, most = F.size(F.array_distinct(words)) - 1, F.size(words) - 1
        fits = F.lit(False)
        for n in sizes:
            fits = fits | able(F.lit(n), least, most)
        # a long text has that many within its first words, which settles it
        few = F.size(F.array_distinct(F.slice(words, 1, 2 * most_able))) - 1 <= most_able
        return (F.size(words) >= 2) & few & fits

    def compare(pairs: Column) -> Column:
        n = F.size(pairs)
        near = F.filter(known, lambda t: able(t["n"], n, n))
        scored = F.transform(
            near,
            lambda t: F.struct(
                (2.0 * F.size(F.array_intersect(t["pairs"], pairs)) / (t["n"] + n)).alias("dice"),
                t["license"].alias("license"),
            ),
        )
        return F.filter(scored, lambda s: s["dice"] >= min_dice)

    found = F.flatten(F.transform(F.transform(F.filter(in_words, possible), bigrams), compare))
    matched = bound(base, "_found", found)
    best = F.array_sort(F.transform("_found", lambda s: F.struct((-s["dice"]).alias("low"), s["license"].alias("license"))))
    return (
        matched.withColumns(
            {
                "n_matches": F.size("_found").cast("long"),
                "licenses": F.array_join(F.array_sort(F.array_distinct(F.col("_found.license"))), ","),
                "best_license": F.get(best, 0)["license"],
                "best_dice": -F.get(best, 0)["low"],
                "passages": passages,
            }
        )
        .select(*base_columns, *results)
    )
