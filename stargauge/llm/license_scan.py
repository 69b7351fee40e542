"""Licence scan: passages compared to licence templates by the Dice coefficient of word bigrams.

Built-in column expressions only. Texts are normalised (lower case, anything but ASCII letters and digits
separates words, line breaks too), so a notice inside a paragraph, or wrapped over any number of lines, is the same
run of words. A passage is compared as one of at least the template's size: else the opening words that many
notices share ("this work is licensed under the") would match each of them. Bounds prune: a template of ``b``
bigrams can only reach the coefficient ``t`` with a text that holds at least ``t b`` of them (so one of the anchor
words that these cannot do without), and only with a passage of at least as many and at most ``(2 - t) b / t``
bigrams. So passages of a template begin at any of its bigrams in the text and are at most that long; the best
end of each begin counts. Each word takes the licence of the best passage over it, and a document the licences of
its words.

Defined results: a null or empty text has no licence (``licenses`` is empty, the best one null); of
equally good passages the shorter wins, then the name in alphabetical order; every row is judged on
its own; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stargauge.llm.common import let, table

THRESHOLD = 0.8

#: Licences and how short notices name them.
NAMES = {
    "AGPL-3.0": ("GNU Affero General Public License, version 3",),
    "Apache-2.0": ("Apache License, Version 2.0", "Apache License 2.0"),
    "BSD-2-Clause": ("BSD 2-Clause License", "Simplified BSD License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "New BSD License"),
    "CC-BY-4.0": ("CC BY 4.0", "Creative Commons Attribution 4.0 International License"),
    "CC-BY-NC-4.0": ("CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License"),
    "CC-BY-SA-4.0": ("CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International License"),
    "CC0-1.0": ("CC0 1.0", "Creative Commons Zero v1.0 Universal"),
    "GPL-2.0": ("GNU General Public License, version 2", "GNU GPL v2"),
    "GPL-3.0": ("GNU General Public License, version 3", "GNU GPL v3"),
    "LGPL-2.1": ("GNU Lesser General Public License, version 2.1",),
    "LGPL-3.0": ("GNU Lesser General Public License, version 3",),
    "MIT": ("MIT License",),
    "MPL-2.0": ("Mozilla Public License, version 2.0",),
}
NOTICES = ("Released under the {}.", "Licensed under the {}.", "This work is licensed under the {}.")
BARE_NOTICES = ("Released under {}.", "Licensed under {}.", "This work is licensed under {}.")

#: Opening and closing passages of licence texts and source headers.
PASSAGES = {
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software."
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "BSD-2-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met: Redistributions of source code must retain the above copyright notice, this "
        "list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above "
        "copyright notice, this list of conditions and the following disclaimer in the documentation and/or other "
        "materials provided with the distribution."
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS "
        "OF ANY KIND, either express or implied. See the License for the specific language governing permissions and "
        "limitations under the License."
    ),
    "GPL-3.0": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY "
        "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the "
        "GNU General Public License for more details."
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."
    ),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, "
        "publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, "
        "for any purpose, commercial or non-commercial, and by any means."
    ),
}


#: Words too common to serve as anchors.
FUNCTION_WORDS = frozenset(
    "a above all also an and any are as at be but by can can for from has have if in is it may no not of on one or "
    "other shall so that the this to under was will with without work you your".split()
)


def template_bigrams(text: str) -> list[str]:
    """The sorted set of a template's word bigrams."""
    words = re.findall(r"[a-z0-9]+", text.lower())
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:])})


def templates() -> list[tuple[str, list[str]]]:
    """Licence and bigrams of every template: each name in each notice, and the passages."""
    found = []
    for licence, names in sorted(NAMES.items()):
        for name in names:
            notices = BARE_NOTICES if name.startswith("CC") else NOTICES
            found += [(licence, template_bigrams(n.format(name))) for n in notices]
    found += [(licence, template_bigrams(text)) for licence, text in sorted(PASSAGES.items())]
    return found


def least_shared(size: int, threshold: float) -> int:
    """Bigrams of a template that any text reaching the threshold shares, at least."""
    return math.ceil(threshold * size - 1e-9)


def most_bigrams(size: int, threshold: float) -> int:
    """Bigrams of a passage that reaches the threshold with a template, at most."""
    return math.floor((2 - threshold) * size / threshold + 1e-9)


def anchors(known: list[tuple[str, list[str]]], threshold: float) -> list[str]:
    """Words of which a text must hold one to reach any template.

    All words of the templates but function words; where a template's bigrams of function words alone
    could reach the threshold, its function words count too.
    """
    found: set[str] = set()
    for _, some in known:
        words = {w for b in some for w in b.split()}
        rare = words - FUNCTION_WORDS
        without = [b for b in some if not rare & set(b.split())]
        found |= rare if len(without) < least_shared(len(some), threshold) else words
    return sorted(found)


def words_of(line: Column) -> Column:
    """Words of a lower-cased text."""
    return F.array_remove(F.split(line, "[^a-z0-9]+"), "")


def bigrams_of(words: Column) -> Column:
    """The bigrams of at least two words, in order."""
    return F.transform(F.sequence(F.lit(0), F.size(words) - 2), lambda i: F.concat_ws(" ", words[i], words[i + 1]))


def strings(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def template_column(known: list[tuple[str, list[str]]], threshold: float) -> Column:
    """The templates as one literal: licence, bigrams, how many of them a text needs, and the longest passage."""
    return F.array(
        *[
            F.struct(
                F.lit(licence).alias("license"), strings(some).alias("bigrams"),
                F.lit(least_shared(len(some), threshold)).alias("least"), F.lit(most_bigrams(len(some), threshold)).alias("most"),
            )
            for licence, some in known
        ]
    )


def within_reach(pairs: Column, known: list[tuple[str, list[str]]], threshold: float) -> Column:
    """The templates of which a text holds enough bigrams; none for most texts, which hold too few of any."""
    every = sorted({b for _, some in known for b in some})
    least = min(least_shared(len(some), threshold) for _, some in known)
    all_of_them = template_column(known, threshold)

    def reached(hits: Column) -> Column:
        enough = F.filter(all_of_them, lambda t: F.size(F.array_intersect(hits, t["bigrams"])) >= t["least"])
        return F.when(F.size(hits) >= least, enough)

    return let(F.array_intersect(pairs, strings(every)), reached)


def best_passages(pairs: Column, template: Column, threshold: float) -> Column:
    """For each place where a template's bigram stands, the best passage from there (null if none reaches the threshold)."""
    places = F.filter(F.sequence(F.lit(1), F.size(pairs)), lambda i: F.array_contains(template["bigrams"], F.element_at(pairs, i)))

    def best_from(first: Column) -> Column:
        def best_end(run: Column) -> Column:
            def measured(n: Column) -> Column:
                part = F.slice(run, 1, n)
                shared = F.size(F.array_intersect(part, template["bigrams"]))
                whole = F.size(template["bigrams"])
                size = F.greatest(F.size(F.array_distinct(part)), whole) + whole
                return F.struct((F.lit(2.0) * shared / size).alias("dice"), (-n).alias("shorter"))

            # The best passage ends with a bigram of the template, too.
            ends = F.filter(
                F.sequence(F.lit(1), F.size(run)),
                lambda n: F.array_contains(template["bigrams"], F.element_at(run, n)) & (n >= template["least"]),
            )
            return let(
                F.array_max(F.transform(ends, measured)),
                lambda x: F.when(
                    x["dice"] >= threshold,
                    F.struct(
                        template["license"].alias("license"), x["dice"].alias("dice"), first.alias("first"),
                        (1 - x["shorter"]).alias("n_words"),
                    ),
                ),
            )

        return let(F.slice(pairs, first, template["most"]), best_end)

    return F.filter(F.transform(places, best_from), lambda x: x.isNotNull())


def scan_licenses(docs: DataFrame, ident: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, n_license_words, licenses, best_license, best_dice`` of every row."""
    known = templates()
    lower = F.lower(F.coalesce(F.col(text), F.lit("")))
    anchor = strings(anchors(known, threshold))

    def passages(pairs: Column) -> Column:
        return let(
            within_reach(pairs, known, threshold),
            lambda some: F.flatten(F.transform(some, lambda t: best_passages(pairs, t, threshold))),
        )

    def of_words(words: Column) -> Column:
        return F.when(F.arrays_overlap(words, anchor) & (F.size(words) >= 2), let(bigrams_of(words), passages))

    numbered = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(ident).alias("doc_id"),
        let(words_of(lower), of_words).alias("passages"),
    )
    rows = numbered.select("row", "doc_id", F.explode_outer("passages").alias("found"))
    # All passages of a row stand in one task, so these groups shrink before they are shuffled.
    by_word = rows.select(
        "row",
        "doc_id",
        F.explode_outer(F.sequence(F.col("found.first"), F.col("found.first") + F.col("found.n_words") - 1)).alias("word"),
        F.when(
            F.col("found").isNotNull(),
            F.struct(
                (-F.col("found.dice")).alias("cost"),
                F.col("found.n_words").alias("n_words"),
                F.col("found.license").alias("license"),
            ),
        ).alias("match"),
    )
    best = by_word.groupBy("row", "doc_id", "word").agg(F.min("match").alias("match"))
    return (
        best.groupBy("row", "doc_id")
        .agg(
            F.count("match").alias("n_license_words"),
            F.array_join(F.array_sort(F.collect_set("match.license")), ",").alias("licenses"),
            F.min("match").alias("best"),
        )
        .select(
            "doc_id",
            "n_license_words",
            "licenses",
            F.col("best.license").alias("best_license"),
            (-F.col("best.cost")).alias("best_dice"),
        )
    )


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences of every document."""
    return scan_licenses(table(spark, sf_dir, "documents"))


def oracle_sql() -> str:
    """The same result in DuckDB: every passage between two bigrams of a template within its bounds."""
    values = ", ".join(
        f"({i}, '{licence}', [{', '.join(repr(b) for b in some)}], {least_shared(len(some), THRESHOLD)}, "
        f"{most_bigrams(len(some), THRESHOLD)})"
        for i, (licence, some) in enumerate(templates())
    )
    return f"""
WITH templates(t, license, bigrams, least, most) AS (VALUES {values}),
docs AS (
  SELECT row_number() OVER () AS k, doc_id, regexp_extract_all(lower(coalesce(text, '')), '[a-z0-9]+') AS words
  FROM documents),
pairs AS (SELECT k, list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1]) AS p FROM docs),
near AS (
  SELECT k, p, t.* FROM pairs, templates AS t WHERE len(list_intersect(list_distinct(p), t.bigrams)) >= least),
starts AS (
  SELECT k, t, license, bigrams, least, first, p[first : first + most - 1] AS run
  FROM near, unnest(range(1, len(p) + 1)) AS r(first) WHERE list_contains(bigrams, p[first])),
passages AS (
  SELECT k, t, license, first, n,
    2.0::DOUBLE * len(list_intersect(list_distinct(run[1 : n]), bigrams)) / (greatest(len(list_distinct(run[1 : n])), len(bigrams)) + len(bigrams)) AS dice
  FROM starts, unnest(range(1, len(run) + 1)) AS r(n)),
found AS (
  SELECT * FROM passages WHERE dice >= {THRESHOLD}
  QUALIFY row_number() OVER (PARTITION BY k, t, first ORDER BY dice DESC, n) = 1),
by_word AS (
  SELECT k, word, dice, n, license FROM found, unnest(range(first, first + n + 1)) AS r(word)
  QUALIFY row_number() OVER (PARTITION BY k, word ORDER BY dice DESC, n, license) = 1),
by_doc AS (
  SELECT k, count(*) AS n, string_agg(DISTINCT license, ',' ORDER BY license) AS licenses, max(dice) AS dice
  FROM by_word GROUP BY k),
best AS (
  SELECT k, license FROM by_word QUALIFY row_number() OVER (PARTITION BY k ORDER BY dice DESC, n, license) = 1)
SELECT doc_id, coalesce(n, 0) AS n_license_words, coalesce(licenses, '') AS licenses,
  license AS best_license, dice AS best_dice
FROM docs LEFT JOIN by_doc USING (k) LEFT JOIN best USING (k)
"""
