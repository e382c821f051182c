"""License scans: min-max hashing of overlapping text windows, then exact containment.

Texts and license templates are cut into five-word shingles, and these into windows of
two neighbours, one starting at every shingle.  Of a window the least and the greatest
shingle hash are kept, each a band of its own.  A shingle is always the least or the
greatest of its window of two, so a text that holds any shingle of a template meets it
in some band with certainty; wider windows would need many hash functions for less.  In
the texts met every template is then verified: the part of its distinct shingles, compared
as words, that the text holds must be ``percent`` or more.

A license has a first template and any number of notices, that is usual wordings and
passages of its text, and is reported once when any of them is contained: the first
template if it is, else the first notice listed.  A notice may have several parts, each
of which must be contained, in any place of the text: what tells a license from its
relatives (a version, *Lesser*) is a part of its own, so that the rest of the wording
cannot outweigh it.  The texts of licenses say more than a notice can; one word changed in
one passage leaves the other passages.  Wordings that are not listed are not found, and
neither are names without five words around them (*License: MIT*).

Built-in expressions only, one pass over the texts, no shuffle.  The templates are a
parameter and become literals of the plan, bounded by :data:`MAX_TEMPLATE_WORDS`.

Defined results: words are runs of letters and digits, in lower case, so punctuation
around them does not matter; NULL text and texts of fewer than five words hold no
shingle and no license; each row of ``docs`` is scanned by itself, so equal or NULL ids
and repeated rows need no special case; an empty table gives no rows; other columns are
ignored, whatever their names; licenses of one text are listed by name.
"""

from __future__ import annotations

import json
import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from dqgate.llm.common import computed

#: All templates together may have this many words.
MAX_TEMPLATE_WORDS = 20_000
SHINGLE = 5
PERCENT = 75
TOKEN = r"[\p{L}\p{N}]+(?:[.-][\p{L}\p{N}]+)*"

# Notices by which works name their license.
TEMPLATES: dict[str, str] = {
    "agpl-3.0": "under the terms of the GNU Affero General Public License, version 3",
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "cc-by-sa-4.0": "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    "cc0-1.0": "has waived all copyright and related or neighboring rights to this work",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee",
    "lgpl-2.1": "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
    "mit": "Released under the MIT License.",
    "mit-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "unlicense": "This is free and unencumbered software released into the public domain",
}

_GIVEN = ("licensed", "released", "distributed", "available", "published", "provided", "issued", "offered", "shared", "covered")


def _under(*names: str) -> tuple[tuple[str, ...], ...]:
    return tuple((f"{verb} {'by' if verb == 'covered' else 'under'} {name}",) for verb in _GIVEN for name in names)


def _gnu(kind: str, version: str) -> tuple[tuple[str, ...], ...]:
    """Notices that name a GNU license in full, and one version of it."""
    said = f"General Public License version {version}"
    named = tuple((f"{verb} {'by' if verb == 'covered' else 'under'} the GNU {kind}General Public License",) for verb in _GIVEN)
    terms = f"under the terms of the GNU {kind}General Public License"
    dated = tuple((*n, said) for n in (*named, (terms,)))
    short = tuple((*n, f"GNU {kind}General Public License v{version}{tail}") for n in (*named, (terms,)) for tail in ("", ".0"))
    published = tuple(
        (f"{start} the GNU {kind}General Public License", f"Foundation either version {version} of the License")
        for start in ("under the terms of", "terms and conditions of")
    )
    only = ((terms, f"the Free Software Foundation version {version} of the License"), (terms, f"terms version {version} of the License"))
    return (*dated, *short, *published, *only)


# Further templates, each the parts of one notice.
NOTICES: dict[str, tuple[tuple[str, ...], ...]] = {
    "agpl-3.0": (
        *_gnu("Affero ", "3"),
        ("under the GNU AGPL v3",), ("under the GNU AGPL version 3",),
        ("offer all users interacting with it remotely through a computer network an opportunity to receive the Corresponding Source",),
    ),
    "apache-2.0": (
        ("under the Apache License Version 2.0",), ("under the Apache License 2.0",), ("under the Apache 2.0 License",),
        ("under the Apache Software License 2.0",), *_under("the Apache-2.0 license", "Apache License 2.0", "an Apache 2.0 license"),
        ("you may not use this file except in compliance with the License", "obtain a copy of the License at"),
        ("distributed under the License is distributed on an AS IS BASIS WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND",),
        ("a perpetual worldwide non-exclusive no-charge royalty-free irrevocable copyright license to reproduce prepare Derivative Works of",),
    ),
    "bsd": (
        ("Redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",),
        ("Redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer",),
        ("may be used to endorse or promote products derived from this software without specific prior written permission",),
        *_under("the BSD license", "a BSD license", "a BSD-style license", "the BSD 3-Clause License", "the BSD 2-Clause License",
                "the 3-clause BSD license", "the 2-clause BSD license", "the new BSD license", "the modified BSD license"),
    ),
    "cc-by-4.0": (
        ("Creative Commons Attribution 4.0 International",), ("under the Creative Commons Attribution 4.0",), ("under a Creative Commons Attribution 4.0",),
        *_under("CC BY 4.0", "a CC BY 4.0", "the CC BY 4.0", "the CC-BY-4.0 license", "a CC-BY-4.0 license"),
    ),
    "cc-by-nc-4.0": (
        ("Creative Commons Attribution-NonCommercial 4.0 International",), ("Creative Commons Attribution NonCommercial 4.0 International",),
        ("Creative Commons Attribution Non-Commercial 4.0 International",),
        ("under the Creative Commons Attribution-NonCommercial 4.0",), ("under a Creative Commons Attribution-NonCommercial 4.0",),
        *_under("CC BY-NC 4.0", "a CC BY-NC 4.0", "the CC BY-NC 4.0", "the CC-BY-NC-4.0 license", "a CC-BY-NC-4.0 license"),
    ),
    "cc-by-sa-4.0": (
        ("Creative Commons Attribution-ShareAlike 4.0 International",), ("Creative Commons Attribution ShareAlike 4.0 International",),
        ("under the Creative Commons Attribution-ShareAlike 4.0",), ("under a Creative Commons Attribution-ShareAlike 4.0",),
        *_under("CC BY-SA 4.0", "a CC BY-SA 4.0", "the CC BY-SA 4.0", "the CC-BY-SA-4.0 license", "a CC-BY-SA-4.0 license"),
    ),
    "cc0-1.0": (
        ("CC0 1.0 Universal Public Domain Dedication",), ("under the CC0 1.0 Universal",), ("under the Creative Commons Zero",),
        *_under("the CC0 license", "the CC0 1.0 license", "CC0 1.0 Universal"),
    ),
    "gpl": (
        ("This program is distributed in the hope that it will be useful but WITHOUT ANY WARRANTY", "See the GNU General Public License for more details"),
        ("You should have received a copy of the GNU General Public License along with this",),
    ),
    "gpl-2.0": (*_gnu("", "2"), ("under the GNU GPL v2",), ("under the GNU GPL version 2",), *_under("the GPL version 2", "the GPLv2 license", "the GPL-2.0 license")),
    "gpl-3.0": (*_gnu("", "3"), ("under the GNU GPL v3",), ("under the GNU GPL version 3",), *_under("the GPL version 3", "the GPLv3 license", "the GPL-3.0 license")),
    "isc": (
        *_under("the ISC license", "an ISC license"),
        ("hereby granted provided that the above copyright notice and this permission notice appear in all copies",),
    ),
    "lgpl-2.1": (*_gnu("Lesser ", "2.1"), ("under the GNU LGPL v2.1",), ("under the GNU LGPL version 2.1",)),
    "lgpl-3.0": (*_gnu("Lesser ", "3"), ("under the GNU LGPL v3",), ("under the GNU LGPL version 3",)),
    "mit": _under("the MIT License", "an MIT License", "a MIT License", "the MIT licence", "an MIT-style license", "the terms of the MIT License", "the Expat License"),
    "mit-text": (
        ("to deal in the Software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense",),
        ("The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software",),
    ),
    "mpl-2.0": (
        ("under the Mozilla Public License Version 2.0",), ("under the Mozilla Public License 2.0",), ("of the Mozilla Public License v 2.0",),
        ("of the Mozilla Public License Version 2.0",), *_under("the MPL 2.0 license", "the MPL-2.0 license"),
        ("If a copy of the MPL was not distributed with this file You can obtain one at",),
    ),
    "unlicense": (
        ("Anyone is free to copy modify publish use compile sell or distribute this software",),
        ("dedicate any and all copyright interest in the software to the public domain",),
        *_under("the Unlicense into the public domain"),
    ),
}


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(TOKEN), F.lit(0))


def _windowed(df: DataFrame) -> DataFrame:
    """``df`` (with ``_w``, the tokens) plus shingle hashes and the window bands of a row."""
    w = F.col("_w")
    at = computed(
        df,
        _h=F.slice(
            F.transform(w, lambda x, i: F.xxhash64(x, *[F.get(w, i + j) for j in range(1, SHINGLE)])),
            1,
            F.greatest(F.size(w) - (SHINGLE - 1), F.lit(0)),
        ),
    )
    h = F.col("_h")
    # Past the end there is no neighbour; least and greatest pass over NULL.
    return computed(
        at,
        _least=F.transform(h, lambda x, i: F.least(x, F.get(h, i + 1))),
        _most=F.transform(h, lambda x, i: F.greatest(x, F.get(h, i + 1))),
    )


def _texts(w: Column) -> Column:
    """The shingles themselves."""
    joined = F.transform(w, lambda x, i: F.concat_ws(" ", x, *[F.get(w, i + j) for j in range(1, SHINGLE)]))
    return F.slice(joined, 1, F.greatest(F.size(w) - (SHINGLE - 1), F.lit(0)))


Notices = Mapping[str, tuple[tuple[str, ...], ...]]


def _all_templates(templates: Mapping[str, str], notices: Notices) -> list[tuple[str, tuple[str, ...]]]:
    """License and parts of each template: by license, the first template before the notices."""
    return [
        (name, parts)
        for name in sorted({*templates, *notices})
        for parts in (*([(templates[name],)] if name in templates else []), *notices.get(name, ()))
    ]


def template_keys(spark: SparkSession, texts: list[str]) -> tuple[dict[str, list[str]], list[int], list[int]]:
    """The distinct shingles of each text, and the bands they can meet, as least and as greatest.

    The hashes come from the same expression as those of ``docs``.
    """
    if sum(len(re.findall(r"\w+", t)) for t in texts) > MAX_TEMPLATE_WORDS:
        raise ValueError(f"license templates have more than {MAX_TEMPLATE_WORDS} words")
    rows = spark.createDataFrame([(t,) for t in texts], "text string")
    found = _windowed(rows.select("text", tokens(F.col("text")).alias("_w"))).select(
        "text", "_h", "_least", "_most", F.array_distinct(_texts(F.col("_w"))).alias("own")
    ).collect()
    low, high = (sorted({k for r in found for k in (*r["_h"], *r[side])}) for side in ("_least", "_most"))
    return {r["text"]: r["own"] for r in found}, low, high


def scan(
    docs: DataFrame, templates: Mapping[str, str] = TEMPLATES, percent: int = PERCENT, notices: Notices | None = None
) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_words, matches``.

    ``matches`` has a struct of ``name, found, shingles, word`` for each license, by
    name: shingles of the template in the text, of how many, and the first one's word.
    The notices are :data:`NOTICES`, or none for templates of one's own.
    """
    if notices is None:
        notices = NOTICES if templates is TEMPLATES else {}
    listed = _all_templates(templates, notices)
    own, low, high = template_keys(docs.sparkSession, sorted({t for _, parts in listed for t in parts}))
    # One literal each, which the optimizer parses once, instead of thousands of expressions.
    longs = lambda values: F.from_json(F.lit(json.dumps(values)), "array<bigint>")
    strings = lambda values: F.from_json(F.lit(json.dumps(values)), "array<string>")
    kind = "array<struct<name:string,parts:array<array<string>>,own:array<string>>>"
    # A text without a shingle is contained nowhere.
    listed = [(name, [own[t] for t in parts]) for name, parts in listed if all(own[t] for t in parts)]
    every = list(dict.fromkeys(x for _, parts in listed for p in parts for x in p))
    known = F.from_json(
        F.lit(json.dumps([
            {"name": name, "parts": parts, "own": list(dict.fromkeys(x for p in parts for x in p))} for name, parts in listed
        ])),
        kind,
    )
    windowed = _windowed(docs.select("doc_id", tokens(F.col("text")).alias("_w")))
    met = computed(windowed, _met=F.arrays_overlap("_least", longs(low)) | F.arrays_overlap("_most", longs(high)))
    shingles = computed(met, _s=F.when(F.col("_met"), _texts(F.col("_w"))).otherwise(strings([])))
    said = computed(shingles, _said=F.when(F.col("_met"), F.array_intersect("_s", strings(every))).otherwise(strings([])))

    def contained(part: Column) -> Column:
        return F.size(F.array_intersect(part, F.col("_said"))) * 100 >= F.size(part) * percent

    def match(t: Column) -> Column:
        found = F.array_intersect(t["own"], F.col("_said"))
        first = F.array_min(F.transform(found, lambda x: F.array_position(F.col("_s"), x))) - 1
        return F.struct(
            t["name"].alias("name"), F.size(found).alias("found"), F.size(t["own"]).alias("shingles"), first.alias("word")
        )

    held = F.filter(known, lambda t: F.forall(t["parts"], lambda p: F.arrays_overlap(p, F.col("_said")) & contained(p)))
    held = computed(said, _held=F.when(F.size("_said") > 0, held).otherwise(F.array().cast(kind)))
    once = F.filter("_held", lambda t, i: (i == 0) | (F.get("_held", i - 1)["name"] != t["name"]))
    return held.select(
        "doc_id",
        F.size("_w").cast("long").alias("n_words"),
        F.transform(once, match).alias("matches"),
    )


def license_report(
    docs: DataFrame, templates: Mapping[str, str] = TEMPLATES, percent: int = PERCENT, notices: Notices | None = None
) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_words, n_licenses, licenses`` (name:found/of@word, by name)."""
    text = F.transform(
        "matches",
        lambda m: F.concat(
            m["name"], F.lit(":"), m["found"].cast("string"), F.lit("/"), m["shingles"].cast("string"),
            F.lit("@"), m["word"].cast("string"),
        ),
    )
    return scan(docs, templates, percent, notices).select(
        "doc_id", "n_words", F.size("matches").cast("long").alias("n_licenses"), F.array_join(text, ",").alias("licenses")
    )
