"""License notices in documents: MinHash bands retrieve templates, exact shingle containment verifies; DataFrame
functions only.

A text's 5-word shingles are cut into overlapping windows, for each size of template (up to 1, 2, 4, .. shingles) windows
of twice that size at a distance of once that size, so that every occurrence lies whole in one window. A window
and a template that it contains to ``CONTAINMENT`` have a Jaccard similarity of at least ``J = c m / (w + m - c m)`` (m
shingles of the template, w of the window, c the containment; at worst 0.19). With bands of one row each they
share one of ``BANDS`` minima with a probability of ``1 - (1 - J) ** BANDS``, over 0.999998.

Two exact filters come first, as minima are equal only where a shingle is shared: texts that hold no word of a set
that meets every shingle of every template are passed over unsplit, and windows without any shingle of a template are
not hashed.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.binding import let
from .common import row_key

SHINGLE = 5
CONTAINMENT = 0.8
BANDS = 64
MAX_TEMPLATES = 1_000       # the broadcast library is bounded by this and by the length of a notice
_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_GNU = ("This {what} is free software{mark} you can redistribute it and/or modify it under the terms of the GNU {kind} as published by "
        "the Free Software Foundation{mark2} either version {v} of the License, or (at your option) any later version.")
_GNU_ONE = "This work is licensed under the GNU {kind}, version {v}."
_CC_ONE = "This work is licensed under a Creative Commons {terms} {v} {reach} License."
_GPL, _LGPL, _AGPL = "General Public License", "Lesser General Public License", "Affero General Public License"

# Notices and opening terms as licenses word them, by license.
TEMPLATES = (
    ("MIT-notice", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
            "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
            "copies of the Software"),
    ("MIT-warranty", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of "
                     "the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT "
                     "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
            "provided that the above copyright notice and this permission notice appear in all copies."),
    ("0BSD", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted. "
             "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE"),
    ("Apache-2.0-notice", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except "
                   "in compliance with the License. You may obtain a copy of the License at"),
    ("Apache-1.1", "This product includes software developed by the Apache Software Foundation (http://www.apache.org/). Alternately, this "
                   "acknowledgment may appear in the software itself, if and wherever such third-party acknowledgments normally appear."),
    *((f"{name}-notice", _GNU_ONE.format(kind=kind, v=v)) for name, kind, v in (
        ("GPL-1.0", _GPL, "1"), ("GPL-2.0", _GPL, "2"), ("GPL-3.0", _GPL, "3"), ("LGPL-2.1", _LGPL, "2.1"), ("LGPL-3.0", _LGPL, "3"),
        ("AGPL-3.0", _AGPL, "3"))),
    *((name, _GNU.format(what=what, kind=kind, v=v, mark=m, mark2=m2)) for name, what, kind, v, m, m2 in (
        ("GPL-1.0", "program", _GPL, "1", ";", ";"), ("GPL-2.0", "program", _GPL, "2", ";", ";"), ("GPL-3.0", "program", _GPL, "3", ":", ","),
        ("LGPL-2.0", "library", "Library General Public License", "2", ";", ";"), ("LGPL-2.1", "library", _LGPL, "2.1", ";", ";"),
        ("LGPL-3.0", "program", _LGPL, "3", ":", ","), ("AGPL-3.0", "program", _AGPL, "3", ":", ","))),
    ("GPL-2.0-body", "The licenses for most software are designed to take away your freedom to share and change it. By contrast, the GNU "
                     "General Public License is intended to guarantee your freedom to share and change free software--to make sure the "
                     "software is free for all its users."),
    ("GPL-3.0-body", "The GNU General Public License is a free, copyleft license for software and other kinds of works. The licenses for "
                     "most software and other practical works are designed to take away your freedom to share and change the works."),
    ("AGPL-3.0-body", "The GNU Affero General Public License is a free, copyleft license for software and other kinds of works, "
                      "specifically designed to ensure cooperation with the community in the case of network server software."),
    ("LGPL-3.0-body", "This version of the GNU Lesser General Public License incorporates the terms and conditions of version 3 of the GNU "
                      "General Public License, supplemented by the additional permissions listed below."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted "
                     "provided that the following conditions are met"),
    ("BSD-3-Clause-endorsement", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
                                 "promote products derived from this software without specific prior written permission."),
    ("BSD-4-Clause-advertising", "All advertising materials mentioning features or use of this software must display the following "
                                 "acknowledgement: This product includes software developed by"),
    ("MPL-1.1", "The contents of this file are subject to the Mozilla Public License Version 1.1 (the \"License\"); you may not use this "
                "file except in compliance with the License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
                "distributed with this file, You can obtain one at"),
    ("EPL-1.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0 which "
                "accompanies this distribution, and is available at"),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which "
                "is available at"),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for "
             "any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose"),
    ("BSL-1.0", "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and "
                "accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, "
                "and transmit the Software"),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, "
                  "compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose"),
    ("WTFPL", "Everyone is permitted to copy and distribute verbatim or modified copies of this license document, and changing it is "
              "allowed as long as the name is changed."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("CC0-1.0-body", "The person who associated a work with this deed has dedicated the work to the public domain by waiving all of his or "
                     "her rights to the work worldwide under copyright law"),
    ("CC-BY-NC-4.0-notice", "Licensed under CC BY-NC 4.0."),
    *((f"CC-{code}-{v}-notice", _CC_ONE.format(terms=terms, v=v, reach="International" if v == "4.0" else "Unported"))
      for v in ("4.0", "3.0") for code, terms in (
        ("BY", "Attribution"), ("BY-SA", "Attribution-ShareAlike"), ("BY-ND", "Attribution-NoDerivatives"),
        ("BY-NC", "Attribution-NonCommercial"), ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
        ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives")) if not (code == "BY-NC" and v == "4.0")),
    ("CC-BY-NC-4.0-text", _CC_ONE.format(terms="Attribution-NonCommercial", v="4.0", reach="International")),
)


def template_shingles(text: str) -> list[str]:
    words = re.findall(_WORD, text.translate(str.maketrans(_UPPER, _LOWER)))
    return list(dict.fromkeys(" ".join(words[i:i + SHINGLE]) for i in range(len(words) - SHINGLE + 1)))


def size_class(m: int) -> int:
    """The least c for which a template of m shingles is no longer than ``2 ** c``."""
    return (m - 1).bit_length()


def meeting_words(shingles: set[str], least: int = 6) -> tuple[list[str], list[str]]:
    """Words of which the shingles have at least one each, again and again the word that the most shingles left
    have; and the shingles of shorter words than ``least`` only, which are to be looked for as they are."""
    left, chosen = {s for s in shingles if max(map(len, s.split())) >= least}, []
    alone = sorted(shingles - left)
    while left:
        count: dict[str, int] = {}
        for s in left:
            for w in set(s.split()):
                if len(w) >= least:
                    count[w] = count.get(w, 0) + 1
        word = max(sorted(count), key=lambda w: (count[w], len(w)))
        chosen.append(word)
        left = {s for s in left if word not in s.split()}
    return chosen, alone


def _minima(shingles: Column) -> Column:
    return F.transform(F.sequence(F.lit(1), F.lit(BANDS)),
                       lambda band: F.array_min(F.transform(shingles, lambda s: F.xxhash64(band, s))))


def library(spark: SparkSession, templates=TEMPLATES) -> DataFrame:
    """``(license, class, wanted, bands)`` of the templates that have a shingle."""
    if len(templates) > MAX_TEMPLATES:
        raise ValueError(f"more than {MAX_TEMPLATES} templates")
    rows = [(name, size_class(len(sh)), sh) for name, text in templates if (sh := template_shingles(text))]
    made = spark.range(1).select(F.inline(F.array(*[F.struct(
        F.lit(n).alias("license"), F.lit(c).alias("class"), F.array(*map(F.lit, sh)).alias("wanted"))
        for n, c, sh in rows])))
    return made.withColumn("bands", _minima(F.col("wanted")))


def license_matches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates=TEMPLATES,
                    containment: float = CONTAINMENT) -> DataFrame:
    """``(doc_id, license, containment, n_windows, first_window)`` for every template that a document contains.

    ``containment`` is the largest of a window, ``n_windows`` counts those that reach the threshold, ``first_window`` is
    the index of the first one's first word. Licenses of one family share most of their words: a match is left out where a
    template of higher containment in an overlapping window accounts for so many of its shingles that the rest alone would not
    reach the threshold. So versions and variants are told apart, and two notices side by side are both told. Null, empty and short texts match nothing; a long text is split
    whole. Rows equal in id and text give the rows of one document; another text under the same or a null id is a
    document of its own. Templates of fewer than five words have no shingle and match nothing.
    """
    lists = {name: template_shingles(text) for name, text in templates}
    known = sorted({s for sh in lists.values() for s in sh})
    classes = sorted({size_class(len(sh)) for sh in lists.values() if sh})
    needles, alone = meeting_words(set(known))

    def promising(lower: Column) -> Column:
        found = lower.rlike("|".join(_GAP.join(s.split()) for s in alone)) if alone else F.lit(False)
        for w in needles:
            found = F.contains(lower, F.lit(w)) | found
        return found

    def shingles(words: Column) -> Column:
        return F.when(F.size(words) >= SHINGLE, F.transform(
            F.sequence(F.lit(0), F.size(words) - SHINGLE),
            lambda i: F.array_join(F.slice(words, i + 1, SHINGLE), " ")))

    def cut(sh: Column) -> Column:
        """Windows k of class c begin at k * 2 ** c and are 2 ** (c + 1) long: a shingle is in two of them."""
        at = F.filter(F.transform(sh, lambda s, i: F.when(s.isin(known), i)), lambda i: i.isNotNull())
        wins = F.array_distinct(F.flatten(F.transform(at, lambda i: F.array(*[
            F.struct(F.lit(c).alias("class"), F.shiftleft(F.shiftright(i, c) - d, c).alias("start"))
            for c in classes for d in (0, 1)]))))
        return F.transform(F.filter(wins, lambda w: w["start"] >= 0), lambda w: F.struct(
            w["class"].alias("class"), w["start"].alias("start"), F.array_distinct(F.slice(
                sh, w["start"] + 1, F.call_function("shiftleft", F.lit(2), w["class"]))).alias("win")))

    # each step is bound by let, and the generators are outer ones: else filters made from them repeat the work
    words = F.regexp_extract_all(F.translate(F.col(text_col), _UPPER, _LOWER), F.lit(_WORD), F.lit(0))
    windows = docs.where(let(F.lower(F.col(text_col)), promising)).select(
        F.col(id_col).alias("doc_id"), row_key(id_col, text_col).alias("key"),
        F.inline_outer(let(let(words, shingles), cut))).where(F.col("win").isNotNull())
    banded = windows.select("doc_id", "key", "class", "start", "win", F.posexplode_outer(_minima(F.col("win"))).alias(
        "band", "low"))
    lib = F.broadcast(library(docs.sparkSession, templates).select(
        "license", "class", "wanted", F.posexplode("bands").alias("band", "low")))
    met = banded.join(lib, ["class", "band", "low"]).dropDuplicates(["doc_id", "key", "license", "class", "start"])
    hits = met.withColumn("hits", F.array_intersect("win", "wanted")).withColumn(
        "share", F.size("hits") / F.size("wanted")).where(F.col("share") >= containment)
    found = hits.groupBy("doc_id", "key").agg(F.collect_list(F.struct(
        "license", "class", "start", "share", "hits", "wanted")).alias("all"))

    def ends(m: Column) -> Column:
        return m["start"] + F.call_function("shiftleft", F.lit(2), m["class"])

    def explained(m: Column, by: Column) -> Column:
        return ((by["share"] > m["share"]) & (by["start"] < ends(m)) & (m["start"] < ends(by))
                & (F.size(F.array_except(m["hits"], by["wanted"])) / F.size(m["wanted"]) < containment))

    own = F.filter("all", lambda m: ~F.exists("all", lambda by: explained(m, by)))
    per_window = found.select("doc_id", "key", F.inline(F.transform(own, lambda m: F.struct(
        m["license"].alias("license"), m["start"].alias("start"), m["share"].alias("share")))))
    return per_window.groupBy("doc_id", "key", "license").agg(
        F.max("share").alias("containment"), F.count_distinct("start").alias("n_windows"),
        F.min("start").cast("long").alias("first_window")).drop("key")
