"""Licence scan: sparse TF-IDF cosine to templates, then inheritance from the nearest directory.

All of it is DataFrame functions. The texts that name a licence at all are cut into units: each line,
each paragraph (a header of several lines) and the whole text (a licence file). Only these units are
compared with the templates, as sparse vectors: a row for each unit and term, joined with the weights
of the templates' terms. The templates are notices and openings, and for whole texts also the licences
in full. A file without a licence of its own takes that of the nearest directory above
it that has a licence file, by joins of paths.
"""

import math
import re
from collections import Counter

from pyspark.sql import functions as F

from edgeflow.llm.licence_terms import WHOLE
from edgeflow.plans import keep

#: Cosines from which a line or paragraph is a notice, and a whole text a licence file.
NOTICE, FILE = 0.75, 0.5
#: Cosine with a licence in full from which a whole text is a licence file; long English texts come up to 0.6.
FULL = 0.8
#: Decimal places of a cosine.
PLACES = 6

# fixed values: notices and openings of public licences
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in'
     " compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"
     " Unless required by applicable law or agreed to in writing, software distributed under the License is distributed"
     ' on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for'
     " the specific language governing permissions and limitations under the License."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
     ' documentation files (the "Software"), to deal in the Software without restriction, including without limitation the'
     " rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to"
     " permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright"
     " notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General"
     " Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option)"
     " any later version."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General"
     " Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option)"
     " any later version."),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser"
     " General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your"
     " option) any later version."),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero"
     " General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your"
     " option) any later version."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted"
     " provided that the following conditions are met: Redistributions of source code must retain the above copyright"
     " notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the"
     " above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other"
     " materials provided with the distribution. Neither the name of the copyright holder nor the names of its contributors"
     " may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted"
     " provided that the following conditions are met: Redistributions of source code must retain the above copyright"
     " notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the"
     " above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other"
     " materials provided with the distribution."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby"
     " granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL"
     " was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify,"
     " publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for"
     " any purpose, commercial or non-commercial, and by any means."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to"
     " this work. CC0 1.0 Universal Public Domain Dedication."),
]
# fixed value: the licence that has nearly the words of another in full, and is told from it by the notice in its appendix
LIKE, TWIN = "GPL-3.0", "AGPL-3.0"
#: Texts without any of these words hold no licence.
NAMED = r"(?i)licen[cs]|copyright|permission|redistribut|public domain|free software"
TERM = "[a-z0-9]+(?:[.][0-9]+)*"


def weights():
    """(idf by term, idf of any other term, [(licence, weight by term)]) of the templates; the weights have length one."""
    counted = [(licence, Counter(re.findall(TERM, text.lower()))) for licence, text in TEMPLATES]
    df = Counter(term for _, counts in counted for term in counts)
    idf = {term: math.log((1 + len(counted)) / (1 + n)) + 1 for term, n in df.items()}
    vectors = []
    for licence, counts in counted:
        vector = {term: n * idf[term] for term, n in counts.items()}
        norm = math.sqrt(sum(w * w for w in vector.values()))
        vectors.append((licence, {term: w / norm for term, w in vector.items()}))
    return idf, math.log(1 + len(counted)) + 1, vectors


def full_weights(idf, other):
    """[(licence, weight by term)] of the licences in full, of length one, by the `idf` of the other templates."""
    counted = []
    for licence, text in WHOLE.items():
        words = text.split()
        counted.append((licence, Counter(dict(zip(words[::2], map(int, words[1::2]))))))
    vectors = []
    for licence, counts in counted:
        vector = {term: n * idf.get(term, other) for term, n in counts.items()}
        norm = math.sqrt(sum(w * w for w in vector.values()))
        vectors.append((licence, {term: w / norm for term, w in vector.items()}))
    return vectors


def _terms(text):
    return F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0))


def units(files, id, path, text):
    """(row, id, path, units) of every file, written once; `units` holds (whole, terms) of texts that name a licence."""
    given = F.coalesce(F.col(text).cast("string"), F.lit(""))
    named = F.array_union(F.split(given, "\n"), F.split(given, r"\n[ \t\r]*\n"))
    parts = F.transform(
        F.filter(named, lambda part: part.rlike(NAMED)),
        lambda part: F.struct(F.lit(False).alias("whole"), _terms(part).alias("terms")),
    )
    whole = F.array(F.struct(F.lit(True).alias("whole"), _terms(given).alias("terms")))
    found = F.when(given.rlike(NAMED), F.concat(whole, parts))
    rows = files.select(
        F.monotonically_increasing_id().alias("row"), F.col(id).alias("id"), F.col(path).cast("string").alias("path"),
        found.alias("units"),
    )
    return keep(rows, "licences-units")


def cosines(written):
    """(row, whole, score, licence, full_score, full_licence): the best notice of each unit, and the best full licence of whole texts."""
    spark = written.sparkSession
    idf, other, vectors = weights()
    full = full_weights(idf, other)
    terms = sorted(idf.keys() | {term for _, vector in full for term in vector})
    table = spark.createDataFrame(
        [
            (term, idf.get(term, other), *([vector.get(term, 0.0) for _, vector in some] for some in (vectors, full)))
            for term in terms
        ],
        "term string, idf double, w array<double>, f array<double>",
    )
    unit = written.where("units IS NOT NULL").select("row", F.posexplode("units").alias("unit", "u"))
    counted = (
        unit.select("row", "unit", "u.whole", F.explode("u.terms").alias("term"))
        .groupBy("row", "unit", "whole", "term").agg(F.count(F.lit(1)).alias("n"))
    )
    # the terms of the templates, whatever the files
    met = counted.join(F.broadcast(table), "term", "left")
    value = F.col("n") * F.coalesce("idf", F.lit(other))

    def sums(column, of, value):
        return [F.sum(F.coalesce(value * F.get(column, F.lit(k)), F.lit(0.0))).alias(f"{column}{k}") for k in range(len(of))]

    def best(column, of):
        return F.array_max(F.array(*[
            F.struct(F.round(F.col(f"{column}{k}") / F.sqrt("square"), PLACES).alias("score"), F.lit(licence).alias("licence"))
            for k, (licence, _) in enumerate(of)
        ]))

    dots = met.groupBy("row", "unit", "whole").agg(
        F.sum(value * value).alias("square"), *sums("w", vectors, value), *sums("f", full, F.when(F.col("whole"), value))
    )
    found = dots.select("row", "whole", best("w", vectors).alias("best"), best("f", full).alias("full"))
    return found.select(
        "row", "whole", "best.*", F.col("full.score").alias("full_score"), F.col("full.licence").alias("full_licence")
    )


def directory(path):
    """The directory of a path, '' at the top."""
    return F.regexp_replace(path, "/?[^/]*$", "")


def _above(folder):
    """A directory and all above it, the nearest first."""
    parts = F.split(folder, "/")
    return F.transform(
        F.sequence(F.size(parts), F.lit(0), F.lit(-1)), lambda n: F.array_join(F.slice(parts, 1, n), "/")
    )


def scan(files, id="doc_id", path="path", text="text", notice=NOTICE, file=FILE, full=FULL):
    """(id, path, licence, score, origin, origin_path) of every row of `files`.

    `origin` is `file` for a licence file (the cosine of the whole text reaches `full` with a licence in
    full, or `file` with a notice or opening), `notice` for a line or paragraph that reaches `notice`, `inherited` from the licence file `origin_path` in the
    nearest directory above, or `none`. A text like LIKE in full whose best notice is of TWIN is TWIN. The best cosine counts; a tie takes the last name. Of several
    licence files in a directory the best counts, then the last name and path. Null and empty texts
    have no licence of their own; a null path inherits nothing. Other columns are not read.
    """
    written = units(files, id, path, text)
    best = cosines(written)
    struct = F.struct("score", "licence")
    in_full = F.struct(F.col("full_score").alias("score"), F.col("full_licence").alias("licence"))
    own = best.groupBy("row").agg(
        F.max(F.when(F.col("whole") & (F.col("score") >= file), struct)).alias("short"),
        F.max(F.when(F.col("whole") & (F.col("full_score") >= full), in_full)).alias("in_full"),
        F.max(F.when(~F.col("whole") & (F.col("score") >= notice), struct)).alias("as_notice"),
    )
    twin = (F.col("in_full.licence") == LIKE) & (F.col("as_notice.licence") == TWIN)
    named = F.struct(F.col("in_full.score").alias("score"), F.lit(TWIN).alias("licence"))
    own = own.select("row", F.greatest("short", F.when(twin, named).otherwise(F.col("in_full"))).alias("as_file"), "as_notice")
    rows = keep(
        written.select("row", "id", "path", directory(F.col("path")).alias("folder")).join(own, "row", "left"),
        "licences-own",
    )
    licensed = (
        rows.where("as_file IS NOT NULL AND path IS NOT NULL").groupBy("folder")
        .agg(F.max(F.struct("as_file.score", "as_file.licence", "path")).alias("of"))
    )
    # every directory once, however many files it has
    folders = rows.where("as_file IS NULL AND as_notice IS NULL AND path IS NOT NULL").select("folder").distinct()
    nearest = (
        folders.select("folder", F.posexplode(_above(F.col("folder"))).alias("away", "above"))
        .join(licensed.select(F.col("folder").alias("above"), "of"), "above")
        .groupBy("folder").agg(F.min_by("of", "away").alias("from"))
    )
    met = rows.join(nearest, "folder", "left")
    mine = F.coalesce("as_file", "as_notice")
    return met.select(
        F.col("id").alias(id), "path",
        F.coalesce(mine["licence"], F.col("from.licence")).alias("licence"),
        F.coalesce(mine["score"], F.col("from.score")).alias("score"),
        F.when(F.col("as_file").isNotNull(), "file").when(F.col("as_notice").isNotNull(), "notice")
        .when(F.col("from").isNotNull(), "inherited").otherwise("none").alias("origin"),
        F.when(mine.isNull(), F.col("from.path")).alias("origin_path"),
    )
