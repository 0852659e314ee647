"""Licence scan: sparse TF-IDF cosine of notices to templates, then inheritance along paths. Spark's functions only.

Every sentence or line of a whole file that speaks of licensing is a notice. Equal notices are merged first, whatever
their number, and weighted by it in the document frequencies, which cover all notices of all files and the templates.
Notices broken into lines are put together again: the lines of a block (between blank lines), without comment marks,
are joined, and the block and its sentences are compared to the templates and to whole headers, opening paragraphs and
titles of licence texts as well. They are weighted with the same frequencies and don't change them. A block of several
lines that is close to a whole header decides over the file's single lines, which may be fragments of it.

A notice gets the template of the highest cosine (ties: the lesser licence id) if that is at least ``MIN_COSINE``; a file
gets the best of its notices. A file that consists mostly of a notice, or is named like a licence file, is the licence of
its directory; files without a notice take that of the nearest directory above them that has one (of several licence
files in one directory, the least path).

The templates are a fixed short list, so that side of the cosine join is small whatever the corpus holds.

Null and empty texts have no notice but can inherit; a null path has no directory. Rows are scanned by path and text;
repeated rows give repeated results. Only the named columns are read. Empty tables give empty results.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .native import row_key
from .store import stored
from .text import GAP

#: Licence ids and the notices they are known by.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("Apache-2.0", "you may not use this file except in compliance with the License"),
    ("MIT", "Released under the MIT License"),
    ("MIT", "Licensed under the MIT License"),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License"),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License, either version 3 of the License, or any later version"),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License, version 2"),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3"),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0 Universal"),
    ("Unlicense", "This is free and unencumbered software released into the public domain"),
    ("LicenseRef-Proprietary", "All rights reserved"),
    ("LicenseRef-Proprietary", "Proprietary and confidential. Unauthorized copying of this file is strictly prohibited"),
]
#: Whole headers, opening paragraphs and titles, to which only blocks of several lines are compared.
_GPL = (
    "This program is free software{} you can redistribute it and/or modify it under the terms of the GNU {}General Public License "
    "as published by the Free Software Foundation, either version {} of the License, or (at your option) any later version."
)
HEADERS = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("Apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("GPL-3.0", _GPL.format(":", "", 3)),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("GPL-2.0", _GPL.format(";", "", 2)),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("LGPL-3.0", _GPL.format(":", "Lesser ", 3)),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("AGPL-3.0", _GPL.format(":", "Affero ", 3)),
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
]
_CUE = r"(?i)licen[sc]|copyright|spdx|redistribut|public domain|rights reserved|permission is hereby|creative commons|free software|strictly prohibited"
_SENTENCE = r"\n|(?<=[.!?])[ \t]+(?=\p{Lu})"
_MARKS = r"""(?m)^[ \t]*(?:(?://+!?|/\*+!?|\*+/|\*+(?!/)|#+|;+|--+|%+|<!--+|\"{3}|'{3}|(?:dnl|REM|rem)(?=[ \t]|$))[ \t]*)+|[ \t]*(?:\*+/|--+>|\"{3}|'{3})?[ \t\r]*$"""
_TERM = r"[\p{L}\p{N}]+(?:[.-][\p{L}\p{N}]+)*"
_FILE_NAME = r"(?i)^(licen[sc]e|copying|unlicense|notice)([.-].*)?$"
MIN_COSINE = 0.7


def _terms(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(_TERM), F.lit(0))


def _weights(vectors: DataFrame, idf: DataFrame, unseen: float = 0.0) -> DataFrame:
    """(id, term, tf) -> (id, term, w) of unit length; ``unseen``: the weight of terms that have none."""
    w = vectors.join(idf, "term", "left").select("id", "term", (F.col("tf") * F.coalesce("idf", F.lit(unseen))).alias("w"))
    length = w.groupBy("id").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("length"))
    return w.join(length, "id").select("id", "term", (F.col("w") / F.col("length")).alias("w"))


def _frequencies(rows: DataFrame) -> DataFrame:
    """(id, text, n) -> (id, n, term, tf)."""
    return rows.select("id", "n", F.explode(_terms(F.col("text"))).alias("term")).groupBy("id", "n", "term").agg(
        F.count("*").alias("tf")
    )


def joined(text: Column) -> Column:
    """The blocks of several lines of a text, each as one line, and their sentences, as far as they speak of licensing."""
    blocks = F.split(F.regexp_replace(text, _MARKS, ""), r"\n(?:[ \t]*\n)+")
    blocks = F.filter(F.transform(blocks, lambda b: F.trim(F.regexp_replace(b, r"^\n+|\n+$", ""))), lambda b: b.contains("\n"))
    blocks = F.filter(F.transform(blocks, lambda b: F.regexp_replace(b, r"\s*\n\s*", " ")), lambda b: b.rlike(_CUE))
    sentences = F.flatten(F.transform(blocks, lambda b: F.split(b, _SENTENCE)))
    return F.array_distinct(F.concat(blocks, F.filter(sentences, lambda s: s.rlike(_CUE))))


def _table(spark: SparkSession, templates: list[tuple[str, str]], mark: str) -> DataFrame:
    """(id, license, text, n) of templates."""
    rows = [(f"{mark}{i}", x, t, 1) for i, (x, t) in enumerate(templates)]
    return spark.createDataFrame(rows, "id string, license string, text string, n long")


def _best(a: DataFrame, b: DataFrame, templates: DataFrame) -> DataFrame:
    """Unit vectors (id, term, w) of texts and templates -> (id, license, cosine) of the closest one, if close enough."""
    cosine = F.round(F.sum(F.col("w") * F.col("v")), 9)
    return (
        a.join(b.select(F.col("id").alias("template"), "term", F.col("w").alias("v")), "term")
        .groupBy("id", "template")
        .agg(cosine.alias("cosine"))
        .where(F.col("cosine") >= MIN_COSINE)
        .join(templates.select(F.col("id").alias("template"), "license"), "template")
        .groupBy("id")
        .agg(F.min(F.struct((-F.col("cosine")).alias("less"), "license")).alias("best"))
        .select("id", "best.license", (-F.col("best.less")).alias("cosine"))
    )


def score_notices(notices: DataFrame, blocks: DataFrame, spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    """``notices`` (text, n) and ``blocks`` (id, text), different texts -> (text, license, cosine) and (id, license,
    cosine, header) of those close to a template; ``header``: that is a whole one.
    """
    templates = _table(spark, TEMPLATES, "#")
    rows = stored(notices.select(F.sha2("text", 256).alias("id"), "text", "n"), "notices")
    found = stored(_frequencies(rows), "terms")
    known = _frequencies(templates)
    total = (rows.agg(F.sum("n")).first()[0] or 0) + len(TEMPLATES)
    idf = (
        found.select("term", "n")
        .union(known.select("term", "n"))
        .groupBy("term")
        .agg((F.log((1 + F.lit(total)) / (1 + F.sum("n"))) + 1).alias("idf"))
    )
    idf = stored(idf, "idf")
    short = _weights(known, idf)
    best = _best(_weights(found, idf), short, templates)
    unseen = math.log(1 + total) + 1
    headers = _table(spark, HEADERS, "##")
    long = _weights(_frequencies(headers), idf, unseen)
    whole = stored(_weights(_frequencies(blocks.withColumn("n", F.lit(1))), idf, unseen), "blocks")
    near = _best(whole, short, templates).withColumn("header", F.lit(False))
    near = near.union(_best(whole, long, headers).withColumn("header", F.lit(True)))
    return best.join(rows, "id").select("text", "license", "cosine"), near


def scan(files: DataFrame, path: str = "path", text: str = "text") -> DataFrame:
    """(path, license, cosine, origin, directory) of every row; origin is 'own', 'inherited' or null.

    ``directory``: where an inherited licence comes from.
    """
    spark = files.sparkSession
    files = files.select(F.col(path).alias("path"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    key = row_key(F.col("path"), F.col("text")).alias("key")
    parts = F.filter(F.split("text", _SENTENCE), lambda s: s.rlike(_CUE))
    said = stored(
        files.where(F.col("text").rlike(_CUE))
        .select("path", key, F.size(F.split(F.trim("text"), GAP)).alias("n_words"), F.explode(parts).alias("notice")),
        "said",
    )
    several = stored(
        files.where(F.col("text").rlike(_CUE) & F.col("text").contains("\n"))
        .select("path", key, F.size(F.split(F.trim("text"), GAP)).alias("n_words"), F.explode(joined(F.col("text"))).alias("block"))
        .select("path", "key", "n_words", "block", F.sha2("block", 256).alias("id")),
        "several",
    )
    notices = said.groupBy(F.col("notice").alias("text")).agg(F.count("*").alias("n"))
    blocks = several.groupBy("id").agg(F.first("block").alias("text"))
    lines, near = score_notices(notices, blocks, spark)
    scored, near = stored(lines, "scored"), stored(near, "near")
    share = lambda text: (F.size(_terms(F.col(text))) / F.col("n_words")).alias("share")
    of = ("path", "key", "license", "cosine")
    own = (
        said.join(scored.withColumnRenamed("text", "notice"), "notice")
        .select(*of, share("notice"), F.lit(False).alias("header"))
        .union(several.join(near, "id").select(*of, share("block"), "header"))
        .groupBy("path", "key")
        .agg(
            F.min(F.struct((~F.col("header")).alias("line"), (-F.col("cosine")).alias("less"), "license")).alias("best"),
            F.max("share").alias("share"),
        )
        .select("path", "key", "best.license", (-F.col("best.less")).alias("cosine"), "share")
    )
    own = stored(own, "own")
    name = F.element_at(F.split("path", "/"), -1)
    directory = F.regexp_replace("path", "/?[^/]*$", "")
    licences = (
        own.where("path is not null")
        .where((F.col("share") >= 0.5) | name.rlike(_FILE_NAME))
        .groupBy(directory.alias("directory"))
        .agg(F.min(F.struct("path", "license", "cosine")).alias("of"))
        .select("directory", F.col("of.license").alias("license2"), F.col("of.cosine").alias("cosine2"))
    )
    licences = stored(licences, "directories")
    marked = files.select("path", key).join(own.drop("path", "share"), "key", "left")
    steps = F.split(directory, "/")
    above = F.transform(
        F.sequence(F.lit(1), F.size(steps)), lambda i: F.array_join(F.slice(steps, 1, i), "/")
    )
    # A directory is looked up once, however many files it has.
    need = marked.where("license is null and path is not null").select(directory.alias("home"), above.alias("above"))
    home = (
        need.distinct()
        .select("home", F.posexplode("above").alias("depth", "directory"))
        .join(licences, "directory")
        .groupBy("home")
        .agg(F.max_by(F.struct("license2", "cosine2", "directory"), "depth").alias("from"))
    )
    return marked.join(home, directory == F.col("home"), "left").select(
        "path",
        F.coalesce("license", "from.license2").alias("license"),
        F.when(F.col("license").isNotNull(), F.col("cosine")).otherwise(F.col("from.cosine2")).alias("cosine"),
        F.when(F.col("license").isNotNull(), "own").when(F.col("from").isNotNull(), "inherited").alias("origin"),
        F.when(F.col("license").isNull(), F.col("from.directory")).alias("directory"),
    )
