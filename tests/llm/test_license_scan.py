import math
import random
import re
from collections import Counter

import pytest

from schoolzones.llm import license_scan
from schoolzones.llm.license_scan import TEMPLATES

CUE = re.compile(license_scan._CUE)
TERM = re.compile(r"[^\W_]+(?:[.-][^\W_]+)*")


def terms(text):
    return TERM.findall(text.lower())


def brute(files):
    """(path, license, origin, directory) and cosines, straight from the definition."""
    said = []
    for k, (path, text) in enumerate(files):
        for part in re.split(r"\n|(?<=[.!?])[ \t]+(?=[A-ZÄÖÜ])", text or ""):
            if CUE.search(part):
                said.append((k, part))
    df = Counter()
    for _, part in said:
        df.update(set(terms(part)))
    for _, text in TEMPLATES:
        df.update(set(terms(text)))
    total = len(said) + len(TEMPLATES)

    def vector(text):
        tf = Counter(terms(text))
        w = {t: n * (math.log((1 + total) / (1 + df[t])) + 1) for t, n in tf.items()}
        length = math.sqrt(sum(x * x for x in w.values()))
        return {t: x / length for t, x in w.items()}

    known = [(name, vector(text)) for name, text in TEMPLATES]
    best = {}
    for k, part in said:
        v = vector(part)
        for name, t in known:
            c = round(sum(x * t.get(w, 0) for w, x in v.items()), 9)
            if c >= 0.7:
                share = len(terms(part)) / len((files[k][1] or "").split())
                low, old = best.get(k, ((0, ""), 0))
                best[k] = (min(low, (-c, name)) if k in best else (-c, name), max(share, old))
    home = {}
    for k, ((c, name), share) in best.items():
        path = files[k][0]
        if path is not None and (share >= 0.5 or re.match(license_scan._FILE_NAME, path.split("/")[-1])):
            d = path.rpartition("/")[0]
            home[d] = min(home.get(d, (path, name, -c)), (path, name, -c))
    out = []
    for k, (path, _) in enumerate(files):
        if k in best:
            out.append((path, best[k][0][1], -best[k][0][0], "own", None))
            continue
        d, found = path.rpartition("/")[0] if path else None, None
        while d is not None:
            if d in home:
                found = (home[d][1], home[d][2], "inherited", d)
                break
            d = d.rpartition("/")[0] if "/" in d else None
        out.append((path, *(found or (None, None, None, None))))
    return out


FILLER = [f"word{i}" for i in range(80)]


def corpus():
    rnd = random.Random(6)
    say = lambda n: " ".join(rnd.choices(FILLER, k=n))
    files = []
    for d in ["", "a", "a/b", "a/b/c", "x", "x/y/z"]:
        for i in range(8):
            text = say(rnd.randint(0, 60))
            if rnd.random() < 0.35:
                name, notice = rnd.choice(TEMPLATES)
                words = notice.split()
                if rnd.random() < 0.5:
                    words[rnd.randrange(len(words))] = rnd.choice(FILLER)
                text += rnd.choice(["\n", ". Then. "]) + " ".join(words) + rnd.choice(["", ".", ". Over. "])
            files.append((f"{d}/f{i}" if d else f"f{i}", text))
    files.append(("a/b/LICENSE", "Some project.\nLicensed under the MIT License.\n" + say(200)))
    files.append(("x/COPYING", "This work is licensed under the GNU General Public License, version 3."))
    files.append(("x/y/notes", "A licence is a thing to think of, in general"))
    files += [(None, "Released under the MIT License."), (None, None), ("x/y/z/w/deep", ""), ("q", None)]
    return files + [files[3]] * 2


def test_equals_brute_force(spark):
    files = corpus()
    df = spark.createDataFrame([(p, t, "k", 1) for p, t in files], "path string, text string, key string, n int")
    got = license_scan.scan(df)
    assert got.columns == ["path", "license", "cosine", "origin", "directory"]
    rows = [(r["path"], r["license"], r["origin"], r["directory"]) for r in got.collect()]
    want = brute(files)
    assert sorted(rows, key=str) == sorted([(p, n, o, d) for p, n, _, o, d in want], key=str)
    cosine = {(r["path"], r["license"]): r["cosine"] for r in got.collect()}
    for path, name, c, _, _ in want:
        assert cosine[path, name] == (c if c is None else pytest.approx(c, abs=1e-6))
    origins = Counter(o for *_, o, _ in want)
    assert origins["own"] > 8 and origins["inherited"] > 8 and origins[None] > 3


def test_every_template_is_found(spark):
    df = spark.createDataFrame([(f"d{i}/f", t) for i, (_, t) in enumerate(TEMPLATES)], "path string, text string")
    got = {r["path"]: r["license"] for r in license_scan.scan(df).collect()}
    assert got == {f"d{i}/f": name for i, (name, _) in enumerate(TEMPLATES)}


def test_empty_table_and_long_text(spark):
    df = spark.createDataFrame([("a/b", "x " * 200_000 + "\nReleased under the MIT License.")], "path string, text string")
    assert license_scan.scan(df.limit(0)).count() == 0
    assert license_scan.scan(df).first()["license"] == "MIT"


def test_no_python_in_the_plan(spark):
    df = spark.createDataFrame([("a/b", "Released under the MIT License.")], "path string, text string")
    assert not re.search("Python|Pandas|Arrow", license_scan.scan(df)._jdf.queryExecution().toString())


WRAPPED = {
    "GPL-3.0": """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.""",
    "BSD-3-Clause": """Copyright (c) 2020, Someone
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are
met:

1. Redistributions of source code must retain the above copyright
   notice, this list of conditions and the following disclaimer.""",
    "MPL-2.0": """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at http://mozilla.org/MPL/2.0/.""",
    "Apache-2.0": """Copyright 2020 Someone

Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.""",
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:""",
}
WRAPPED["GPL-2.0"] = WRAPPED["GPL-3.0"].replace("software:", "software;").replace("version 3", "version 2")


@pytest.mark.parametrize("copies", [1, 40])
def test_wrapped_headers(spark, copies):
    rows = []
    for name, text in WRAPPED.items():
        hashed = "\n".join(("# " + line).rstrip() for line in text.split("\n"))
        starred = "/*\n" + "\n".join((" * " + line).rstrip() for line in text.split("\n")) + "\n */"
        for k, t in enumerate([text, hashed, starred, text.replace("\n", "\r\n")]):
            for c in range(copies):
                rows.append((f"{name}/{k}-{c}/f", t + "\n\ncode = 1\n" + "word%d " % c * 200))
    df = spark.createDataFrame(rows, "path string, text string")
    got = {r["path"]: (r["license"], r["origin"]) for r in license_scan.scan(df).collect()}
    assert {p: x for p, x in got.items() if x != (p.split("/")[0], "own")} == {}
