import math
import os
import random
import re

import pytest
from pyspark.sql import functions as F

from traitlens.llm import license_scan as L
from traitlens.llm import license_texts as T

from llm.edge_rows import edge_docs, empty_docs  # noqa: F401

WORD = r"[^\W_]+(?:[.+-][^\W_]+)*"


@pytest.fixture(scope="module")
def templates(spark):
    return spark.createDataFrame(L.TEMPLATES, "name string, text string")


def test_statements_files_and_inheritance(spark, templates):
    rows = [
        ("a/LICENSE", "Released under the MIT License."), ("a/b/c/x.txt", "Plain words about a river and the stones in it."),
        ("a/b/LICENSE", "This work is licensed under the GNU General Public License, version 3."),
        ("a/y.txt", "Some words here.\nLicensed under the Apache License, Version 2.0. And some more words follow the line "
                    "so that the text is not a licence file at all."),
        ("z.txt", "Plain words."), ("a/q/r.txt", None), ("a/q/s.txt", ""), (None, "Licensed under CC BY-NC 4.0. "
                                                                                 + "filler words " * 30),
        ("a/w.txt", "The public general version of a source is free and under the work."),
    ]
    docs = spark.createDataFrame([(i, p, t, "x") for i, (p, t) in enumerate(rows)],
                                 "doc_id long, place string, text string, name string")
    got = {r.doc_id: r for r in L.scan(docs, templates, F.col("place")).collect()}
    assert [got[i].own_license for i in range(9)] == ["MIT", None, "GPL-3.0", "Apache-2.0", None, None, None,
                                                      "CC-BY-NC-4.0", None]
    assert [got[i].is_license_file for i in (0, 2, 3, 7)] == [True, True, False, False]
    assert (got[1].inherited_license, got[1].inherited_from) == ("GPL-3.0", "a/b")
    assert (got[5].license, got[6].license, got[8].license) == ("MIT", "MIT", "MIT")
    assert got[4].license is None and got[3].license == "Apache-2.0"
    assert L.scan(docs.where("false"), templates, F.col("place")).count() == 0
    assert L.scan(docs, templates.where("false"), F.col("place")).count() == 9


def test_files_headers_and_tags_are_named(spark, templates):
    text = {name: t for name, t in T.WHOLE if "\n" in t and not t.startswith("Permission is")}
    isc = next(t for name, t in T.WHOLE if name == "ISC")
    code = "\n\n" + "\n".join(f"def step{i}(value{i}):\n    return value{i} + offset{i}" for i in range(40))
    gpl = T.GNU_NOTICE.format("General Public License", "3") + "\n\n" + T.GNU_WARRANTY.format("General Public License")
    apache = next(t for name, t in T.HEADERS if name == "Apache-2.0")
    spaced = lambda t: t.replace("\n", "\n\n")
    cases = [
        (spaced(text["MIT"]).replace("(c)", "(c) 2019 Jo Doe and others"), "MIT", True),
        (spaced(text["BSD-2-Clause"]).replace("(c)", "(c) 2021, A Company"), "BSD-2-Clause", True),
        (spaced(text["BSD-3-Clause"]).replace("(c)", "(c) 2021, A Company"), "BSD-3-Clause", True),
        ("ISC License\n\nCopyright (c) 2020 Jo Doe\n\n" + isc, "ISC", True),
        ("# Copyright 2020 Someone\n#\n# " + apache.replace("\n", "\n# ") + code, "Apache-2.0", False),
        ("/* " + apache.replace("\n", " ") + " */" + code, "Apache-2.0", False),
        ("//\n// " + gpl.replace("\n", "\n// ") + code, "GPL-3.0", False),
        (gpl.replace("version 3", "version 2") + code, "GPL-2.0", False),
        (gpl.replace("General Public", "Affero General Public") + code, "AGPL-3.0", False),
        (gpl.replace("General Public", "Lesser General Public") + code, "LGPL-3.0", False),
        ("// SPDX-License-Identifier: Apache-2.0" + code, "Apache-2.0", False),
        ("/* SPDX-License-Identifier: GPL-2.0-only */" + code, "GPL-2.0", False),
        ("# SPDX-License-Identifier: MIT" + code, "MIT", False),
        ("# SPDX-License-Identifier: EPL-2.0" + code, None, False),
        ("# This file is licensed under the Apache\n# License, Version 2.0. More of it is told here." + code, "Apache-2.0", False),
        ("Licensed under the Eclipse Public License, version 2.0." + code, None, False),
        ("Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the "
         "following conditions\nare met:" + code, "BSD", False),
        ("The general public has a license to read about the work of a version." + code, None, False),
    ]
    # plain texts beside them, so that usual words weigh less than rare ones
    plain = [f"The public work of town {i} is free for any use, and the file is in the source. You may not see it all." for i in range(60)]
    docs = spark.createDataFrame([(i, f"d{i}/file", t) for i, t in enumerate([t for t, _, _ in cases] + plain)],
                                 "doc_id long, place string, text string")
    got = {r.doc_id: r for r in L.scan(docs, templates, F.col("place")).collect()}
    assert [(i, got[i].own_license, got[i].is_license_file) for i in range(len(cases))] == \
        [(i, name, whole) for i, (_, name, whole) in enumerate(cases)]
    assert not any(got[i].license for i in range(len(cases), len(got)))


@pytest.mark.skipif(not os.path.exists("/usr/share/common-licenses/GPL-3"), reason="no licence texts on this machine")
def test_whole_files_by_title_and_by_text(spark, templates, tmp_path):
    names = {"GPL-2": "GPL-2.0", "GPL-3": "GPL-3.0", "Apache-2.0": "Apache-2.0", "LGPL-3": "LGPL-3.0", "MPL-2.0": "MPL-2.0"}
    texts = {f: open(f"/usr/share/common-licenses/{f}").read() for f in names}
    for f, name in names.items():
        (tmp_path / f"{name}.txt").write_text(texts[f])
    docs = spark.createDataFrame([(f, f"{f}/COPYING", t) for f, t in texts.items()]
                                 + [("x", "GPL-3/src/x", "words of a file")] + [(f"p{i}", "q/r", f"Plain words {i}.") for i in range(30)],
                                 "doc_id string, place string, text string")
    got = {r.doc_id: r for r in L.scan(docs, templates, F.col("place")).collect()}
    assert {f: got[f].own_license for f in names} == names and got["x"].license == "GPL-3.0"
    whole = L.template_files(spark, str(tmp_path))
    got = {r.doc_id: r for r in L.scan(docs.withColumn("place", F.concat("doc_id", F.lit("/f"))), whole, F.col("place")).collect()}
    assert {f: got[f].own_license for f in names} == names and all(got[f].is_license_file and got[f].score == 1 for f in names)


@pytest.mark.parametrize("cosine", [0.3, 0.75])
def test_scores_equal_dense_cosines(spark, cosine):
    rnd = random.Random(5)
    vocabulary = [f"w{i}" for i in range(14)] + ["license", "3", "GPL-3.0"]
    say = lambda n: " ".join(rnd.choice(vocabulary) for _ in range(n))
    templates = [(name, say(rnd.randint(1, 8))) for name in ("GPL-3.0", "A", "B", "A", "C-2.0")]
    texts = ["".join(say(rnd.randint(0, 9)) + rnd.choice(["\n", "\n\n", ". ", "! ", "\n# \n"]) for _ in range(rnd.randint(1, 6)))
             for _ in range(400)]
    texts += texts[:5] + ["", None]
    known = [t for t in texts if t is not None]
    bag = lambda t: set(re.findall(WORD, t.lower()))
    inside = set().union(*(bag(t) for _, t in templates))
    most = math.log(len(known) + 1) + 1
    df = {w: sum(w in bag(t) for t in known) for w in inside}
    weight = lambda w: math.log((len(known) + 1) / (df[w] + 1)) + 1 if w in inside else most

    def unit_texts(t):
        stop = r"(?<=[.!?])\s+(?![0-9])"
        paragraphs = re.split(r"\n[^\w\n]*\n", t)
        return (re.split(r"\n|" + stop, t) + [s for p in paragraphs for s in re.split(stop, p) if "\n" in s]
                + [p for p in paragraphs if len(re.split(stop, p)) > 1] + ([t] if len(paragraphs) > 1 else []))

    want = {}
    for text in known:
        for place, u in enumerate(unit_texts(text)):
            a, found = bag(u), []
            for name, t in templates:
                b = bag(t)
                version = (re.search(r"\d+(\.\d+)?", name) or [""])[0]
                if {version, re.sub(r"\.0$", "", version), name.lower(), "license"} & b - a or not a & b:
                    continue
                dot = sum(weight(w) ** 2 for w in a & b)
                score = round(dot / math.sqrt(sum(weight(w) ** 2 for w in a) * sum(weight(w) ** 2 for w in b)), 6)
                if score >= cosine:
                    found.append((-round(dot, 6), -score, name))
            if found:
                want[text, place] = (min(found)[2], -min(found)[1])
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    keys = docs.distinct().select(L.text_key(F.col("text")).alias("text_key"), "text")
    out = L.statements(docs, spark.createDataFrame(templates, "name string, text string"), cosine=cosine)
    got = {(r.text, r.place): (r.name, r.score) for r in out.join(keys, "text_key").collect()}
    assert got.keys() == want.keys() and len(want) > 20
    assert all(got[k][0] == want[k][0] and abs(got[k][1] - want[k][1]) < 2e-6 for k in want)


def test_repeated_rows_null_keys_and_long_texts(spark, templates, edge_docs, empty_docs):
    assert L.scan(edge_docs, templates, F.col("path")).count() == edge_docs.count()
    assert L.scan(empty_docs, templates, F.col("path")).count() == 0
    long = "a.b-" * 60_000 + "\n" * 60_000 + "word " * 60_000 + "\nReleased under the MIT License."
    docs = spark.createDataFrame([(1, "x/y", long), (1, "x/y", long), (None, None, None)], "doc_id long, path string, text string")
    assert sorted((r.doc_id or 0, r.license) for r in L.scan(docs, templates, F.col("path")).collect()) == \
        [(0, None), (1, "MIT"), (1, "MIT")]
