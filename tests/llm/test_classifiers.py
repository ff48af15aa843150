import random
import zlib

import pytest
from pyspark.sql import functions as F

from changeloom.llm import licenses, quality, toxicity
from changeloom.llm.common import fold_of

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


def held_out_error(scored, labels, label: str) -> float:
    rows = scored.join(labels, "doc_id").filter("held_out")
    wrong, total = rows.agg(F.sum((F.col("predicted") != F.col(label)).cast("int")), F.count("*")).head()
    assert total > 500
    return wrong / total


def test_quality_on_rows_held_out(tables):
    scored = quality.quality(*tables)
    assert scored.filter("score IS NULL OR score < 0 OR score > 1").count() == 0
    assert held_out_error(scored, tables[1], "quality") < 0.01


def test_toxicity_on_rows_held_out(tables):
    assert held_out_error(toxicity.toxicity(*tables), tables[1], "toxic") < 0.03


def test_folds_go_by_the_crc_of_the_id(spark):
    rows = spark.createDataFrame([(k,) for k in (-5, 0, 7, 123456789012)] + [(None,)], "doc_id long")
    got = {r[0]: r[1] for r in rows.select("doc_id", fold_of("doc_id", 5)).collect()}
    assert got == {k: zlib.crc32(str(k).encode() if k is not None else b"") % 5 for k in got}


def test_labels_of_the_held_out_fold_are_not_read(spark, tables):
    docs, labels = (t.filter("doc_id < 1500") for t in tables)
    for module, column, folds, held in ((quality, "quality", 5, 0), (toxicity, "toxic", 3, 1)):
        turned = labels.withColumn(column, F.when(fold_of("doc_id", folds) == held, 1 - F.col(column)).otherwise(F.col(column)))
        one, other = (getattr(module, module.__name__.rpartition(".")[2])(docs, x).select("doc_id", "score") for x in (labels, turned))
        assert one.exceptAll(other).count() == 0


@pytest.mark.parametrize("module", [quality, toxicity])
def test_odd_rows_and_empty_tables(spark, module):
    score = getattr(module, module.__name__.rpartition(".")[2])
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    docs = spark.createDataFrame(
        [(1, None, 0.5), (1, None, 0.5), (2, "", 0.1), (None, "word " * 200_000, 0.2), (3, "?! \n", 0.3)], "doc_id long, text string, score double"
    )
    rows = score(docs, none).collect()
    assert len(rows) == 5 and all(0 <= r["score"] <= 1 for r in rows)
    assert score(docs.limit(0), none).count() == 0
    some = spark.createDataFrame([(2, 1, 0), (3, None, 1), (None, 0, 1)], none.schema)
    assert score(docs, some).count() == 5


def test_lexicon_folds_disguises_and_minds_exceptions():
    lexicon = toxicity.Lexicon({" idiot ": 5.0, " scumm": 4.0}, {" viiiage idiot "}, 5.0, -4.0)
    automaton = lexicon.automaton()
    for text in ("an idiot", "an 1D10T!", "an іdiοt", "ïdiót", "scummy"):
        assert toxicity.density_of(text, automaton) > 0, text
    for text in ("village idiot", "idiotic", "rescumm", "", None, "plain words"):
        assert toxicity.density_of(text, automaton) == 0, text
    assert toxicity.density_of("idiot " + "word " * 50, automaton) < toxicity.density_of("idiot", automaton)


def test_terms_of_copied_texts_stay_out(spark):
    rng = random.Random(1)
    words = [f"{a}{b}" for a in ("ka", "lo", "mi", "nu", "po") for b in ("ra", "se", "ti", "vo", "zu")]
    rows = []
    for k in range(600):
        text = rng.choices(words, k=40)
        if k % 6 == 0:
            for _ in range(3):
                text.insert(rng.randrange(len(text)), rng.choice(["grobnik", "vexxer"]))
        rows.append((k, " ".join(text), int(k % 6 == 0)))
    copied = "odd words that only one text has and grobnik vexxer in it"
    rows += [(1000 + k, copied, 1) for k in range(50)]
    lexicon = toxicity.learn(spark.createDataFrame(rows, "doc_id long, text string, label int"))
    assert sorted(lexicon.weights) == [" grobnik ", " vexxer "]


def test_licences_of_paragraphs(spark):
    prose = spark.read.parquet(f"{SF}/documents.parquet").filter("NOT text RLIKE '(?i)licen|rights'").limit(400).select("doc_id", "text")
    rows = [
        (90001, "Some words.\nReleased under the MIT License.\nMore words.", 1),
        (90002, "Licensed under the Apache License, Version 2.0. Copyright of somebody.\n\nLicensed under CC BY-NC 4.0.", 1),
        (90003, "The driver lost the license plate, and the licence office was closed on that day of the week.", 1),
        (90004, None, 1),
        (90005, "", 1),
        (None, "This work is licensed under the GNU General Public License, version 3.", 1),
    ]
    docs = prose.union(spark.createDataFrame(rows, "doc_id long, text string, similarity int").drop("similarity"))
    got = {r["doc_id"]: r for r in licenses.scan(docs).collect()}
    assert got[90001]["licences"] == ["mit"] and got[90001]["paragraphs"] == 1
    assert got[90002]["licences"] == ["apache-2.0", "cc-by-nc"] and got[90002]["similarity"] == 1
    assert got[None]["licences"] == ["gpl-3.0"]
    assert all(r["licences"] == [] and r["probability"] is None for i, r in got.items() if i is not None and i not in (90001, 90002))
    assert licenses.scan(docs.limit(0)).count() == 0


def _licences_among_prose(spark, texts):
    prose = spark.read.parquet(f"{SF}/documents.parquet").filter("NOT text RLIKE '(?i)licen|rights'").limit(400).select("doc_id", "text")
    docs = prose.union(spark.createDataFrame([(90001 + k, t) for k, t in enumerate(texts)], "doc_id long, text string"))
    got = {r["doc_id"]: r for r in licenses.scan(docs).collect()}
    assert all(r["licences"] == [] for i, r in got.items() if i <= 90000)
    return [got[90001 + k] for k in range(len(texts))]


def test_licences_of_notices_that_run_over_lines(spark):
    bsd = "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions are met"
    isc = "Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted, provided that"
    gpl = "it under the terms of the GNU General Public License as published by\nthe Free Software Foundation, either version 3 of the License, or"
    texts = [
        bsd,
        "# Some file\n#\n# " + bsd.replace("\n", "\n# "),
        "dnl " + isc.replace("\n", "\ndnl "),
        "/*\n * This program is free software: you can redistribute it and/or modify\n * " + gpl.replace("\n", "\n * ") + "\n * (at your option) any later version.\n */",
        "All rights\n\nreserved, said the words.",
        bsd + "\n\n" + isc,
    ]
    got = _licences_among_prose(spark, texts)
    assert [r["licences"] for r in got] == [["bsd"], ["bsd"], ["isc"], ["gpl-3.0"], [], ["bsd", "isc"]]
    assert [r["paragraphs"] for r in got] == [1, 1, 1, 1, 0, 2] and got[0]["similarity"] == 1


GNU = (
    "This program is free software; you can redistribute it and/or modify\nit under the terms of the GNU {}General Public License as published by\n"
    "the Free Software Foundation; either version {} of the License, or\n(at your option) any later version."
)
HEADERS = [
    (GNU.format("", "2"), ["gpl-2.0"]),
    (GNU.format("", "3"), ["gpl-3.0"]),
    (GNU.format("Lesser ", "2.1"), ["lgpl"]),
    (GNU.format("Lesser ", "3"), ["lgpl"]),
    (GNU.format("Affero ", "3"), ["agpl-3.0"]),
    ("All rights reserved. Licensed under the MIT license.", ["mit"]),
    ("Copyright 2020 The Authors.\nAll rights reserved.", ["proprietary"]),
    ("MIT License", ["mit"]),
    ("This is free and unencumbered software released into the public domain.", ["unlicense"]),
    ("This software is provided 'as-is', without any express or implied\nwarranty. In no event will the authors be held liable for any damages", ["zlib"]),
    ("This program and the accompanying materials are made available under the\nterms of the Eclipse Public License 2.0 which is available at", ["epl-2.0"]),
    ("SPDX-License-Identifier: FooBar-7.0", []),
    ("// SPDX-License-Identifier: GPL-2.0-only", ["gpl-2.0"]),
    ("# SPDX-License-Identifier: AGPL-3.0-or-later", ["agpl-3.0"]),
] + [(f"/* SPDX-License-Identifier: {x} */", [family]) for family, names in licenses.SPDX.items() for x in names]


def test_standard_headers_are_named_right_and_alone(spark):
    got = _licences_among_prose(spark, [t for t, _ in HEADERS] + [f"# {t}".replace("\n", "\n# ") for t, _ in HEADERS])
    wrong = [(t, w, r["licences"]) for (t, w), r in zip(HEADERS * 2, got, strict=True) if r["licences"] != w]
    assert wrong == []


def test_licences_inside_long_paragraphs(spark):
    rng = random.Random(3)
    words = [w for r in spark.read.parquet(f"{SF}/documents.parquet").limit(50).collect() for w in r["text"].split() if "licen" not in w.lower()]
    notices = [
        ("mit", "Released under the MIT License."),
        ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ]
    texts = []
    for _, notice in notices * 10:
        before, after = (rng.choices(words, k=rng.randrange(500, 1500)) for _ in range(2))
        texts.append(" ".join([*before, notice, *after]))
    got = _licences_among_prose(spark, texts)
    assert [r["licences"] for r in got] == [[family] for family, _ in notices * 10]


def test_exception_phrases_excuse_the_terms_inside_them():
    rng = random.Random(8)
    words = ["wa", "wb", "wc", "wd", "we", "wf"]
    lexicon = toxicity.Lexicon({" wb ": 2.0, " wc": 1.0}, {" wa wb ", " wb wc ", " wc wd ", " wb wc we "})
    for _ in range(300):
        text = rng.choices(words, k=rng.randrange(1, 12))
        padded = f" {' '.join(text)} "
        spans = [(m, m + len(e) - 1) for e in lexicon.exceptions for m in range(len(padded)) if padded.startswith(e, m)]
        hits = [(m, m + len(t) - 1, w) for t, w in lexicon.weights.items() for m in range(len(padded)) if padded.startswith(t, m)]
        total = sum(w for a, b, w in hits if not any(x <= a and b <= y for x, y in spans))
        assert toxicity.density_of(" ".join(text), lexicon.automaton()) == pytest.approx(100 * total / (len(text) + 10))


def test_terms_that_begin_alike_are_one():
    terms = [(" bad", 900.0, 1.0), (" badly ", 500.0, 0.0), (" bads", 400.0, 0.0), (" worse ", 300.0, 0.0), (" wor", 100.0, 0.0), (" worst", 200.0, 0.0)]
    assert toxicity._chosen(terms, 10_000.0, 10_000.0).keys() == {" bad", " worse ", " worst"}
