"""License scan against plain searches and planted notices."""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import functions as F

from ebbline.llm import licenses
from ebbline.llm.queries import QUERIES

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
MIT = """Copyright (c) 2020 Some One

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is so."""
BSD = """# Redistribution and use in source and binary forms, with or without
# modification, are permitted provided that the following conditions are met:
# 1. Redistributions of source code must retain the above copyright notice, this list."""


def brute(text: str | None) -> tuple:
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    found = [(i, label) for p, label in BASE.items() for i in range(len(words)) if words[i : i + len(p.split())] == p.split()]
    at = [i for i, _ in found]
    return len(words), len(found), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in found}))


def test_query_over_the_given_table(spark):
    sf = "/root/testdata/sf0.01"
    texts = dict(tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect())
    found = QUERIES["op13_license_scan"](spark, sf)
    kinds = {"doc_id": "bigint", "n_words": "bigint", "n_base": "bigint", "first_word": "bigint", "last_word": "bigint"}
    assert dict(found.dtypes) == kinds | {"base_labels": "string", "labels": "string", "score": "double"}
    rows = found.collect()
    assert len(rows) == len(texts) and sum(r.n_base for r in rows) > 0
    for r in rows:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute(texts[r.doc_id])
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(",")))
        assert (r.score == 1.0) == (r.n_base > 0) and 0 <= r.score <= 1
        assert ("cc-by-nc" in r.labels) == ("CC BY-NC" in texts[r.doc_id])


def scanned(spark, texts: list) -> list:
    rows = licenses.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id")
    return [(r.licenses.n_words, r.licenses.places) for r in rows.collect()]


def test_random_words_equal_a_plain_search(spark):
    rng = np.random.default_rng(4)
    some = ["gnu", "General", "public", "LICENSE", "apache", "cc", "by", "mit", "é", "x1", "CC-BY"]
    ends = [" ", "\n", "-", ", ", " ", "/", "_"]
    texts = ["".join(some[i] + ends[j] for i, j in zip(rng.integers(0, 11, 400), rng.choice(7, 400, p=[0.7, 0.05, 0.05, 0.05, 0.05, 0.05, 0.05]), strict=True)) for _ in range(60)]
    for text, (n, places) in zip(texts, scanned(spark, texts), strict=True):
        exact = [p for p in places if p.exact]
        at = [p.first_word for p in exact]
        assert (n, len(exact), min(at, default=None), max(at, default=None), ",".join(sorted({p.label for p in exact}))) == brute(text)


def test_notices_are_found_and_parts_of_them_are_not(spark):
    filler = "plain words that tell of nothing in particular " * 30
    gpl = "This program is free software: you may redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 2, or (at your option) any later version."
    texts = [
        filler + MIT + filler,
        filler + BSD + filler + "\n" + MIT,
        filler + gpl,
        filler + gpl.replace("General", "Lesser General"),
        "software permission granted copy merge publish free of charge " + filler,  # words without the phrases
        MIT.split("\n")[2],  # the first line only: too little of the weight
        filler,
        " ".join(reversed(MIT.split())),
        (MIT + "\n" + filler) * 3,
    ]
    found = [[(p.label, p.exact) for p in places] for _, places in scanned(spark, texts)]
    assert found[0] == [("mit", False)] and found[1] == [("bsd", False), ("mit", False)]
    assert sorted(found[2]) == [("gpl", False), ("gpl", True)] and found[3] == [("lgpl", False)]
    assert found[4:8] == [[], [], [], []] and found[8] == [("mit", False)] * 3
    (_, places), *_ = scanned(spark, [filler + MIT])
    assert places[0].first_word == len(filler.split()) + 5 and 0.9 < places[0].share <= 1


def test_no_match_goes_without_a_posted_word():
    """The scan by posted words equals one that posts every word of every template."""
    rng = np.random.default_rng(8)
    templates = licenses.known_templates()
    idf = {w: float(rng.uniform(1, 9)) for t in templates for w in t.words}
    index, full = licenses.Index(templates, idf), licenses.Index(templates, idf)
    full.postings = {}
    for number, t in enumerate(templates):
        for place, w in enumerate(t.words):
            full.postings.setdefault(w, []).append((number, place))
    full.posted = frozenset(full.postings)
    assert len(index.posted) < len(full.posted)
    met = 0
    for _ in range(300):
        words: list[bytes] = []
        for t in rng.choice(len(templates), 3):
            words += [w for w in templates[t].words if rng.random() > 0.12] + [b"x"] * int(rng.integers(0, 30))
        labels = {(f[0], f[1]) for f in index.find(words)}
        assert labels == {(f[0], f[1]) for f in full.find(words)}
        met += len(labels)
    assert met > 300


def test_odd_rows(spark, odd, nothing):
    found = licenses.scan(odd)
    assert found.columns == [*odd.columns, "licenses"] and found.count() == odd.count()
    by_text = {r.text: r.licenses for r in found.collect()}
    assert by_text[None].n_words == 0 and by_text["word " * 60_000].n_words == 60_000
    assert all(not r.places for r in by_text.values())
    assert licenses.scan(nothing).count() == 0
    clash = spark.createDataFrame([(None, "Apache License", 3)], "doc_id long, text string, licenses int").withColumn("places", F.lit(1))
    (row,) = licenses.scan(clash).collect()
    assert [(p.label, p.first_word, p.share) for p in row.licenses.places] == [("apache", 0, 1.0)]
    long = "gnu general public license " * 50_000
    (n, places), *_ = scanned(spark, [long])
    assert n == 200_000 and sum(p.exact for p in places) == 50_000
