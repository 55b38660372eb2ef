"""License scan by a positional index of rare words.

How rare the words of the licence templates are is counted over all documents.  A template
is posted under its rarest words only: so many that what is left weighs less than a match
needs, so that no match goes without one of them.  A file's words that are posted give the
places where a template may begin; there the template's other words are looked up at their
relative positions, give or take a few words for names and years put in between, and
every mandatory phrase of the template must stand in its place.

Short phrases that must stand word for word are templates whose mandatory phrase is the whole
of them, so that their places are exact.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbline.llm.common import small_batches

#: Share of a template's weight that must be found in place.
SHARE = 0.6
#: Words by which a place may differ from the template's, either way.
SLACK = 8

# Phrases that name a licence wherever they stand, with their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Sentences of licence notices, with label and mandatory phrases.
NOTICES = (
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
     " documentation files, to deal in the software without restriction, including without limitation the rights to use, copy,"
     " modify, merge, publish, distribute, sublicense, and/or sell copies of the software",
     ("free of charge to any person obtaining a copy", "merge publish distribute sublicense")),
    ("apache", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"
     " http www apache org licenses LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed"
     " under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied",
     ("in compliance with the license", "unless required by applicable law or agreed to in writing")),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public"
     " License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
     ("gnu general public license", "free software foundation")),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General"
     " Public License as published by the Free Software Foundation", ("gnu lesser general public license",)),
    ("agpl", "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by"
     " the Free Software Foundation", ("gnu affero general public license",)),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not"
     " distributed with this file, You can obtain one at http mozilla org MPL 2.0", ("mozilla public license",)),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the"
     " following conditions are met: Redistributions of source code must retain the above copyright notice, this list of"
     " conditions and the following disclaimer", ("redistribution and use in source and binary forms", "with or without modification")),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby"
     " granted, provided that the above copyright notice and this permission notice appear in all copies",
     ("for any purpose with or without fee",)),
    ("unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify,"
     " publish, use, compile, sell, or distribute this software", ("free and unencumbered software",)),
    ("zlib", "This software is provided as-is, without any express or implied warranty. In no event will the authors be held"
     " liable for any damages arising from the use of this software", ("in no event will the authors be held liable",)),
    ("bsl", "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and"
     " accompanying documentation covered by this license", ("any person or organization obtaining a copy",)),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License", ("creative commons attribution 4 0 international",)),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution ShareAlike 4.0 International License", ("creative commons attribution sharealike",)),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution NonCommercial 4.0 International License", ("creative commons attribution noncommercial",)),
    ("cc-by-nc", "cc by nc", ("cc by nc",)),
    ("cc-by-nd", "cc by nd", ("cc by nd",)),
    ("cc-by-sa", "cc by sa", ("cc by sa",)),
    ("cc0", "cc0 1 0 universal", ("cc0 1 0 universal",)),
    ("epl", "eclipse public license", ("eclipse public license",)),
)

_PLAIN = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def words_in(text: str | None) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of a text with A-Z in lower case, as UTF-8."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_PLAIN).split()


@dataclass(frozen=True)
class Template:
    """Words in order, the phrases that must be among them, and whether it must match word for word."""

    label: str
    words: tuple[bytes, ...]
    phrases: tuple[tuple[bytes, ...], ...]
    exact: bool

    @staticmethod
    def of(label: str, text: str, phrases: Sequence[str], exact: bool = False) -> Template:
        template = Template(label, tuple(words_in(text)), tuple(tuple(words_in(p)) for p in phrases), exact)
        if not template.words or not all(p and template.place(p) is not None for p in template.phrases):
            raise ValueError(f"{label}: a template needs words, and its phrases must be among them")
        return template

    def place(self, phrase: tuple[bytes, ...]) -> int | None:
        n = len(phrase)
        return next((i for i in range(len(self.words) - n + 1) if self.words[i : i + n] == phrase), None)


def known_templates() -> list[Template]:
    phrases = [Template.of(label, text, [text], exact=True) for text, label in PHRASES.items()]
    return phrases + [Template.of(*notice) for notice in NOTICES]


def _counting(vocabulary: frozenset[bytes]):
    def counting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()
        for batch in batches:
            for text in batch.column(0):
                held.update(vocabulary.intersection(words_in(text.as_py())))
                held[b""] += 1  # no word is empty: all documents
        yield pa.RecordBatch.from_arrays([pa.array([w.decode() for w in held], type=pa.string()), pa.array(list(held.values()), type=pa.int64())], names=["word", "n"])

    return counting


def rarity(docs: DataFrame, templates: Sequence[Template], text: str = "text") -> dict[bytes, float]:
    """Inverse document frequency of every template word, counted over all documents.

    What is collected is a row for each word of the templates.
    """
    small_batches(docs.sparkSession)
    vocabulary = frozenset(w for t in templates for w in t.words)
    counts = docs.select(text).mapInArrow(_counting(vocabulary), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    held = {r["word"].encode(): r["n"] for r in counts.collect()}
    return {w: 1 + math.log((1 + held.get(b"", 0)) / (1 + held.get(w, 0))) for w in vocabulary}


class Index:
    """Templates posted under their rarest words."""

    def __init__(self, templates: Sequence[Template], idf: dict[bytes, float], share: float = SHARE, slack: int = SLACK):
        self.templates, self.idf, self.share, self.slack = list(templates), idf, share, slack
        self.vocabulary = frozenset(w for t in templates for w in t.words)
        self.postings: dict[bytes, list[tuple[int, int]]] = {}
        for number, template in enumerate(templates):
            need = (1.0 if template.exact else share) * sum(idf[w] for w in template.words)
            left = sum(idf[w] for w in template.words)
            for place in sorted(range(len(template.words)), key=lambda i: (-idf[template.words[i]], template.words[i], i)):  # noqa: B023
                if left < need * (1 - 1e-9):
                    break
                self.postings.setdefault(template.words[place], []).append((number, place))
                left -= idf[template.words[place]]
        self.posted = frozenset(self.postings)

    def find(self, words: list[bytes]) -> list[tuple[str, bool, int, int, float]]:
        """(label, exact, first word, words, share found) of every template met, by place."""
        rare = self.posted.intersection(words)
        if not rare:
            return []
        at: dict[bytes, list[int]] = {}
        for i, word in enumerate(words):
            if word in self.vocabulary:
                at.setdefault(word, []).append(i)
        places = {w: np.array(p) for w, p in at.items()}
        starts: dict[int, list[np.ndarray]] = {}
        for word in rare:
            for number, place in self.postings[word]:
                starts.setdefault(number, []).append(places[word] - place)
        found = []
        for number, some in sorted(starts.items()):
            template, slack = self.templates[number], self.slack
            phrases = [(p, _consecutive(p, places)) for p in template.phrases]
            if any(not len(p) for _, p in phrases):
                continue
            start = np.unique(np.concatenate(some))
            if template.exact:
                start = np.intersect1d(start, phrases[0][1])
                found += [(template.label, True, int(s), len(template.words), 1.0) for s in start]
                continue
            for phrase, stands in phrases:
                start = start[_near(start + template.place(phrase), stands, slack)]
            weight = np.zeros(len(start))
            for place, word in enumerate(template.words):
                if word in places:
                    weight += np.where(_near(start + place, places[word], slack), self.idf[word], 0.0)
            share = weight / sum(self.idf[w] for w in template.words)
            enough = share >= self.share
            start, share = start[enough], np.minimum(share[enough], 1.0)
            # Starts next to each other are one place; the fullest one, and of those the first, stands for it.
            for one in np.split(np.arange(len(start)), np.flatnonzero(np.diff(start) > 2 * slack) + 1):
                if len(one):
                    best = one[np.argmax(share[one])]
                    found.append((template.label, False, max(0, int(start[best])), len(template.words), float(share[best])))
        return sorted(found, key=lambda f: (f[2], f[0], not f[1]))


def _consecutive(phrase: tuple[bytes, ...], places: dict[bytes, np.ndarray]) -> np.ndarray:
    """Where a phrase's words follow one another."""
    none = np.zeros(0, dtype=np.int64)
    shifted = sorted((places.get(w, none) - i for i, w in enumerate(phrase)), key=len)
    out = shifted[0]
    for other in shifted[1:]:
        out = np.intersect1d(out, other, assume_unique=True)
    return out


def _near(wanted: np.ndarray, stands: np.ndarray, slack: int) -> np.ndarray:
    """Whether one of the sorted places is within slack of each wanted one."""
    return np.searchsorted(stands, wanted - slack, "left") < np.searchsorted(stands, wanted + slack, "right")


_FOUND = "struct<n_words:bigint,places:array<struct<label:string,exact:boolean,first_word:bigint,n_words:bigint,share:double>>>"


def scan(
    docs: DataFrame,
    templates: Sequence[Template] | None = None,
    text: str = "text",
    share: float = SHARE,
    slack: int = SLACK,
) -> DataFrame:
    """The documents with ``licenses``: the words of the text and the places of templates in it.

    A place has the template's label, whether it matched word for word (a phrase), its first
    word, the template's length in words and the share of its weight found there.  A null text is empty and has
    no places.  Rows are handled each for itself, so repeated ones, null ids and other
    columns don't matter; a column named licenses is replaced.
    """
    templates = known_templates() if templates is None else list(templates)
    index = Index(templates, rarity(docs, templates, text), share, slack)

    @F.arrow_udf(_FOUND)
    def found(texts: pa.Array) -> pa.Array:
        sizes, starts, rows = [], [0], []
        for t in texts:
            words = words_in(t.as_py())
            rows += index.find(words)
            sizes.append(len(words))
            starts.append(len(rows))
        kinds = (("label", pa.string()), ("exact", pa.bool_()), ("first_word", pa.int64()), ("n_words", pa.int64()), ("share", pa.float64()))
        flat = pa.StructArray.from_arrays([pa.array([r[i] for r in rows], type=kind) for i, (_, kind) in enumerate(kinds)], names=[name for name, _ in kinds])
        places = pa.ListArray.from_arrays(pa.array(starts, type=pa.int32()), flat)
        return pa.StructArray.from_arrays([pa.array(sizes, type=pa.int64()), places], names=["n_words", "places"])

    return docs.withColumn("licenses", found(F.col(text)))


def labels_of(places: Column) -> Column:
    """Distinct labels, sorted and comma-joined."""
    return F.array_join(F.array_sort(F.array_distinct(places["label"])), ",")
