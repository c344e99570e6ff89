"""License scans with a positional rare-token index.

Every template (a base phrase, a licence's name or SPDX identifier, a notice, a whole short licence) is indexed by its words of
highest inverse document frequency, measured over the whole corpus, each with its places in the template: RARE of them,
and of a phrase all. A file's own words of the index, the rarest first, are looked up; the places where a
posting puts the template's beginning are intersected: all rare words of a phrase must agree on one, AGREE of a longer template (or all
that it has). Places where the mandatory key phrase doesn't stand as it should are dropped, the others are scored by the IDF-weighted share
of template words that stand at their relative positions, WOBBLE words of play allowed on either side.

Base phrases are templates whose key phrase is the whole, so every place of them is found, whatever their words' frequency. A longer template
gives its label at a share of NOTICE_SHARE or more. The score of a file is 1 with a base phrase, else its best share. A null text is
empty; repeated rows are judged one by one; an empty corpus gives no rows.
"""

from __future__ import annotations

import math
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import annotate, lower_alnum_words, text_bytes, tidy

BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
#: Names of public licences: each is a phrase of its own.
NAMES = {
    "gnu lesser general public license": "lgpl",
    "gnu library general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "european union public licence": "eupl",
    "bsd 2 clause": "bsd",
    "bsd 3 clause": "bsd",
    "new bsd license": "bsd",
    "isc license": "isc",
    "boost software license": "boost",
    "zlib license": "zlib",
    "creative commons attribution": "cc-by",
    "creative commons attribution sharealike": "cc-by-sa",
    "creative commons attribution noncommercial": "cc-by-nc",
    "creative commons zero": "cc0",
    "cc0 1 0 universal": "cc0",
    "cc by sa": "cc-by-sa",
    "cc by nc": "cc-by-nc",
}
#: SPDX identifiers as words, after ``SPDX-License-Identifier:``.
SPDX = {
    "mit": "mit", "apache 2 0": "apache", "gpl 2 0": "gpl", "gpl 3 0": "gpl", "lgpl 2 1": "lgpl", "lgpl 3 0": "lgpl", "agpl 3 0": "agpl", "bsd 2 clause": "bsd", "bsd 3 clause": "bsd",
    "isc": "isc", "mpl 2 0": "mpl", "epl 2 0": "epl", "eupl 1 2": "eupl", "bsl 1 0": "boost", "zlib": "zlib", "unlicense": "unlicense", "cc0 1 0": "cc0", "cc by 4 0": "cc-by", "cc by sa 4 0": "cc-by-sa", "cc by nc 4 0": "cc-by-nc",
}
#: Notices and whole short licences: label, mandatory key phrase, text.
NOTICES = [
    ("gpl", "of the gnu general public license", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("lgpl", "lesser general public license", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license"),
    ("agpl", "affero general public license", "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license"),
    ("apache", "may not use this file except in compliance", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("apache", "distributed on an as is basis", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied"),
    ("mit", "free of charge to any person obtaining a copy", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "substantial portions of the software", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("bsd", "redistribution and use in source and binary forms", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("bsd", "must retain the above copyright notice", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"),
    ("isc", "permission to use copy modify", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("mpl", "mozilla public license", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("cc-by", "creative commons attribution", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-sa", "creative commons attribution sharealike", "this work is licensed under a creative commons attribution sharealike 4 0 international license"),
    ("unlicense", "released into the public domain", "this is free and unencumbered software released into the public domain"),
    ("zlib", "provided as is without any express or implied warranty", "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software"),
    ("boost", "to any person or organization obtaining a copy", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license"),
]
#: Rare words a longer template is indexed by, how many of those must agree on its place, and the share of it that gives its label.
RARE = 8
AGREE = 2
NOTICE_SHARE = 0.6
#: Words that may be missing or added between parts of a longer template.
WOBBLE = 2


class Template:
    def __init__(self, label: str, key: str, text: str, kind: str):
        self.label, self.base, self.phrase = label, kind == "base", kind != "notice"
        self.words = [w.encode() for w in text.split()]
        self.key = [w.encode() for w in key.split()]
        self.key_at = next(i for i in range(len(self.words)) if self.words[i : i + len(self.key)] == self.key)


TEMPLATES = (
    [Template(label, phrase, phrase, "base") for phrase, label in BASE.items()]
    + [Template(label, phrase, phrase, "name") for phrase, label in NAMES.items()]
    + [Template(label, f"spdx license identifier {i}", f"spdx license identifier {i}", "name") for i, label in SPDX.items()]
    + [Template(*n, "notice") for n in NOTICES]
)
VOCABULARY = frozenset(w for t in TEMPLATES for w in t.words)


def document_frequencies(docs: DataFrame) -> tuple[int, dict[bytes, int]]:
    """Documents, and those that hold each licence word, over all rows. A row per task and word is shuffled."""

    @tidy
    def count(batches):
        n, held = 0, Counter()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                for text in batch.slice(at, 256).column(0).to_pylist():
                    n += 1
                    held.update(VOCABULARY.intersection(lower_alnum_words(text)))
        yield pa.RecordBatch.from_pydict({"word": [b"", *held], "n": [n, *held.values()]})

    counts = docs.select(text_bytes()).mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    found = {bytes(r["word"]): r["n"] for r in counts.collect()}  # at most a row per licence word
    return found.pop(b"", 0), found


class RareTokenIndex:
    """Postings of the templates' rarest words, with their places."""

    def __init__(self, n_docs: int, frequencies: dict[bytes, int]):
        self.idf = {w: math.log((n_docs + 1) / (frequencies.get(w, 0) + 1)) + 1 for w in VOCABULARY}
        self.weight = [sum(self.idf[w] for w in t.words) for t in TEMPLATES]
        self.postings: dict[bytes, list[tuple[int, int]]] = {}
        self.need: list[int] = []
        self.gate: set[bytes] = set()  # without one of these a file holds no template
        for k, t in enumerate(TEMPLATES):
            rarest = sorted(range(len(t.words)), key=lambda i: (-self.idf[t.words[i]], i))
            chosen = rarest if t.phrase else rarest[:RARE]
            for i in chosen:
                self.postings.setdefault(t.words[i], []).append((k, i))
            self.need.append(len(chosen) if t.phrase else min(AGREE, len(chosen)))
            self.gate.update([t.words[rarest[0]]] if t.phrase else [t.words[i] for i in chosen])

    def places(self, words: list[bytes]) -> dict[int, list[int]]:
        """For each template where it may begin: the postings of the file's rare words, intersected by relative position."""
        if self.gate.isdisjoint(words):
            return {}
        at: dict[bytes, list[int]] = {}
        for p, w in enumerate(words):
            if w in self.postings:
                at.setdefault(w, []).append(p)
        agreed: dict[tuple[int, int], int] = {}
        for w in sorted(at, key=lambda w: (-self.idf[w], w)):
            for k, i in self.postings[w]:
                for p in at[w]:
                    agreed[k, p - i] = agreed.get((k, p - i), 0) + 1
        out: dict[int, list[int]] = {}
        for (k, begin), n in agreed.items():
            if n >= self.need[k]:
                out.setdefault(k, []).append(begin)
        return out

    def share(self, k: int, begin: int, words: list[bytes]) -> float:
        """Share of the template, by weight, that stands in the file where it begins there: words in order, each at its place or a little off."""
        t, have, off = TEMPLATES[k], 0.0, 0
        for i, w in enumerate(t.words):
            for step in sorted(range(-WOBBLE, WOBBLE + 1), key=abs):
                p = begin + i + off + step
                if 0 <= p < len(words) and words[p] == w:
                    have, off = have + self.idf[w], off + step
                    break
        return min(1.0, have / self.weight[k])

    def scan(self, words: list[bytes]) -> tuple:
        base, found, score = [], set(), 0.0
        for k, begins in self.places(words).items():
            t = TEMPLATES[k]
            for begin in begins:
                if not any(words[p : p + len(t.key)] == t.key for p in ([begin] if t.phrase else range(max(0, begin + t.key_at - WOBBLE), begin + t.key_at + WOBBLE + 1)) if p >= 0):
                    continue
                if t.base:
                    base.append((begin, t.label))
                    continue
                share = 1.0 if t.phrase else self.share(k, begin, words)
                score = max(score, share)
                if share >= NOTICE_SHARE:
                    found.add(t.label)
        base.sort()
        labels = {label for _, label in base}
        first, last = (base[0][0], base[-1][0]) if base else (None, None)
        return (len(words), len(base), first, last, ",".join(sorted(labels)), ",".join(sorted(labels | found)), 1.0 if base else score, [f"{label}@{at}" for at, label in base])


def scan(docs: DataFrame, keep: list[str], name: str = "_pw") -> DataFrame:
    """``keep`` columns and a struct ``name``: n_words, n_base, first_word, last_word, base_labels, labels, score, places (label@word)."""
    index = RareTokenIndex(*document_frequencies(docs))

    def make():
        return lambda texts: [index.scan(lower_alnum_words(t or b"")) for t in texts]

    return annotate(docs, keep, "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, places array<string>", make, name)


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(spark.read.parquet(f"{sf_dir}/documents.parquet"), ["doc_id"])
    return found.select("doc_id", *[f"_pw.{c}" for c in ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")])


QUERIES = {"op6_licenses": op6_licenses}
ORACLES: dict[str, str] = {}
