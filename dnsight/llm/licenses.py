"""License notices in texts by a positional index of rare words.

Each template is a short notice. Its words are weighted by inverse document frequency, counted over all
documents; the RARE heaviest make the template's postings (word, position). A text's occurrences of
posted words each vote for the place where the template would begin; places with enough votes are
compared with the whole template word by word, and a label needs one of its key phrases inside the
compared place. Besides, every place of a base phrase counts, whatever surrounds it.

Defined cases: null counts as the empty text, which has no words, no label and score 0; ties between
templates give all their labels; repeated rows are scored each; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dnsight.llm import words as W

# Base phrases and labels.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

#: Notices (label, key phrases of which one must be there, text).
TEMPLATES = [
    ("gpl", ["gnu general public license"], "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", ["gnu general public license"], "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("lgpl", ["gnu lesser general public license"], "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("agpl", ["gnu affero general public license"], "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation"),
    ("apache", ["apache license"], "Licensed under the Apache License, Version 2.0."),
    ("apache", ["apache license"], "you may not use this file except in compliance with the License. You may obtain a copy of the License at http www apache org licenses LICENSE 2.0"),
    ("mit", ["mit license"], "Released under the MIT License."),
    ("mit", ["permission is hereby granted"], "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("bsd", ["redistribution and use"], "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("cc-by", ["cc by"], "Licensed under CC BY 4.0."),
    ("cc-by-nc", ["cc by nc"], "Licensed under CC BY-NC 4.0."),
    ("cc-by-sa", ["cc by sa"], "Licensed under CC BY-SA 4.0."),
    ("cc-by-nd", ["cc by nd"], "Licensed under CC BY-ND 4.0."),
    ("cc0", ["public domain dedication", "cc0"], "Licensed under CC0 1.0 Universal public domain dedication."),
    ("mpl", ["mozilla public license"], "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("unlicense", ["released into the public domain"], "This is free and unencumbered software released into the public domain."),
    ("proprietary", ["all rights reserved"], "All rights reserved."),
]

#: Postings per template, at most.
RARE = 4
#: Share of a template's weight that a place has to match.
LEAST = 0.6

RESULT = (
    "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string,"
    " score double"
)


def _hashes(text: str) -> np.ndarray:
    return W.word_hashes(pa.array([text]), W.ALPHANUMERIC)[0]


def _frequencies(docs: DataFrame, vocabulary: np.ndarray) -> tuple[int, dict[int, int]]:
    """Number of documents, and how many of them hold each of the template words."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def count(batches):
        vocabulary = shared.value
        total, held = 0, np.zeros(len(vocabulary), np.int64)
        for batch in batches:
            for part in W.slices(batch, "text"):
                hashes, first = W.word_hashes(part.column("text"), W.ALPHANUMERIC)
                at, word = _known(hashes, vocabulary)
                row = np.searchsorted(first, at, side="right") - 1
                once = np.unique(row * len(vocabulary) + word)
                held += np.bincount(once % len(vocabulary), minlength=len(vocabulary))
                total += part.num_rows
        yield pa.RecordBatch.from_arrays(
            [pa.array([-1, *range(len(vocabulary))], pa.int64()), pa.array([total, *held.tolist()], pa.int64())],
            ["word", "n"],
        )

    rows = docs.mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    counts = {r["word"]: r["n"] for r in rows}
    return counts.pop(-1, 0), counts


def _known(hashes: np.ndarray, vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of words of the sorted vocabulary, and which they are."""
    word = np.searchsorted(vocabulary, hashes)
    word[word == len(vocabulary)] = 0
    at = np.flatnonzero(vocabulary[word] == hashes)
    return at, word[at]


def build_index(docs: DataFrame, templates=TEMPLATES) -> dict:
    """Template words with their weights, and the postings of the rarest; of fixed size."""
    bodies = [_hashes(text) for _, _, text in templates]
    vocabulary = np.unique(np.concatenate(bodies))
    total, held = _frequencies(docs, vocabulary)
    weight = np.array([np.log((1 + total) / (1 + held.get(i, 0))) + 0.01 for i in range(len(vocabulary))])
    postings = []
    for number, body in enumerate(bodies):
        word = np.searchsorted(vocabulary, body)
        # A word that no document holds finds nothing; such words come last.
        absent = [not held.get(int(w), 0) for w in word]
        rarest = sorted(range(len(body)), key=lambda p: (absent[p], -weight[word[p]], p))[:RARE]
        postings += [(int(word[p]), number, p) for p in rarest]
    postings = np.array(sorted(postings), np.int64)
    return {
        "vocabulary": vocabulary,
        "word": postings[:, 0], "template": postings[:, 1], "position": postings[:, 2],
        "bodies": bodies,
        "weights": [weight[np.searchsorted(vocabulary, b)] for b in bodies],
        "labels": [label for label, _, _ in templates],
        "phrases": [[_hashes(p) for p in phrases] for _, phrases, _ in templates],
        "base": [(_hashes(phrase), label) for phrase, label in BASE.items()],
    }


def _phrase_places(hashes: np.ndarray, first: np.ndarray, phrase: np.ndarray) -> np.ndarray:
    """Starts of a phrase within one row."""
    at = np.flatnonzero(hashes[: max(len(hashes) - len(phrase) + 1, 0)] == phrase[0])
    for k in range(1, len(phrase)):
        at = at[hashes[at + k] == phrase[k]]
    end = first[np.searchsorted(first, at, side="right")] if len(at) else at
    return at[at + len(phrase) <= end]


def _template_matches(index: dict, hashes: np.ndarray, first: np.ndarray):
    """(row, template, score) of each place that matches a template."""
    at, word = _known(hashes, index["vocabulary"])
    low = np.searchsorted(index["word"], word, side="left")
    times = np.searchsorted(index["word"], word, side="right") - low
    posting = np.repeat(low, times) + np.arange(times.sum()) - np.repeat(times.cumsum() - times, times)
    start = np.repeat(at, times) - index["position"][posting]
    row = np.searchsorted(first, np.repeat(at, times), side="right") - 1
    template = index["template"][posting]
    votes = np.stack([row, template, start], axis=1)
    places, n = np.unique(votes, axis=0, return_counts=True) if len(votes) else (votes, np.zeros(0, int))
    sizes = np.bincount(index["template"])
    for (row, template, start), n in zip(places.tolist(), n.tolist()):
        if 2 * n < sizes[template]:
            continue
        body, weights = index["bodies"][template], index["weights"][template]
        low, high = max(start, int(first[row])), min(start + len(body), int(first[row + 1]))
        window = hashes[low:high]
        same = window == body[low - start: high - start]
        score = float(weights[low - start: high - start][same].sum() / weights.sum())
        inside = np.array([0, len(window)])
        if score >= LEAST and any(
            len(_phrase_places(window, inside, p)) for p in index["phrases"][template]
        ):
            yield row, template, score


def scan(docs: DataFrame, index: dict | None = None) -> DataFrame:
    """doc_id with the number and range of base phrases, all labels, and the best match as score."""
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(index or build_index(rows.select("text")))

    def label(batches):
        index = shared.value
        for batch in batches:
            for part in W.slices(batch, "text"):
                hashes, first = W.word_hashes(part.column("text"), W.ALPHANUMERIC)
                base = [(label, _phrase_places(hashes, first, p)) for p, label in index["base"]]
                found = {}
                for label, at in base:
                    for place, row in zip(at.tolist(), (np.searchsorted(first, at, side="right") - 1).tolist()):
                        found.setdefault(row, []).append((place - int(first[row]), label))
                matched = {}
                for row, template, score in _template_matches(index, hashes, first):
                    matched.setdefault(row, []).append((index["labels"][template], score))
                out = []
                for row, n in enumerate(np.diff(first).tolist()):
                    own, more = found.get(row, []), matched.get(row, [])
                    names = {name for _, name in own}
                    out.append((
                        n, len(own), min((p for p, _ in own), default=None),
                        max((p for p, _ in own), default=None), ",".join(sorted(names)),
                        ",".join(sorted(names | {name for name, _ in more})),
                        1.0 if own else min(1.0, max((s for _, s in more), default=0.0)),
                    ))
                kinds = (*[pa.int64()] * 4, pa.string(), pa.string(), pa.float64())
                columns = [pa.array(c, k) for c, k in zip(zip(*out), kinds)]
                names = [c.split()[0] for c in RESULT.split(", ")]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *columns], ["doc_id", *names])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(label, f"doc_id {kind}, {RESULT}")
