"""Licence texts in documents, by matching statistics over a suffix automaton.

One automaton holds all licence templates as word sequences.  A document's
words stream through it; at every word it knows the longest stretch ending
there that occurs in some template.  Stretches of ``shortest`` words or more
that cannot grow further are the long matches.  Those of one template that
follow each other in the document and in the template are chained, and the
share of the template's words that a chain covers is its score.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.texts import NOT_ALNUM, byte_slices, byte_table, split_words
from millrace.session import fetch_small

#: words between two matches of a chain that are always allowed, and templates a table may have
LEAST_GAP, MOST_TEMPLATES = 8, 10_000

# Phrases whose places are counted, with their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Public licence notices, by label.
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0",
    "apache-2.0-notice": (
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with "
        "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by "
        "applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, "
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice"
    ),
    "cc-by-4.0": "This work is licensed under CC BY 4.0",
    "cc-by-long": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0",
    "cc-by-sa-4.0": "Licensed under CC BY-SA 4.0",
    "cc0": "The person who associated a work with this deed has dedicated the work to the public domain",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3",
    "gpl-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
        "version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY"
    ),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "lgpl": "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
    "mit-named": "Released under the MIT License",
    "mit-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the Software), to deal in the Software without restriction, including without limitation the "
        "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"
    ),
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
}


def words_of(text: str) -> list[str]:
    _, words = split_words(pa.array([text]), byte_table(NOT_ALNUM))
    return words.to_pylist()


class Automaton:
    """Suffix automaton of several sequences; its size is linear in their total length.

    ``own[state]`` lists (sequence, end) of the occurrences that no longer state
    holds; all occurrences of a state's strings are those below it in the tree of links.
    """

    def __init__(self, sequences: Sequence[Sequence[int]]):
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        self.own: list[list[tuple[int, int]]] = [[]]
        for n, sequence in enumerate(sequences):
            last = 0
            for i, word in enumerate(sequence):
                last = self._extend(last, word)
                self.own[last].append((n, i + 1))
        self.below: list[list[int]] = [[] for _ in self.link]
        for state in range(1, len(self.link)):
            self.below[self.link[state]].append(state)

    def seen(self, state: int) -> Iterator[tuple[int, int]]:
        """(sequence, end) of every occurrence of the state's strings."""
        left = [state]
        while left:
            at = left.pop()
            yield from self.own[at]
            left += self.below[at]

    def _state(self, length: int, link: int, following: dict[int, int]) -> int:
        self.next.append(following)
        self.link.append(link)
        self.length.append(length)
        self.own.append([])
        return len(self.length) - 1

    def _split(self, state: int, word: int) -> int:
        """The state reached by ``word``, cut so that its strings are one word longer at most."""
        to = self.next[state][word]
        if self.length[to] == self.length[state] + 1:
            return to
        copy = self._state(self.length[state] + 1, self.link[to], dict(self.next[to]))
        self.link[to] = copy
        while state >= 0 and self.next[state].get(word) == to:
            self.next[state][word] = copy
            state = self.link[state]
        return copy

    def _extend(self, last: int, word: int) -> int:
        if word in self.next[last]:  # an earlier sequence has it already
            return self._split(last, word)
        new = self._state(self.length[last] + 1, 0, {})
        state = last
        while state >= 0 and word not in self.next[state]:
            self.next[state][word] = new
            state = self.link[state]
        if state >= 0:
            self.link[new] = self._split(state, word)
        return new

    def matches(self, words: Sequence[int], shortest: int) -> Iterator[tuple[int, int, int]]:
        """(end, length, state) of the stretches of ``shortest`` words or more that cannot grow to the right."""
        state = length = 0
        for i, word in enumerate(words):
            if length >= shortest and word not in self.next[state]:
                yield i, length, state
            while state and word not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            if word in self.next[state]:
                state = self.next[state][word]
                length += 1
        if length >= shortest:
            yield len(words), length, state


class Scanner:
    """Templates made ready: vocabulary, automaton and lengths.  Bounded by the templates, not by the corpus."""

    def __init__(self, templates: Mapping[str, str] | Sequence[tuple[str, str]], phrases: Mapping[str, str], shortest: int, gap: float):
        pairs = [(x, words_of(t)) for x, t in (templates.items() if isinstance(templates, Mapping) else templates)]
        pairs = [p for p in pairs if p[1]]
        self.labels, texts = [x for x, _ in pairs], [t for _, t in pairs]
        known = [words_of(p) for p in phrases]
        vocabulary = {w: i for i, w in enumerate(dict.fromkeys(w for t in texts + known for w in t))}
        self.vocabulary = list(vocabulary)
        self.sizes = [len(t) for t in texts]
        self.automaton = Automaton([[vocabulary[w] for w in t] for t in texts])
        self.phrases = [([vocabulary[w] for w in p], label) for p, label in zip(known, phrases.values())]
        self.shortest = shortest
        self.gaps = [max(LEAST_GAP, round(gap * n)) for n in self.sizes]

    def spans(self, words: np.ndarray) -> list[tuple[int, int, int, int]]:
        """(template, first word, end, template words covered) of the chains in a document's word numbers."""
        known = np.concatenate([[False], words >= 0, [False]])
        edges = np.flatnonzero(known[1:] != known[:-1]).reshape(-1, 2)
        # per template the chains that may still grow, and the finished ones: [first, end, template end, covered]
        chains: dict[int, list[list[int]]] = defaultdict(list)
        finished: list[tuple[int, int, int, int]] = []
        for lo, hi in edges[edges[:, 1] - edges[:, 0] >= self.shortest].tolist():
            for end, length, state in self.automaton.matches(words[lo:hi].tolist(), self.shortest):
                start, end = lo + end - length, lo + end
                for template, t_end in self.automaton.seen(state):
                    made, reach = chains[template], start - self.gaps[template]
                    if any(c[1] < reach for c in made):  # matches start ever later, so these grow no more
                        finished += [(template, c[0], c[1], c[3]) for c in made if c[1] < reach]
                        made[:] = [c for c in made if c[1] >= reach]
                    self._chain(made, start, end, t_end, length)
        return finished + [(t, c[0], c[1], c[3]) for t, made in chains.items() for c in made]

    def _chain(self, made: list[list[int]], start: int, end: int, t_end: int, length: int) -> None:
        """Grow the best chain that this match follows, or begin one."""
        best, gain = None, 0
        for c in made:
            fresh = length - max(0, c[1] - start, c[2] - (t_end - length))
            if end > c[1] and t_end > c[2] and fresh > 0 and c[3] + fresh > gain:
                best, gain = c, c[3] + fresh
        if best is None:
            made.append([start, end, t_end, length])
        else:
            best[1:] = [end, t_end, gain]


SPAN = "array<struct<label:string,first_word:bigint,end_word:bigint,covered:double>>"


def scan_licenses(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    templates: Mapping[str, str] | DataFrame = TEMPLATES,
    phrases: Mapping[str, str] = PHRASES,
    shortest: int = 4,
    gap: float = 0.6,
    covered: float = 0.8,
) -> DataFrame:
    """Per row: key, ``n_words``, ``n_base``, ``first_word``, ``last_word``, ``base_labels``, ``labels``, ``score``, ``spans``.

    ``n_base`` counts the places where a phrase's words stand together, words
    counted from 0.  ``spans`` lists the chains that cover the share ``covered``
    of a template or more, with the words they reach over; the words between
    two matches of a chain are at most the share ``gap`` of the template's.
    Their labels join the phrases' in ``labels``.  ``score`` is the largest share of a template
    found, and 1 where a phrase stands.  Null and empty texts have no words,
    score 0 and null places; every row is judged by itself, and other columns
    are not read.  ``templates`` maps labels to texts, or is a table with columns
    ``label`` and ``text`` of at most ``MOST_TEMPLATES`` rows; texts of one label are templates of
    their own.
    """
    spark = docs.sparkSession
    if isinstance(templates, DataFrame):
        templates = [(r["label"], r["text"] or "") for r in fetch_small(templates.select("label", "text"), MOST_TEMPLATES, "licence templates")]
    scanner = spark.sparkContext.broadcast(Scanner(templates, phrases, shortest, gap))  # as large as the templates
    table = byte_table(NOT_ALNUM)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = scanner.value
        vocabulary = pa.array(s.vocabulary, pa.large_string())
        for batch in byte_slices(batches, "text"):
            at, words = split_words(batch.column("text"), table)
            ids = pc.fill_null(pc.index_in(words.cast(pa.large_string()), value_set=vocabulary), -1).to_numpy(zero_copy_only=False)
            rows = defaultdict(list)
            for i in range(batch.num_rows):
                own = ids[at[i] : at[i + 1]]
                places, base = [], set()
                for phrase, label in s.phrases:
                    n = len(own) - len(phrase) + 1
                    if n > 0:
                        here = own[:n] == phrase[0]
                        for j in range(1, len(phrase)):
                            here &= own[j : j + n] == phrase[j]
                        if found := np.flatnonzero(here).tolist():
                            places += found
                            base.add(label)
                shares = [(t, a, b, min(1.0, c / s.sizes[t])) for t, a, b, c in s.spans(own)]
                spans = sorted((a, b, s.labels[t], x) for t, a, b, x in shares if x >= covered)
                rows["n_words"].append(len(own))
                rows["n_base"].append(len(places))
                rows["first_word"].append(min(places, default=None))
                rows["last_word"].append(max(places, default=None))
                rows["base_labels"].append(",".join(sorted(base)))
                rows["labels"].append(",".join(sorted(base | {label for _, _, label, _ in spans})))
                rows["score"].append(1.0 if base else max((x for _, _, _, x in shares), default=0.0))
                rows["spans"].append([{"label": n, "first_word": a, "end_word": b, "covered": x} for a, b, n, x in spans])
            kinds = {c: pa.int64() for c in ("n_words", "n_base", "first_word", "last_word")}
            kinds |= {"base_labels": pa.string(), "labels": pa.string(), "score": pa.float64()}
            kinds["spans"] = pa.list_(pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("end_word", pa.int64()), ("covered", pa.float64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(rows[c], kind) for c, kind in kinds.items()]], ["key", *kinds]
            )

    picked = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    kind = picked.schema["key"].dataType.simpleString()
    out = picked.mapInArrow(
        run,
        f"key {kind}, n_words bigint, n_base bigint, first_word bigint, last_word bigint, "
        f"base_labels string, labels string, score double, spans {SPAN}",
    )
    return out.withColumnRenamed("key", key)
