"""License scan by template-markup matching.

A template is mandatory wording with marked regions: [[ ... ]] is optional, and {{n}} is replaceable
by up to n words of any kind. A template is compiled to a token automaton: states are places in
the wording, an edge reads one token, skips an optional region or takes a word for a
replaceable one. A text is accepted where the automaton goes from its start to its end over
consecutive words, so all mandatory words stand there exactly. Texts are read as 64-bit word hashes, and
automata run only from places where a template's first words stand.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ledgerline.llm import kernels

#: Fixed by the results' definition: phrases whose places are counted, and their labels.
PHRASES = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)

#: Notices and the opening wording of common licenses, with markup.
TEMPLATES = (
    ("released under the [[terms of the]] mit license", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files [[the software]] to deal in the software without restriction", "mit"),
    ("licensed under the apache license [[as published by the apache software foundation]] version 2 0", "apache-2"),
    ("licensed under [[the]] [[creative commons]] cc by nc {{2}}", "cc-by-nc"),
    ("creative commons attribution noncommercial [[{{2}} international]]", "cc-by-nc"),
    ("licensed under [[the]] cc by {{1}} 0", "cc-by"),
    ("licensed under the [[terms of the]] gnu [[lesser]] general public license [[as published by the free software foundation]] [[either]] version {{1}}", "gpl"),
    ("this {{3}} is free software you can redistribute it and or modify it under the terms of the gnu [[lesser]] general public license", "gpl"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "bsd"),
    ("this source code form is subject to the terms of the mozilla public license v 2 0", "mpl-2"),
)


def word_hashes(text: str) -> list[int]:
    data = np.frombuffer(text.encode(), np.uint8)
    return [int(h) for h in kernels.words(data, np.array([0, len(data)]), kernels.WORD).hash]


@dataclass(frozen=True)
class Automaton:
    """States 0 .. n; reads[s]: the hash that leads from s to s + 1 (0: any word); skips[s]: states that s also stands for."""

    label: str
    reads: tuple[int, ...]
    skips: tuple[tuple[int, ...], ...]
    mandatory: tuple[int, ...]  # mandatory words before each state

    def closure(self, states: set[int]) -> set[int]:
        found, todo = set(states), list(states)
        while todo:
            for s in self.skips[todo.pop()]:
                if s not in found:
                    found.add(s)
                    todo.append(s)
        return found

    def run(self, hashes: list[int], at: int) -> tuple[bool, float]:
        """Whether the words from `at` on are accepted, and the largest share of the mandatory words that was read."""
        end, states, share, total = len(self.reads), self.closure({0}), 0, max(1, self.mandatory[-1])
        while states and end not in states and at < len(hashes):
            states = self.closure({s + 1 for s in states if self.reads[s] in (0, hashes[at])})
            share = max([share, *(self.mandatory[s] for s in states)])
            at += 1
        return end in states, share / total

    def first_words(self) -> list[int]:
        return [self.reads[s] for s in self.closure({0}) if s < len(self.reads)]


def compile_template(template: str, label: str) -> Automaton:
    reads: list[int] = []
    mandatory, skips, open_ = [0], {}, []
    for mark in re.findall(r"\[\[|\]\]|\{\{\d+\}\}|[^\s\[\]{}]+", template):
        if mark == "[[":
            open_.append(len(reads))
        elif mark == "]]":
            skips.setdefault(open_.pop(), []).append(len(reads))
        else:
            many = re.fullmatch(r"\{\{(\d+)\}\}", mark)
            for word in [0] * int(many[1]) if many else word_hashes(mark):
                if many:
                    skips.setdefault(len(reads), []).append(len(reads) + 1)
                reads.append(word)
                mandatory.append(mandatory[-1] + (not many and not open_))
    return Automaton(label, tuple(reads), tuple(tuple(skips.get(s, ())) for s in range(len(reads) + 1)), tuple(mandatory))


def scan_licenses(documents: DataFrame, phrases=PHRASES, templates=TEMPLATES, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    Base: places where a phrase's words stand one after the other. labels adds those of accepted
    templates. score: 1 with a label, else the largest share of a template's mandatory words that an
    automaton read before it stopped. A null or empty text has no words, no places, empty
    labels and score 0; repeated rows have one result each.
    """
    wanted = [(word_hashes(p), label) for p, label in phrases]
    automata = [compile_template(t, label) for t, label in templates]
    longest = max(len(a.reads) for a in automata)
    starters = np.array(sorted({w for a in automata for w in a.first_words()}), np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data, bounds in kernels.text_slices(batch.column(1)):
                rows = len(bounds) - 1
                found = kernels.words(data, bounds, kernels.WORD)
                counts = np.bincount(found.row, minlength=rows)
                begin = np.cumsum(counts) - counts
                n_base, low, high = np.zeros(rows, np.int64), np.full(rows, 2**62), np.full(rows, -1)
                labels: list[set[str]] = [set() for _ in range(rows)]
                score = np.zeros(rows)
                for phrase, label in wanted:
                    at = np.flatnonzero(found.hash == np.uint64(phrase[0]))
                    at = at[at + len(phrase) <= len(found.hash)]
                    for k, word in enumerate(phrase):
                        at = at[(found.hash[at + k] == np.uint64(word)) & (found.row[at + k] == found.row[at])]
                    of, place = found.row[at], at - begin[found.row[at]]
                    n_base += np.bincount(of, minlength=rows)
                    np.minimum.at(low, of, place)
                    np.maximum.at(high, of, place)
                    for i in set(of.tolist()):
                        labels[i].add(label)
                base = [",".join(sorted(x)) for x in labels]
                for at in np.flatnonzero(np.isin(found.hash, starters)).tolist():
                    row = int(found.row[at])
                    hashes = found.hash[at : min(at + longest, int(begin[row] + counts[row]))].tolist()
                    for a in automata:
                        accepted, share = a.run(hashes, 0)
                        score[row] = max(score[row], share)
                        if accepted:
                            labels[row].add(a.label)
                score[[i for i, x in enumerate(labels) if x]] = 1.0
                none = n_base == 0
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, rows),
                        pa.array(counts.astype(np.int64)),
                        pa.array(n_base),
                        pa.array(low, mask=none),
                        pa.array(high, mask=none),
                        pa.array(base),
                        pa.array([",".join(sorted(x)) for x in labels]),
                        pa.array(score),
                    ],
                    ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"],
                )

    kept = documents.select(documents[doc_id].alias("doc_id"), documents[text].alias("text"))
    return kept.mapInArrow(run, f"doc_id {dict(kept.dtypes)['doc_id']}, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double")
