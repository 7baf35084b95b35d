"""Operator 7, licence scans by an exact set-similarity join.

Every text is cut into blocks of ``BLOCK`` words, or twice the words of a longer template, that
overlap by half, so a stretch as long as the template lies whole in some block. A block matches a template if it holds at least
``CONTAINMENT`` of the template's distinct words. The join is exact and filtered:

- prefix: words are ordered by how often they occur in all documents, the rarest first. A
  block that meets the threshold holds one of the template's first n - need + 1 words, so
  only places of those words make candidates;
- length: a block with fewer words than needed is out;
- position: a block whose first prefix word has rank i can hold at most n - i of the words.

Candidates are then checked on the full word sets. The base phrases go through the same join
with containment 1; places where their words stand consecutively are read from the blocks
that pass. Templates are a fixed list, so what travels to the tasks is bounded; the word
frequencies are one sum for each template word.

Defined cases: a null text is empty and gives no label; a phrase is found across line breaks;
repeated rows get equal results; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changelake.llm import kernels as K
from changelake.llm.decontaminate import lowered_words
from changelake.llm.store import table

CONTAINMENT = 0.8
#: Words of a block, for templates of at most half as many words.
BLOCK = 128
#: The base phrases and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: Passages of public licence texts, by label.
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                  "compliance with the License. You may obtain a copy of the License at",
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
           "documentation files (the \"Software\"), to deal in the Software without restriction",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
           "the following conditions are met",
    "gpl": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
           "Public License as published by the Free Software Foundation",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
           "granted, provided that the above copyright notice and this permission notice appear in all copies",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
               "was not distributed with this file, You can obtain one at",
    "cc-by": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "unlicense": "This is free and unencumbered software released into the public domain",
}
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def _words(text: str) -> list[bytes]:
    return _WORD.findall(text.encode().lower())


class Templates:
    """Templates and phrases as sets of term numbers, with the term fingerprints."""

    def __init__(self, templates: dict[str, str], phrases: dict[str, str]):
        self.labels = [*templates, *phrases.values()]
        self.sequences = [_words(t) for t in (*templates.values(), *phrases)]
        self.is_phrase = [False] * len(templates) + [True] * len(phrases)
        spelled = sorted({w for s in self.sequences for w in s})
        prints, _ = lowered_words(*K.texts_of(pa.array([" ".join(w.decode() for w in spelled)])))
        order = np.argsort(prints)
        self.terms = prints[order]
        number = {spelled[k]: i for i, k in enumerate(order)}
        self.numbers = [np.array([number[w] for w in s], np.int64) for s in self.sequences]

    def ordered(self, frequency: np.ndarray, containment: float) -> None:
        """Sets by rising global frequency, the words needed, and the prefixes."""
        self.sets, self.need, self.rank = [], [], []
        for n, phrase in zip(self.numbers, self.is_phrase):
            distinct = np.unique(n)
            distinct = distinct[np.lexsort((distinct, frequency[distinct]))]
            need = len(distinct) if phrase else int(np.ceil(containment * len(distinct) - 1e-9))
            rank = np.full(len(self.terms), -1)
            prefix = distinct[:len(distinct) - need + 1]
            rank[prefix] = np.arange(len(prefix))
            self.sets.append(distinct)
            self.need.append(need)
            self.rank.append(rank)


def _term_numbers(prints: np.ndarray, terms: np.ndarray) -> np.ndarray:
    at = np.minimum(np.searchsorted(terms, prints), len(terms) - 1)
    return np.where(terms[at] == prints, at, -1)


def _frequencies(terms: np.ndarray):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(terms), np.int64)
        for batch in batches:
            data, starts = K.texts_of(batch.column(0))
            for i, j in K.slices(starts):
                prints, _ = lowered_words(data[starts[i]:starts[j]], starts[i:j + 1] - starts[i])
                number = _term_numbers(prints, terms)
                total += np.bincount(number[number >= 0], minlength=len(terms))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(terms), dtype=np.int32)), pa.array(total)], names=["term", "n"])

    return task


def _blocks_holding(number: np.ndarray, offsets: np.ndarray, t: Templates, k: int, block: int) -> tuple[np.ndarray, np.ndarray]:
    """First words of the blocks that meet template ``k``, and the share of it they hold."""
    rank = t.rank[k][number]
    rank[number < 0] = -1
    at = np.flatnonzero(rank >= 0)
    if not len(at):
        return at, np.zeros(0)
    half = block // 2
    text = np.searchsorted(offsets, at, side="right") - 1
    inside = (at - offsets[text]) // half
    # blocks start at every half; a word lies in the one that starts in its half and the one before
    text, first, own = np.concatenate([text, text]), np.concatenate([inside, inside - 1]), np.concatenate([rank[at], rank[at]])
    text, first, own = text[first >= 0], first[first >= 0], own[first >= 0]
    begin = offsets[text] + first * half
    pairs = np.lexsort((own, begin))
    begin, text, own = begin[pairs], text[pairs], own[pairs]
    lead = np.flatnonzero(np.concatenate([[True], np.diff(begin) != 0]))
    begin, text, own = begin[lead], text[lead], own[lead]  # least rank of each block
    size, need = len(t.sets[k]), t.need[k]
    end = np.minimum(begin + block, offsets[text + 1])
    good = (end - begin >= need) & (size - own >= need)
    begin, end = begin[good], end[good]
    place, owner = K.expand(begin, end - begin)
    found = number[place]
    seen = np.zeros((len(begin), len(t.terms) + 1), bool)
    seen[owner, found] = True  # -1 falls into the last column
    share = seen[:, t.sets[k]].sum(axis=1) if len(begin) else np.zeros(0)
    keep = share >= need
    return begin[keep], share[keep] / size


def _scan(t: Templates, block: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, starts = K.texts_of(batch.column(1))
            rows = []
            for i, j in K.slices(starts):
                prints, offsets = lowered_words(data[starts[i]:starts[j]], starts[i:j + 1] - starts[i])
                number = _term_numbers(prints, t.terms)
                places = [set() for _ in range(i, j)]
                base = [set() for _ in range(i, j)]
                labels = [set() for _ in range(i, j)]
                score = np.zeros(j - i)
                for k, label in enumerate(t.labels):
                    size = max(block, 2 * len(t.numbers[k]))
                    begin, share = _blocks_holding(number, offsets, t, k, size)
                    text = np.searchsorted(offsets, begin, side="right") - 1
                    if not t.is_phrase[k]:
                        np.maximum.at(score, text, share)
                        for d in text.tolist():
                            labels[d].add(label)
                        continue
                    words = t.numbers[k]
                    for b, d in zip(begin.tolist(), text.tolist()):
                        part = number[b:min(b + size, offsets[d + 1])]
                        at = np.arange(len(part) - len(words) + 1)
                        for c, w in enumerate(words):
                            at = at[part[at + c] == w]
                        if len(at):
                            score[d] = 1.0
                            base[d].add(label)
                            places[d].update((k, int(b + x - offsets[d])) for x in at)
                sizes = np.diff(offsets).tolist()
                for d in range(j - i):
                    starts_at = [p for _, p in places[d]]
                    rows.append((sizes[d], len(starts_at), min(starts_at, default=None), max(starts_at, default=None),
                                 ",".join(sorted(base[d])), ",".join(sorted(base[d] | labels[d])), float(score[d])))
            cols = list(zip(*rows)) if rows else [()] * 7
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(cols, kinds))],
                                             names=["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"])

    return task


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: dict[str, str] | None = None,
         phrases: dict[str, str] | None = None, containment: float = CONTAINMENT, block: int = BLOCK) -> DataFrame:
    """doc_id, n_words, places and labels of the phrases, labels of both, and the greatest
    share of a template that a block holds (1 where a phrase stands, 0 where nothing does)."""
    t = Templates(TEMPLATES if templates is None else templates, PHRASES if phrases is None else phrases)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    frequency = np.zeros(len(t.terms), np.int64)
    counted = texts.select("text").mapInArrow(_frequencies(t.terms), "term int, n long")
    for term, n in counted.groupBy("term").agg(F.sum("n").alias("n")).collect():  # a row for each template word
        frequency[term] = n
    t.ordered(frequency, containment)
    return texts.mapInArrow(_scan(t, block), "doc_id long, n_words long, n_base long, first_word long, last_word long, "
                                             "base_labels string, labels string, score double")


def query(spark, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))
