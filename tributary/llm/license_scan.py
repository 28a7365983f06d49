"""License scan: MinHash bands over overlapping windows retrieve templates, exact shingle containment verifies.

Words are runs of letters and digits, lower-cased. A template of w words has shingles of min(5, w) words. Its class is the
least power of two, 2^c, that is not below its number of shingles; windows of 2 * 2^c shingles start every 2^c shingles, so each
stretch as long as the template lies within a window. Window minima are the minima of two neighbouring blocks,
and blocks of 2^(c+1) are joined from blocks of 2^c, so each shingle is hashed ``bands`` times once.

A band is one minimum. If a window holds a share ``s`` of a template's n shingles, a band is equal with probability at
least J = s n / (2 * 2^c + (1 - s) n), so ``bands`` is set to make 1 - (1 - J)^bands at least ``recall`` for the worst template.
A retrieved template is verified by its own shingles, as words: containment of ``min_share`` or more in the window is a match. The orders of shingles that
give the minima are products with odd numbers of well mixed hashes, not a proved min-wise family; the tests measure the recall they give.
Templates are a list of at most ``MAX_TEMPLATES``, given as names and texts or as a table of them. Their bands are made once, on the driver, and travel with the task as one sorted array of minima with the template
of each; a window's minima are first looked up in a bitmap of their leading bits, and only those found there in the array, so the work of a text doesn't grow with the templates. Those built in are short public notices.

Defined results: a null or empty text has no match. A template without words, null or empty, matches nothing; a null name counts as the empty name; texts under one name are so many wordings of one licence. Without templates there is no match. The span of a match runs from the first to the last shingle found. Overlapping spans of one template
are merged; matches of one place are ordered by name; repeated rows are scanned alike. A long text is scanned in overlapping parts of ``BLOCK`` shingles, none is cut. An empty
table gives an empty result; extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator, Mapping
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

WORDS, MIN_SHARE, RECALL = 5, 0.8, 0.9999
BLOCK = 1 << 13
MAX_TEMPLATES, FEW = 20_000, 8
WORD = regex.compile(r"[\p{L}\p{N}]+(?:\.[\p{N}]+)*")
MULTIPLY = np.uint64(0x9E3779B97F4A7C15)

#: Wording of public licence notices.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "Apache-2.0-header": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at',
    "MIT": "Released under the MIT License",
    "MIT-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3",
    "GPL-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
    "BSD-clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "all-rights-reserved": "All rights reserved",
}


def words_of(text: str) -> tuple[list[str], list[tuple[int, int]]]:
    found = list(WORD.finditer(text))
    return [m[0].lower() for m in found], [m.span() for m in found]


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(27))


def word_hashes(words: list[str]) -> np.ndarray:
    known: dict[str, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))
    return np.fromiter((xxhash.xxh3_64_intdigest(w) for w in known), np.uint64, len(known))[ids]


def shingle_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """One hash per run of ``size`` words, from the hashes of words."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for k in range(size):
        out = out * MULTIPLY + hashes[k : k + n]
    return mixed(out)


@dataclass
class Template:
    name: str
    size: int  # words of a shingle
    words: list[str]
    count: int  # distinct shingles
    level: int  # class

    @classmethod
    def of(cls, name: str | None, text: str | None, words: int = WORDS) -> Template | None:
        """None for a text without words."""
        ws, _ = words_of(text or "")
        if not ws:
            return None
        size = min(words, len(ws))
        return cls(name or "", size, ws, len({tuple(ws[i : i + size]) for i in range(len(ws) - size + 1)}), max(0, (len(ws) - size).bit_length()))

    @cached_property
    def shingles(self) -> frozenset[tuple[str, ...]]:
        return frozenset(tuple(self.words[i : i + self.size]) for i in range(len(self.words) - self.size + 1))


def bands_for(templates: list[Template], share: float, recall: float) -> int:
    """Bands of one row each so that any window with ``share`` of a template collides with probability ``recall``."""
    least = min((share * t.count / (2 * (1 << t.level) + (1 - share) * t.count) for t in templates), default=1.0)
    return math.ceil(math.log(1 - recall) / math.log(1 - least)) if least < 1 else 1


class BandIndex:
    """The minima of templates of one class in order, each with its template, behind a bitmap of leading bits."""

    def __init__(self, minima: np.ndarray, templates: list[int]):
        self.few = list(zip(templates, minima, strict=True)) if len(templates) <= FEW else []  # a comparison each is quicker then
        values = minima.ravel()
        order = np.argsort(values, kind="stable")
        self.values = values[order]
        self.owner = np.repeat(np.array(templates, np.int32), minima.shape[1])[order]
        self.shift = np.uint64(64 - min(24, max(12, (16 * len(values)).bit_length())))
        self.bitmap = np.zeros(1 << (64 - int(self.shift)), bool)
        self.bitmap[(self.values >> self.shift).astype(np.int64)] = True

    def found(self, windows: np.ndarray) -> list[tuple[int, int]]:
        """(window, template), in order, where they have a minimum in common; ``windows``: (n, bands)."""
        if self.few:
            return sorted((w, t) for t, signature in self.few for w in np.flatnonzero((windows == signature).any(axis=1)).tolist())
        at = np.flatnonzero(self.bitmap[(windows >> self.shift).astype(np.int64)].ravel())
        if not len(at):
            return []
        some = windows.ravel()[at]
        low, high = np.searchsorted(self.values, some, "left"), np.searchsorted(self.values, some, "right")
        many = high - low
        ends = np.cumsum(many)
        owner = self.owner[np.arange(ends[-1]) + np.repeat(low - ends + many, many)]
        return sorted(set(zip(np.repeat(at // windows.shape[1], many).tolist(), owner.tolist(), strict=True)))


class Scanner:
    def __init__(self, templates: Mapping[str, str] | Iterable[tuple[str | None, str | None]], min_share: float = MIN_SHARE, recall: float = RECALL, words: int = WORDS):
        named = templates.items() if isinstance(templates, Mapping) else templates
        self.templates = [t for t in (Template.of(k, v, words) for k, v in named) if t]
        self.min_share = min_share
        self.bands = bands_for(self.templates, min_share, recall)
        rng = np.random.default_rng(11)
        self.odd = rng.integers(0, 1 << 63, self.bands, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        classes: dict[tuple[int, int], list[int]] = {}
        for i, t in enumerate(self.templates):
            classes.setdefault((t.size, t.level), []).append(i)
        signature = lambda t: self.minima(shingle_hashes(word_hashes(t.words), t.size), np.array([0]))
        self.index = {key: BandIndex(np.concatenate([signature(self.templates[i]) for i in rows]), rows) for key, rows in classes.items()}

    def minima(self, shingles: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """(blocks, bands) minima of the shingles from each start to the next."""
        return np.minimum.reduceat(shingles[:, None] * self.odd, starts, axis=0)

    def scan(self, text: str | None) -> list[tuple[str, int, int, float]]:
        """(template, start, end, containment), spans in code points."""
        words = [w.lower() for w in WORD.findall(text or "")]
        if not words:
            return []
        hashes = word_hashes(words)
        hits: dict[str, list[tuple[int, int, float]]] = {}
        for size in sorted({s for s, _ in self.index}):
            shingles = shingle_hashes(hashes, size)
            if len(shingles):
                self._scan_size(size, shingles, words, hits)
        if not hits:
            return []
        out, spans = [], words_of(text)[1]
        for name, found in hits.items():
            best: list[list] = []
            for first, last, share in sorted(found):
                if best and first <= best[-1][1]:
                    best[-1][1], best[-1][2] = max(last, best[-1][1]), max(share, best[-1][2])
                else:
                    best.append([first, last, share])
            out += [(name, spans[a][0], spans[b][1], share) for a, b, share in best]
        return sorted(out, key=lambda m: (m[1], m[2], m[0]))

    def _scan_size(self, size: int, shingles: np.ndarray, words: list[str], hits: dict) -> None:
        levels = {level: index for (s, level), index in self.index.items() if s == size}
        low, high = min(levels), max(levels)
        for at in range(0, len(shingles), BLOCK):
            part = shingles[at : at + BLOCK + (4 << high)]  # windows across the cut lie wholly in the left part
            blocks = self.minima(part, np.arange(0, len(part), 1 << low))
            for level in range(low, high + 1):
                if level > low:
                    if len(blocks) % 2:
                        blocks = np.concatenate([blocks, blocks[-1:]])
                    blocks = np.minimum(blocks[::2], blocks[1::2])
                if level in levels:
                    window = np.minimum(blocks, np.concatenate([blocks[1:], blocks[-1:]]))
                    for w, t in levels[level].found(window):
                        self._verify(self.templates[t], at + (w << level), 2 << level, words, hits)

    def _verify(self, t: Template, first: int, width: int, words: list[str], hits: dict) -> None:
        last = min(first + width, len(words) - t.size + 1)
        places: dict[tuple[str, ...], int] = {}
        spots = []
        for i in range(first, last):
            s = tuple(words[i : i + t.size])
            if s in t.shingles:
                places.setdefault(s, i)
                spots.append(i)
        share = len(places) / t.count
        if share >= self.min_share:
            hits.setdefault(t.name, []).append((spots[0], spots[-1] + t.size - 1, share))


def templates_of(table: DataFrame) -> list[tuple[str | None, str | None]]:
    """Templates from a table (name, text); more than ``MAX_TEMPLATES`` are an error."""
    rows = table.select("name", "text").limit(MAX_TEMPLATES + 1).collect()
    if len(rows) > MAX_TEMPLATES:
        raise ValueError(f"more than {MAX_TEMPLATES} templates")
    return [(r["name"], r["text"]) for r in rows]


def scan(docs: DataFrame, templates: Mapping[str, str] | DataFrame | None = None, min_share: float = MIN_SHARE) -> DataFrame:
    """One row per match: (doc_id, license, start, end, containment)."""
    scanner = Scanner(TEMPLATES if templates is None else templates_of(templates) if isinstance(templates, DataFrame) else templates, min_share)
    shared = docs.sparkSession.sparkContext.broadcast(scanner)  # at most ``MAX_TEMPLATES`` texts and their minima

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = shared.value
        for batch in batches:
            rows = [(doc, *m) for doc, t in zip(batch.column(0).to_pylist(), batch.column(1), strict=True) for m in scanner.scan(t.as_py())]
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True) if rows else [[]] * 5, kinds, strict=True)], ["doc_id", "license", "start", "end", "containment"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, license string, start long, end long, containment double")


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents")).withColumn("containment", F.round("containment", 6))


QUERIES = {"op3_license_scan": op3_license_scan}
ORACLE_SQL: dict[str, str] = {}
