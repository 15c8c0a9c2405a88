"""License notices: an exact set-similarity join of text blocks with templates.

For a template of n words the text is cut into blocks of 2n words, each n words after the one
before, so that every passage of n + 1 words lies whole in one. Blocks and templates are sets of
(word, how many-th time it stands there), ordered from rare to frequent words over all documents.
A template of which o of n such pairs must be in the block shares one of its first n - o + 1 with
it, and that one is among the first |block| - o + 1 of the block's own. Only blocks and templates
that share such a prefix pair are joined; lengths and the places of what is shared then bound the
overlap, which is counted exactly for those that remain. In the survivors words must also stand in
the template's order: what counts is the longest common subsequence.

Where two notices are seen in the same words the one best contained wins, then the longer one.

Apart from that, fixed phrases are counted wherever they stand.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hindcast.llm.common import Scratch, column_or_null, kept, sliced, texts

# Phrases and their labels.
PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}
# Sentences of public license notices and their labels.
TEMPLATES = {
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
    "and associated documentation files, to deal in the Software without restriction": "mit",
    "Licensed under the Apache License, Version 2.0; you may not use this file except in "
    "compliance with the License": "apache",
    "This program is free software: you can redistribute it and/or modify it under the terms of "
    "the GNU General Public License as published by the Free Software Foundation": "gpl",
    "This library is free software; you can redistribute it and/or modify it under the terms of "
    "the GNU Lesser General Public License": "lgpl",
    "Redistribution and use in source and binary forms, with or without modification, are "
    "permitted provided that the following conditions are met": "bsd",
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
    "without fee is hereby granted": "isc",
    "This program is free software: you can redistribute it and/or modify it under the terms of "
    "the GNU Affero General Public License as published by the Free Software Foundation": "agpl",
    "This Source Code Form is subject to the terms of the Mozilla Public License": "mpl",
    "This is free and unencumbered software released into the public domain": "unlicense",
    "This work is licensed under a Creative Commons Attribution 4.0 International "
    "License": "cc-by",
    "Licensed under CC BY 4.0": "cc-by",
    "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International "
    "License": "cc-by-nc",
    "Licensed under CC BY-NC 4.0": "cc-by-nc",
    "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International "
    "License": "cc-by-nd",
    "Licensed under CC BY-ND 4.0": "cc-by-nd",
    "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International "
    "License": "cc-by-sa",
    "Licensed under CC BY-SA 4.0": "cc-by-sa",
    "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 "
    "International License": "cc-by-nc-nd",
    "Licensed under CC BY-NC-ND 4.0": "cc-by-nc-nd",
    "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 "
    "International License": "cc-by-nc-sa",
    "Licensed under CC BY-NC-SA 4.0": "cc-by-nc-sa",
}
#: Small letters, digits and all bytes of other characters; anything else separates words.
WORDS = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32
    for b in range(256)
)


def _words(text: bytes) -> list[bytes]:
    return text.translate(WORDS).split()


def _frequencies(docs: DataFrame, vocabulary: frozenset[bytes]) -> dict[bytes, int]:
    """How often each template word occurs in all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in sliced(batches):
            for text in texts(batch):
                counts.update(filter(vocabulary.__contains__, _words(text)))
        words = list(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(words, pa.binary()), pa.array([counts[w] for w in words], pa.int64())],
            ["word", "n"],
        )

    found = docs.select("text").mapInArrow(run, "word binary, n long")
    rows = found.groupBy("word").agg(F.sum("n").alias("n")).collect()  # a row per template word
    return {bytes(r["word"]): r["n"] for r in rows}


@dataclass
class _Class:
    """What tasks need to cut texts into blocks for the templates of one length."""

    n: int
    needed: int
    ids: dict[bytes, int]  # words of these templates, numbered over all templates
    starters: set[int]  # words with a pair in a prefix
    ranks: dict[tuple[int, int], int]  # (word, how many-th) to its place from rare to frequent


def scan(
    docs: DataFrame,
    *,
    threshold: float = 0.8,
    phrases: Mapping[str, str] = PHRASES,
    templates: Mapping[str, str] = TEMPLATES,
) -> DataFrame:
    """Per row: ``doc_id``, ``n_words``, ``n_base``, ``first_word``, ``last_word``,
    ``base_labels``, ``labels``, ``score``, ``matches``.

    ``matches`` are the notices seen: first word, word after the last, label, containment (the part
    of the template's words that stand there in its order; in each block the place that ends
    first). Notices are the same place if more than half of the shorter one's words are the
    other's too. ``score`` is 1 where a phrase stands, else the best containment that reaches the
    threshold, else 0. Null and empty texts have no words and labels, templates without words match
    nothing. Rows are documents of their own, also where ids repeat; an empty table gives an empty
    result.
    """
    said = [(label, _words(t.encode())) for t, label in templates.items()]
    said = [(label, words) for label, words in said if words]
    often = _frequencies(docs, frozenset(w for _, words in said for w in words))
    ids = {w: i for i, w in enumerate(sorted(often.keys() | {w for _, t in said for w in t}))}
    pairs = [(label, [ids[w] for w in words], _numbered([ids[w] for w in words])) for label, words in said]
    count = {i: often.get(w, 0) for w, i in ids.items()}
    order = sorted({p for *_, held in pairs for p in held}, key=lambda p: (count[p[0]], p))
    rank = {p: i for i, p in enumerate(order)}
    classes: dict[int, _Class] = {}
    prefixes, whole = [], []
    names = {i: w for w, i in ids.items()}
    for k, (_, words, held) in enumerate(pairs):
        n = len(words)
        needed = max(math.ceil(threshold * n - 1e-9), 1)
        kind = classes.setdefault(n, _Class(n, needed, {}, set(), {}))
        kind.ids.update((names[w], w) for w in words)
        kind.ranks.update((p, rank[p]) for p in held)
        ranks = sorted(rank[p] for p in held)
        whole.append((k, ranks))
        prefixes += [(n, ranks[i], k, i, needed) for i in range(n - needed + 1)]
        kind.starters.update(order[r][0] for r in ranks[: n - needed + 1])
    scratch = Scratch(docs.sparkSession, "licenses")
    with scratch:
        found = _scanned(
            docs, scratch, list(classes.values()), prefixes, whole,
            [(label, words) for label, words, _ in pairs], phrases,
        )
        return kept(found, "licenses-result")


def _scanned(
    docs: DataFrame, scratch: Scratch, classes: list[_Class], prefixes: list, whole: list,
    templates: list[tuple[str, list[int]]], phrases: Mapping[str, str],
) -> DataFrame:
    rows = docs.select(column_or_null(docs, "doc_id", "long"), "text")
    found = scratch.keep(
        rows.mapInArrow(
            lambda batches: _parsed(batches, classes, phrases),
            "row long, doc_id long, n_words long, n_base long, first_word long, last_word long, "
            "base_labels array<string>, "
            "blocks array<struct<n: int, start: long, held: array<int>, said: array<int>>>",
        )
    )
    # The templates are a parameter, so both tables are small whatever the documents.
    spark = docs.sparkSession
    prefix = spark.createDataFrame(prefixes, "n int, pair int, template int, i int, needed int")
    sets = spark.createDataFrame(whole, "template int, wanted array<int>")
    least = spark.createDataFrame([(c.n, c.needed) for c in classes], "n int, least int")
    blocks = found.select("row", F.explode("blocks").alias("b")).select("row", "b.*")
    heads = blocks.join(F.broadcast(least), "n").select(
        "row", "n", "start", "held", "said",
        F.posexplode(F.expr("slice(held, 1, size(held) - least + 1)")).alias("j", "pair"),
    )
    bound = F.least("i", "j") + 1 + F.least(F.expr("n - i - 1"), F.expr("size(held) - j - 1"))
    pairs = heads.join(F.broadcast(prefix), ["n", "pair"]).where(bound >= F.col("needed"))
    # A block and a template meet at each prefix pair they share; the first one stands for all.
    overlap = F.array_intersect("held", "wanted")
    pairs = pairs.join(F.broadcast(sets), "template").where(
        (F.size(overlap) >= F.col("needed")) & (F.element_at(overlap, 1) == F.col("pair"))
    )
    seen = pairs.select("row", "start", "template", "said", "needed").mapInArrow(
        lambda batches: _aligned(batches, templates),
        "row long, start long, end long, label string, n int, containment double",
    )
    seen = scratch.keep(seen.distinct())
    best = _best(seen, max((c.n for c in classes), default=1))
    matches = best.groupBy("row").agg(
        F.sort_array(F.collect_set(F.struct("start", "end", "label", "containment"))).alias("matches"),
        F.max("containment").alias("best"),
        F.collect_set("label").alias("own"),
    )
    nothing = F.array().cast("array<string>")
    labels = F.array_union("base_labels", F.coalesce("own", nothing))
    # Notices grow with the documents and are never broadcast.
    return found.join(matches.hint("merge"), "row", "left").select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join(F.array_sort("base_labels"), ",").alias("base_labels"),
        F.array_join(F.array_sort(labels), ",").alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
        "matches",
    )


def _best(seen: DataFrame, longest: int) -> DataFrame:
    """Notices that no better one is seen in the place of.

    A notice is at most two templates long, so those that meet it start in few cells of the text.
    """
    cell = 2 * longest
    mine = seen.withColumn("cell", F.expr(f"start DIV {cell}")).alias("m")
    others = seen.withColumn(
        "cell", F.explode(F.expr(f"sequence(start DIV {cell} - 1, (end - 1) DIV {cell})"))
    ).alias("o")
    better = F.expr(
        "o.containment > m.containment OR (o.containment = m.containment AND o.n > m.n)"
    )
    shared = F.expr("least(m.end, o.end) - greatest(m.start, o.start)")
    shorter = F.expr("least(m.end - m.start, o.end - o.start)")
    same = (F.col("m.row") == F.col("o.row")) & (F.col("m.cell") == F.col("o.cell"))
    return mine.join(others.hint("merge"), same & better & (2 * shared > shorter), "left_anti").drop("cell")


def _numbered(words: list[int]) -> list[tuple[int, int]]:
    """Each word with how many times it stood before."""
    seen: Counter = Counter()
    out = []
    for w in words:
        out.append((w, seen[w]))
        seen[w] += 1
    return out


def _common(said: Iterable[int], masks: Mapping[int, int], n: int) -> tuple[int, int]:
    """Length of the longest common subsequence with a template of n words, and after how many of
    the words said it is first reached. A zero in the row marks a word where the length grows."""
    full = row = (1 << n) - 1
    length = upto = 0
    for i, w in enumerate(said, 1):
        mask = masks.get(w)
        if mask is None:
            continue
        both = row & mask
        row = ((row + both) | (row - both)) & full
        if n - row.bit_count() > length:
            length, upto = n - row.bit_count(), i
    return length, upto


def _masks(words: list[int]) -> dict[int, int]:
    masks: dict[int, int] = {}
    for i, w in enumerate(words):
        masks[w] = masks.get(w, 0) | 1 << i
    return masks


def _aligned(
    batches: Iterator[pa.RecordBatch], templates: list[tuple[str, list[int]]]
) -> Iterator[pa.RecordBatch]:
    """Survivors whose words also stand in order, with the place where they do."""
    masks = [(_masks(words), _masks(words[::-1])) for _, words in templates]
    names = ["row", "start", "end", "label", "n", "containment"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.float64()]
    for batch in sliced(batches):
        out = []
        for r in batch.to_pylist():
            (label, words), (onward, back) = templates[r["template"]], masks[r["template"]]
            length, upto = _common(r["said"], onward, len(words))
            if length < r["needed"]:
                continue
            _, held = _common(r["said"][:upto][::-1], back, len(words))
            end = r["start"] + upto
            out.append((r["row"], end - held, end, label, len(words), length / len(words)))
        columns = zip(*out, strict=True) if out else [()] * len(names)
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)], names
        )


def _places(words: list[bytes], phrases: Mapping[str, str]) -> list[tuple[int, str]]:
    """Start and label of each place where a phrase's words stand one after the other."""
    found = []
    joined = b" " + b" ".join(words) + b" "
    for phrase, label in phrases.items():
        wanted = b" " + phrase.encode() + b" "
        at = number = counted = 0
        while (at := joined.find(wanted, at)) >= 0:
            number += joined.count(b" ", counted, at)
            counted = at
            found.append((number, label))
            at += 1
    return found


def _blocks(words: list[bytes], kind: _Class) -> Iterator[dict]:
    """Blocks with enough words of these templates, one of them of a prefix."""
    said = [kind.ids.get(w, -1) for w in words]
    if kind.starters.isdisjoint(said):
        return
    array, n = np.array(said), kind.n
    hits = np.flatnonzero(np.isin(array, list(kind.starters))) // n
    places = np.unique(np.concatenate([hits, hits[hits > 0] - 1])) * n
    known = np.concatenate([[0], np.cumsum(array >= 0)])
    ends = np.minimum(places + 2 * n, len(said))
    for start in places[known[ends] - known[places] >= kind.needed].tolist():
        here = said[start : start + 2 * n]
        held = [kind.ranks[p] for p in _numbered(here) if p in kind.ranks]
        if len(held) >= kind.needed:
            yield {"n": n, "start": start, "held": sorted(held), "said": here}


def _parsed(
    batches: Iterator[pa.RecordBatch], classes: list[_Class], phrases: Mapping[str, str]
) -> Iterator[pa.RecordBatch]:
    row = TaskContext.get().partitionId() << 40
    numbers = pa.list_(pa.int32())
    kinds = pa.list_(
        pa.struct([("n", pa.int32()), ("start", pa.int64()), ("held", numbers), ("said", numbers)])
    )
    for batch in sliced(batches):
        out = []
        for text in texts(batch):
            words = _words(text)
            places = _places(words, phrases)
            starts = [p for p, _ in places]
            out.append((
                len(words), len(places), min(starts, default=None), max(starts, default=None),
                sorted({label for _, label in places}),
                [b for kind in classes for b in _blocks(words, kind)],
            ))
        columns = list(zip(*out, strict=True))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(range(row, row + len(out)), pa.int64()),
                batch.column("doc_id"),
                *[pa.array(c, pa.int64()) for c in columns[:4]],
                pa.array(columns[4], pa.list_(pa.string())),
                pa.array(columns[5], kinds),
            ],
            ["row", "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "blocks"],
        )
        row += len(out)
