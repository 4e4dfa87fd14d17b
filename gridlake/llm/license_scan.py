"""License notices in texts: MinHash bands over overlapping windows retrieve templates, exact containment verifies them.

A template is a set of shingles of five words; a notice of fewer words is one shingle of its own length, and is looked for
word by word. Other templates are classed by size, and each class has windows that are long
enough, and overlap far enough, to hold a whole template of it somewhere. Windows and templates get one MinHash value a
band; a window is compared with the templates that it shares a band with. A window that holds the asked share of a template
of its class resembles it at least by `least_similarity`, and the number of bands follows from that and the asked
probability: bands = ln(1 - probability) / ln(1 - least similarity).

Finds of short notices neither displace longer ones nor give way to them.

A text without a word of `anchors` can't hold enough of any template and is passed over, which loses nothing.

Only DataFrame functions, all within the row: no shuffle, no join. Templates are a parameter of a few dozen entries and
become literals.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlake.llm.common import with_type
from gridlake.llm.pii import let

WORDS = 5
CONTAINMENT = 0.8
PROBABILITY = 0.999
MOST_TEMPLATES = 500

# Notices as their licenses word them.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("LGPL", "under the terms of the GNU Lesser General Public License"),
    ("AGPL-3.0", "under the terms of the GNU Affero General Public License"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
)
SHORT_TEMPLATES = (("All-Rights-Reserved", "All rights reserved."),)
NOTICES = TEMPLATES + SHORT_TEMPLATES


def words_of(text: str) -> list[str]:
    return re.findall(r"[^\W_]+", text.lower())


def shingles_of(text: str) -> list[str]:
    """Runs of five words; fewer words are one shingle."""
    words = words_of(text)
    return sorted({" ".join(words[i : i + WORDS]) for i in range(max(0, len(words) - WORDS) + 1)}) if words else []


def least_similarity(size: int, width: int, containment: float) -> float:
    """Jaccard similarity that a window of `width` shingles has at least with a template of `size` that it holds."""
    held = math.ceil(size * containment - 1e-9)
    return held / (width + size - held)


@dataclass(frozen=True)
class Kind:
    """Templates of `low` to `high` shingles, and windows for them."""

    low: int
    high: int

    @property
    def stride(self) -> int:
        return max(1, self.high // 2)

    @property
    def width(self) -> int:
        return self.high + self.stride - 1

    def bands(self, containment: float, probability: float) -> int:
        similarity = min(least_similarity(size, self.width, containment) for size in range(self.low, self.high + 1))
        return 1 if similarity == 1 else math.ceil(math.log(1 - probability) / math.log(1 - similarity))


def kinds(sizes: list[int]) -> list[Kind]:
    """Classes by powers of two, those that have templates."""
    found = {max(0, math.ceil(math.log2(s))) for s in sizes}
    return [Kind(2 ** (k - 1) + 1 if k else 1, 2**k) for k in sorted(found)]


def anchors(templates, containment: float = CONTAINMENT) -> list[str]:
    """Words of which every text that holds enough of a template has one.

    Whoever has the asked share of a template's shingles has one of any set of more than the rest of them. So words are
    chosen, long ones before short ones, until the shingles with a chosen word are that many in each template.
    """
    left = []
    for _, text in templates:
        shingles = [set(s.split()) for s in shingles_of(text)]
        left.append((shingles, len(shingles) - math.ceil(len(shingles) * containment - 1e-9) + 1))
    out: list[str] = []

    def gain(word: str) -> tuple:
        met = sum(min(need, sum(word in s for s in shingles)) for shingles, need in left)
        return met if len(word) >= 7 else met / 100, len(word), word

    while left:
        best = max({w for shingles, _ in left for s in shingles for w in s}, key=gain)
        out.append(best)
        left = [([s for s in shingles if best not in s], need - sum(best in s for s in shingles)) for shingles, need in left]
        left = [(shingles, need) for shingles, need in left if need > 0]
    return sorted(out)


def _hash(x: Column, band: int) -> Column:
    return F.xxhash64(x, F.lit(band))


def _signatures(spark, templates, bands: int) -> list[tuple[list[int], list[int]]]:
    """Shingle hashes and MinHash values of each template, by the same functions as in the texts."""
    frame = spark.createDataFrame([(i, shingles_of(text)) for i, (_, text) in enumerate(templates)], "i int, s array<string>")
    hashed = frame.select("i", F.transform("s", lambda x: F.xxhash64(x)).alias("h"))
    values = hashed.select("i", "h", F.array(*[F.array_min(F.transform("h", _banded(b))) for b in range(bands)]).alias("m"))
    return [(list(r.h), list(r.m)) for r in values.orderBy("i").collect()]


def _banded(band: int):
    return lambda x: _hash(x, band)


def scan(
    docs: DataFrame, templates=NOTICES, containment: float = CONTAINMENT, probability: float = PROBABILITY
) -> DataFrame:
    """The rows of `docs` with `licenses`: array of (license, begin, end, share) by begin; places are numbers of words.

    A notice is found where at least `containment` of a template's shingles stand within a window of its class; begin is
    the first word of its first shingle there, end follows the last word of its last. Overlapping finds of one license
    are one; a find that overlaps one of a higher share goes. A template of less than five words is found where all its
    words stand in a row, unless a longer find of the same license covers part of them. Words are runs of letters and
    digits in lower case. Null and empty texts have none. Repeated rows get the same answer; a column of `docs` called
    licenses is replaced; an empty table gives an empty result. Templates without a word are refused.
    """
    templates = list(templates)
    if len(templates) > MOST_TEMPLATES:
        raise ValueError(f"more than {MOST_TEMPLATES} templates: they become literals of the plan")
    if not all(words_of(text) for _, text in templates):
        raise ValueError("a template needs a word at least")
    text = F.lower(F.coalesce(with_type(docs, "text", "string"), F.lit("")))
    none = F.array().cast("array<struct<license:string,begin:int,end:int,share:double>>")
    if not templates:
        return docs.withColumn("licenses", none)
    wanted = anchors(templates, containment)
    short = sorted({(name, *words_of(text)) for name, text in templates if len(words_of(text)) < WORDS})
    templates = [(name, text) for name, text in templates if len(words_of(text)) >= WORDS]
    sizes = [len(shingles_of(text)) for _, text in templates]
    classes = kinds(sizes)
    bands = max((kind.bands(containment, probability) for kind in classes), default=0)
    signatures = _signatures(docs.sparkSession, templates, bands)

    def finds(hashes: Column) -> Column:
        """All verified windows of all classes. The hashes of a band are made once for all windows."""
        values = F.array(*[F.transform(hashes, _banded(b)) for b in range(bands)])
        return let(values, lambda by_band: F.concat(*[_of_class(kind, hashes, by_band) for kind in classes]))

    def _of_class(kind: Kind, hashes: Column, by_band: Column) -> Column:
        own = [i for i, size in enumerate(sizes) if kind.low <= size <= kind.high]
        used = kind.bands(containment, probability)
        marks = {b: sorted({signatures[i][1][b] for i in own}) for b in range(used)}
        starts = F.sequence(F.lit(0), F.floor(F.greatest(F.size(hashes) - 1, F.lit(0)) / kind.stride).cast("int"))

        def least(start: Column, band: int) -> Column:
            return F.array_min(F.slice(F.get(by_band, F.lit(band)), start * kind.stride + 1, kind.width))

        def retrieved(start: Column) -> Column:
            hit = F.lit(False)
            for b in range(used):
                hit = hit | F.coalesce(least(start, b).isin(*marks[b]), F.lit(False))
            return hit

        def verified(start: Column) -> Column:
            window = F.slice(hashes, start * kind.stride + 1, kind.width)
            return F.array_compact(F.array(*[_verified(i, start, window) for i in own]))

        def _verified(i: int, start: Column, window: Column) -> Column:
            shared = F.lit(False)
            for b in range(used):
                shared = shared | F.coalesce(least(start, b) == F.lit(signatures[i][1][b]), F.lit(False))
            members = F.array(*[F.lit(h) for h in signatures[i][0]])

            def placed(part: Column) -> Column:
                held = F.size(F.array_intersect(part, members)) / F.lit(float(sizes[i]))
                at = F.filter(F.transform(part, lambda x, k: F.when(F.array_contains(members, x), k)), lambda k: k.isNotNull())
                begin = start * kind.stride + F.array_min(at)
                end = start * kind.stride + F.array_max(at) + WORDS
                row = F.struct(F.lit(templates[i][0]).alias("license"), begin.cast("int").alias("begin"), end.cast("int").alias("end"), held.alias("share"))
                return F.when(held >= containment - 1e-9, row)

            return F.when(shared, let(window, placed))

        return F.flatten(F.transform(F.filter(starts, retrieved), verified))

    def hashed(words: Column) -> Column:
        places = F.sequence(F.lit(1), F.size(words) - WORDS + 1)
        return F.transform(places, lambda i: F.xxhash64(F.array_join(F.slice(words, i, WORDS), " ")))

    def in_a_row(words: Column, name: str, notice: tuple[str, ...]) -> Column:
        """All places where a short notice stands."""

        def stands(i: Column) -> Column:
            fits = F.get(words, i) == F.lit(notice[0])
            for k, word in enumerate(notice[1:], 1):
                fits = fits & (F.get(words, i + k) == F.lit(word))
            return fits

        def row(i: Column) -> Column:
            return F.struct(F.lit(name).alias("license"), i.cast("int").alias("begin"), (i + len(notice)).cast("int").alias("end"), F.lit(1.0).alias("share"))

        return F.transform(F.filter(F.sequence(F.lit(0), F.size(words)), stands), row)

    def of_words(words: Column) -> Column:
        long = F.when(F.size(words) >= WORDS, let(hashed(words), finds)) if templates else none
        long = let(F.array_sort(F.array_distinct(F.coalesce(long, none)), _earlier), _joined)
        if not short:
            return long
        brief = F.concat(*[in_a_row(words, name, tuple(notice)) for name, *notice in short])
        return let(long, lambda a: let(let(F.array_sort(F.array_distinct(brief), _earlier), _joined), lambda b: _with_short(a, b)))

    found = F.when(F.rlike(text, F.lit("|".join(map(re.escape, wanted)))), let(F.regexp_extract_all(text, F.lit(r"[\p{L}\p{N}]+"), F.lit(0)), of_words))
    return docs.withColumn("licenses", F.coalesce(found, none))


def _earlier(a: Column, b: Column) -> Column:
    """By license, then begin, then end."""
    out = F.lit(0)
    for name in ("end", "begin", "license"):
        out = F.when(a[name] < b[name], -1).when(a[name] > b[name], 1).otherwise(out)
    return out


def _joined(finds: Column) -> Column:
    """Overlapping finds of one license as one, then all by begin."""

    def add(kept: Column, find: Column) -> Column:
        last = F.get(kept, F.size(kept) - 1)
        same = (F.size(kept) > 0) & (last.license == find.license) & (find.begin < last.end)
        both = F.struct(last.license.alias("license"), last.begin.alias("begin"), F.greatest(last.end, find.end).alias("end"), F.greatest(last.share, find.share).alias("share"))
        return F.when(same, F.concat(F.slice(kept, F.lit(1), F.size(kept) - 1), F.array(both))).otherwise(F.concat(kept, F.array(find)))

    merged = F.aggregate(finds, F.array().cast("array<struct<license:string,begin:int,end:int,share:double>>"), add)

    def best(all_: Column) -> Column:
        """Without those that overlap a find of a higher share: versions of a license differ in a few shingles."""
        return F.filter(all_, lambda a: ~F.exists(all_, lambda b: (b.begin < a.end) & (b.end > a.begin) & (b.share > a.share)))

    return F.array_sort(let(merged, best), _by_place)


def _by_place(a: Column, b: Column) -> Column:
    return F.when(a.begin < b.begin, -1).when(a.begin > b.begin, 1).when(a.license < b.license, -1).when(a.license > b.license, 1).otherwise(0)


def _with_short(finds: Column, short: Column) -> Column:
    """Both by begin; a short notice that overlaps a find of its own license is part of that."""

    def covered(a: Column) -> Column:
        return F.exists(finds, lambda b: (b.license == a.license) & (b.begin < a.end) & (b.end > a.begin))

    return F.array_sort(F.concat(finds, F.filter(short, lambda a: ~covered(a))), _by_place)
