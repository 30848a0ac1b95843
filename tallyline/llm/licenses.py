"""Licence notices in documents, found by MinHash bands over overlapping windows.

Templates of one length form a class with its own windows: as long as the template and the
step together, so that some window holds every whole occurrence. Window and template are
compared by the least hash of their shingles under BANDS hash functions. Whoever agrees in
one of them is a candidate, and is accepted when the window contains enough of the
template's shingles. A notice of which LEAST of the shingles are left has a similarity of
at least 0.4 with its window, so that all bands fail with a probability below 1e-7.

Windows that share no shingle with any template cannot agree in a band; their hashes are
not worked out.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from importlib.resources import files

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyline.llm import arrays
from tallyline.llm.storing import stored

BANDS = 32
LEAST = 0.75
# Templates are a list that people maintain; their shingles go to every task up to this many.
MOST_SHINGLES = 1 << 20

# The notices by which licences are declared, one sentence or more of each.
NOTICES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file '
    "except in compliance with the License. You may obtain a copy of the License at",
    "MIT": "Released under the MIT License.",
    "MIT-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
    'associated documentation files (the "Software"), to deal in the Software without restriction',
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-or-later": "This program is free software: you can redistribute it and/or modify it under the terms of "
    "the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, "
    "or (at your option) any later version.",
    "BSD": "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
    "that the following conditions are met",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "All-rights-reserved": "All rights reserved.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-2.0-or-later": "This program is free software; you can redistribute it and/or modify it under the terms of "
    "the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, "
    "or (at your option) any later version.",
    "LGPL-2.1-or-later": "This library is free software; you can redistribute it and/or modify it under the terms of "
    "the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the "
    "License, or (at your option) any later version.",
    "LGPL-3.0-or-later": "This library is free software: you can redistribute it and/or modify it under the terms of "
    "the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the "
    "License, or (at your option) any later version.",
    "AGPL-3.0-or-later": "This program is free software: you can redistribute it and/or modify it under the terms of "
    "the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the "
    "License, or (at your option) any later version.",
    "ISC-text": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee "
    "is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "EPL-1.0": "All rights reserved. This program and the accompanying materials are made available under the terms "
    "of the Eclipse Public License v1.0 which accompanies this distribution, and is available at "
    "http://www.eclipse.org/legal/epl-v10.html",
    "EPL-2.0": "This program and the accompanying materials are made available under the terms of the Eclipse Public "
    "License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
    "CC-BY-3.0": "This work is licensed under a Creative Commons Attribution 3.0 Unported License.",
    "CC-BY-SA-3.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 3.0 Unported License.",
    "CC-BY-ND-4.0": "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
    "CC-BY-NC-SA-4.0": "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 "
    "International License.",
}
# How the name of a template ends that is not the licence itself.
ENDING = "-(whole|part-[0-9]+|header|text)$"
# Words of the parts of a whole text that are templates of their own, so that a cut text is found by what is left.
PART_WORDS = 100
# Templates of fewer words have shingles of two, of which enough are left when the first word differs.
SHORT_WORDS = 8

# Words are runs of ASCII letters and digits and of bytes beyond ASCII.
BETWEEN = np.ones(256, dtype=bool)
BETWEEN[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False
_BANDS = arrays.numbers(BANDS, 7)

TEMPLATE = "license string, class long, n_words int, shingles array<long>, keys array<long>"
WINDOW = "uid long, doc_id long, class long, word_start long, shingles array<long>, keys array<long>"


def notices(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(NOTICES.items()), "license string, text string")


def texts() -> dict[str, str]:
    """Whole licence texts, and their parts of PART_WORDS words; the last part ends with the text."""
    out = {}
    for file in sorted((files("tallyline.llm") / "licence_texts").iterdir(), key=lambda f: f.name):
        name, text = file.name.removesuffix(".txt"), file.read_text(encoding="utf-8")
        out[f"{name}-whole"] = text
        words = re.findall(r"[^\W_]+", text)
        starts = [*range(0, len(words) - PART_WORDS, PART_WORDS), max(0, len(words) - PART_WORDS)]
        for k, at in enumerate(starts):
            out[f"{name}-part-{k + 1}"] = " ".join(words[at : at + PART_WORDS])
    return out


def all_templates(spark: SparkSession) -> DataFrame:
    """The notices, whole texts and parts of texts."""
    return spark.createDataFrame(list((NOTICES | texts()).items()), "license string, text string")


def shape(n_words: int) -> tuple[int, int, int]:
    """Words of a shingle, step and words of a window for templates of a length."""
    size = min(n_words, arrays.SHINGLE if n_words >= SHORT_WORDS else 2)
    step = max(1, (n_words - size + 1) // 4)
    return size, step, n_words + step - 1


def band_keys(shingles: np.ndarray, n_words: int) -> np.ndarray:
    """The least hash of a set under each function, marked with the class and the band."""
    least = arrays.mixed(shingles[None, :] ^ _BANDS[:, None]).min(axis=1)
    return arrays.mixed(least ^ (_BANDS + np.uint64(n_words)))


def _templates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for found in arrays.words(batch.column(1), lower=True, between=BETWEEN):
            hashes = arrays.word_hashes(found, BETWEEN)
            for k in range(len(found.edges) - 1):
                own = hashes[found.bounds[k] : found.bounds[k + 1]]
                if not len(own):
                    continue
                shingles = np.unique(arrays.windows(own, shape(len(own))[0]))
                rows.append((batch.column(0)[found.first + k].as_py(), len(own), shingles))
        names, lengths, sets = zip(*rows, strict=True) if rows else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(names, pa.string()),
                pa.array(lengths, pa.int64()),
                pa.array(lengths, pa.int32()),
                arrays.lists(list(sets)),
                arrays.lists([band_keys(s, n) for s, n in zip(sets, lengths, strict=True)]),
            ],
            names=["license", "class", "n_words", "shingles", "keys"],
        )


def _windows(known):
    """Windows that share a shingle with a template of their class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = known.value  # words of the templates -> their shingles, sorted
        sizes = sorted({shape(n)[0] for n in classes})
        of_size = {k: np.unique(np.concatenate([v for n, v in classes.items() if shape(n)[0] == k])) for k in sizes}
        for batch in batches:
            out = []
            for found in arrays.words(batch.column(2), lower=True, between=BETWEEN):
                hashes = arrays.word_hashes(found, BETWEEN)
                owner = np.repeat(np.arange(len(found.edges) - 1), np.diff(found.bounds))
                runs = {k: arrays.windows(hashes, k) for k in sizes}
                hits = {k: np.flatnonzero(np.isin(runs[k], of_size[k])) for k in sizes}
                for n, wanted in classes.items():
                    size, step, width = shape(n)
                    at = hits[size][np.isin(runs[size][hits[size]], wanted)]
                    at = at[owner[at] == owner[at + size - 1]]
                    text = owner[at]
                    place = at - found.bounds[text]
                    inner = width - size + 1  # shingles of a window
                    for back in range(-(-inner // step)):
                        start = place // step * step - back * step
                        good = (start >= 0) & (place - start < inner)
                        out.append(np.stack([text[good], start[good], np.full(good.sum(), n)], axis=1))
                if out:
                    yield _window_rows(batch, found, runs, np.unique(np.concatenate(out), axis=0))
                    out = []

    return run


def _window_rows(batch, found, runs, places) -> pa.RecordBatch:
    sets, keys = [], []
    for text, start, n in places.tolist():
        size, _, width = shape(n)
        first, end = int(found.bounds[text]) + start, int(found.bounds[text + 1])
        sets.append(np.unique(runs[size][first : min(first + width, end) - size + 1]))
        keys.append(band_keys(sets[-1], n))
    rows = pa.array(found.first + places[:, 0])
    return pa.RecordBatch.from_arrays(
        [
            batch.column(0).take(rows),
            batch.column(1).take(rows),
            pa.array(places[:, 2]),
            pa.array(places[:, 1]),
            arrays.lists(sets),
            arrays.lists(keys),
        ],
        names=["uid", "doc_id", "class", "word_start", "shingles", "keys"],
    )


def scan(docs: DataFrame, templates: DataFrame) -> DataFrame:
    """doc_id, license, containment, word_start and windows: a row for each notice a document holds.

    ``templates`` (license, text) is a maintained list; templates without words match nothing.
    Shingles have five words, or two of a template of fewer than SHORT_WORDS; case and punctuation do
    not count. ``containment`` is the largest share of a template's shingles in one window,
    LEAST or more, ``word_start`` the first word of the first such window, and ``windows``
    the number of windows that contain enough. Null and empty texts hold no notice. Each row
    of ``docs`` is scanned for itself, so repeated rows give repeated rows; other columns are
    ignored; an empty table gives an empty result.
    """
    return _matches(docs, _prepared(templates)).select("doc_id", "license", "containment", "word_start", "windows")


def resolve(docs: DataFrame, templates: DataFrame) -> DataFrame:
    """doc_id, license, kind, share, first_word, last_word and templates: a row for each licence of a document.

    Headers, whole texts and parts of a text in ``templates`` stand for their licence, as the ending of
    their name says. Licences share passages, so a text holds templates of others as well: a
    match gives way to one of another licence that it meets, if that licence's templates hold what its own says, and
    explain more words of the document; licences that explain equally many are all named. ``kind`` is
    ``text`` where a whole text or a part of one was found and ``notice`` elsewhere; ``share`` is
    how much of the text, or of the best notice, was found; first and last word tell where.

    Nulls, repeated rows and empty tables are as in ``scan``. The matches of a document, which are
    compared with one another, are at most as many as there are templates.
    """
    licence = F.regexp_replace("license", ENDING, "")
    prepared = _prepared(templates)
    n_parts = prepared.where(F.col("license").rlike("-part-[0-9]+$")).groupBy(licence.alias("licence")).agg(
        F.count("*").alias("n_parts")
    )
    matches = _matches(docs, prepared).withColumn("licence", licence).join(_said_by(prepared), "license", "left")
    words = F.sum(F.col("containment") * F.col("n_words")).over(Window.partitionBy("uid", "licence"))
    end = F.col("best_start") + F.col("n_words")
    rows = matches.withColumn("explains", F.round(words, 6)).groupBy("uid").agg(
        F.first("doc_id").alias("doc_id"),
        F.collect_list(
            F.struct(
                "licence", "license", "containment", F.col("best_start").alias("start"), end.alias("end"), "explains",
                F.coalesce("said_by", F.array().cast("array<string>")).alias("said_by"),
            )
        ).alias("matches"),
    )

    def gives_way(r):
        def better(o):
            meets = (o["start"] < r["end"]) & (r["start"] < o["end"])
            return F.array_contains(r["said_by"], o["licence"]) & (o["explains"] > r["explains"]) & meets

        return F.exists("matches", better)

    kept = rows.select("uid", "doc_id", F.inline(F.filter("matches", lambda r: ~gives_way(r))))
    whole, part = F.col("license").endswith("-whole"), F.col("license").rlike("-part-[0-9]+$")
    found = kept.groupBy("uid", "licence").agg(
        F.first("doc_id").alias("doc_id"),
        F.max(F.when(whole, F.col("containment"))).alias("whole"),
        F.sum(F.when(part, F.col("containment"))).alias("parts"),
        F.max(F.when(~whole & ~part, F.col("containment"))).alias("notice"),
        F.min("start").alias("first_word"),
        (F.max("end") - 1).alias("last_word"),
        F.count("*").alias("templates"),
    )
    of_text = F.greatest("whole", F.col("parts") / F.col("n_parts"))
    return found.join(F.broadcast(n_parts), "licence", "left").select(
        "doc_id",
        F.col("licence").alias("license"),
        F.when(of_text.isNotNull(), F.lit("text")).otherwise(F.lit("notice")).alias("kind"),
        F.coalesce(of_text, "notice").alias("share"),
        "first_word",
        "last_word",
        "templates",
    )


def _prepared(templates: DataFrame) -> DataFrame:
    rows = templates.select(F.col("license").cast("string"), "text")
    return stored(rows.mapInArrow(_templates, TEMPLATE), "templates")


def _said_by(prepared: DataFrame) -> DataFrame:
    """(license, said_by): for each template the other licences whose templates hold enough of its shingles."""
    each = prepared.select(
        "license", F.regexp_replace("license", ENDING, "").alias("licence"), F.size("shingles").alias("n"),
        F.explode("shingles").alias("shingle"),
    )
    others = each.select(F.col("licence").alias("other"), "shingle").distinct()
    counted = each.join(others, "shingle").where("licence <> other").groupBy("license", "other", "n").count()
    return counted.where(F.col("count") >= LEAST * F.col("n")).groupBy("license").agg(
        F.collect_list("other").alias("said_by")
    )


def _matches(docs: DataFrame, templates: DataFrame) -> DataFrame:
    """The rows of ``scan`` with the row's uid, the template's words, and where its best window begins."""
    spark = docs.sparkSession
    n = templates.agg(F.sum(F.size("shingles"))).first()[0] or 0
    if n > MOST_SHINGLES:
        raise ValueError(f"{n} shingles of templates; scan in runs of at most {MOST_SHINGLES}")
    classes: dict[int, list] = {}
    for row in templates.select("class", "shingles").collect():
        classes.setdefault(row["class"], []).append(np.array(row["shingles"], dtype=np.int64).view(np.uint64))
    known = spark.sparkContext.broadcast({k: np.unique(np.concatenate(v)) for k, v in classes.items()})
    source = docs.select(F.monotonically_increasing_id().alias("uid"), F.col("doc_id").cast("long"), "text")
    windows = stored(source.mapInArrow(_windows(known), WINDOW), "windows")
    bands = templates.select("license", F.explode("keys").alias("key"))
    met = (
        windows.select("uid", "class", "word_start", F.explode("keys").alias("key"))
        .join(bands, "key")
        .select("uid", "class", "word_start", "license")
        .distinct()
    )
    own = templates.select("license", "class", F.col("shingles").alias("wanted"))
    share = F.size(F.array_intersect("shingles", "wanted")) / F.size("wanted")
    checked = (
        met.join(windows, ["uid", "class", "word_start"])
        .join(own, ["license", "class"])
        .withColumn("containment", share)
        .where(F.col("containment") >= LEAST)
    )
    return (
        checked.groupBy("uid", "license")
        .agg(
            F.first("doc_id").alias("doc_id"),
            F.max("containment").alias("containment"),
            F.min("word_start").alias("word_start"),
            F.count("*").alias("windows"),
            F.min(F.struct(-F.col("containment"), F.col("word_start").alias("at")))["at"].alias("best_start"),
            F.first("class").alias("n_words"),
        )
    )
