"""License notices in texts: MinHash bands over overlapping windows retrieve templates, shingle containment verifies."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.llm.common import stage_table

SHINGLE, CONTAINMENT = 5, 0.8
WINDOW = 4  # shingles of a window: 8 words; two windows share 4 words
MISS = 0.001
BROADCAST_ROWS = 500_000  # bands of templates, 24 bytes and their shingles each

# fixed values: public license notices, one name each
TEMPLATES = {
    "apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "gpl-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-3.0": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "mit-line": "Released under the MIT License.",
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}


def bands_for(window: int = WINDOW, miss: float = MISS) -> int:
    """Bands of one MinHash each that a window must have so that a template's only shingle in it, at a similarity of
    1 / ``window``, collides with probability 1 - ``miss`` at least; templates with more shingles collide more surely."""
    return math.ceil(math.log(miss) / math.log(1 - 1 / window))


def template_table(spark: SparkSession, templates: dict[str, str] | None = None) -> DataFrame:
    return spark.createDataFrame(list((TEMPLATES if templates is None else templates).items()), "license_id string, text string")


def shingles(text: Column | str) -> tuple[Column, Column]:
    """Words (letters and digits, lower-cased), and from column _words the hashes of all runs of five."""
    found = F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")
    n = F.size("_words")
    run = lambda i: F.xxhash64(*(F.get("_words", i + k) for k in range(SHINGLE)))
    return found, F.when(n >= SHINGLE, F.transform(F.sequence(F.lit(0), n - SHINGLE), run)).otherwise(F.array().cast("array<bigint>"))


def _banded(hashes: DataFrame, keys: list[str], stride: int, bands: int) -> DataFrame:
    """(keys, band): the least value of every band of every window of WINDOW shingles, a window each ``stride``."""
    last = F.size("hashes") if stride > 1 else F.greatest(F.lit(1), F.size("hashes") - WINDOW + 1)
    windows = F.transform(F.sequence(F.lit(1), last, F.lit(stride)), lambda i: F.slice("hashes", i, WINDOW))
    # not a filter, which would be pushed below and split every text once more for each of its words
    none = F.array().cast("array<array<bigint>>")
    spread = hashes.select(*keys, F.explode(F.when(F.size("hashes") > 0, windows).otherwise(none)).alias("w"))
    cells = spread.select(*keys, *(F.coalesce(F.get("w", F.lit(k)), F.get("w", F.lit(0))).alias(f"s{k}") for k in range(WINDOW)))
    least = [F.least(*(F.xxhash64(F.col(f"s{k}"), F.lit(band)) for k in range(WINDOW))) for band in range(bands)]
    return cells.select(*keys, F.explode(F.array(*least)).alias("band"))


def scan(docs: DataFrame, templates: DataFrame, containment: float = CONTAINMENT, miss: float = MISS) -> DataFrame:
    """(doc_id, license_id, containment) of each document row and template of whose five-word shingles the whole text holds
    at least ``containment``; other documents give no row.

    Windows of a text start every WINDOW shingles, those of a template at every shingle, so a template that is repeated
    word by word has a window of its own or, if short, shares one with at most WINDOW - 1 other shingles. Null and short
    texts match nothing, nor do templates under five words. Templates of one id and text count once. Rows that share a
    doc_id are matched each; rows without one are reported without one.
    """
    bands = bands_for(WINDOW, miss)
    found, hashes = shingles(F.coalesce("text", F.lit("")))
    known = (
        templates.select("license_id", found.alias("_words")).select("license_id", F.array_distinct(hashes).alias("own"), hashes.alias("hashes"))
        .filter(F.size("own") > 0).distinct()
    )
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_key"), found.alias("_words")).select("doc_id", "text_key", hashes.alias("hashes"))
    marks = stage_table(_banded(known, ["license_id", "own"], 1, bands).distinct(), "template-bands")
    # so that windows stay where they are; a larger set of templates is joined by a shuffle
    marks = F.broadcast(marks) if marks.count() <= BROADCAST_ROWS else marks
    candidates = (
        _banded(rows, ["doc_id", "text_key"], WINDOW, bands).join(marks, "band")
        .groupBy("doc_id", "text_key").agg(F.collect_set(F.struct("license_id", "own")).alias("retrieved"))
        .select(F.col("doc_id").alias("_doc"), F.col("text_key").alias("_key"), "retrieved")
    )
    texts = docs.select("doc_id", "text")
    checked = texts.join(candidates, (F.xxhash64("text") == F.col("_key")) & F.col("doc_id").eqNullSafe(F.col("_doc")))
    held = checked.select("doc_id", "retrieved", found.alias("_words")).select("doc_id", "retrieved", hashes.alias("hashes"))
    share = F.size(F.array_intersect("t.own", "hashes")) / F.size("t.own")
    return held.select("doc_id", "hashes", F.explode("retrieved").alias("t")).select(
        "doc_id", F.col("t.license_id").alias("license_id"), share.alias("containment")
    ).filter(F.col("containment") >= containment)
