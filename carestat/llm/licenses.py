"""License scan by diagonal voting.

Every rolling word k-gram of a text is joined to the k-grams of the license
templates. A hit at word p of the text and word t of a template votes for the
diagonal p - t; votes are counted per text, template and diagonal,
neighbouring diagonals (words added or left out) are merged into spans. A span is
verified on its votes: the heaviest run of hits that ascend in both the text and
the template gives the template's words that stand in the text in their order;
it has to hold LEAST of the template's words, with few other words between. Of
verified spans that overlap, the one with most words less those added and left out
stands, so a variant's own words (noncommercial, sharealike, affero, a version)
decide. Base phrases are templates of a single gram, so each of their places is
one vote on a diagonal of its own; they are never merged.

Texts are hashed in Arrow batches; the join, the votes and the merging are
Spark's. Templates are a fixed list, hence the broadcast.

Defined cases: null or empty text has no words, no place and empty labels;
texts are scanned whole; repeated rows give repeated results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from carestat.llm.words import ALNUM, gram_hashes, signed, text_parts, word_hashes, word_spans

K = 3
NEAR = 3  # diagonals at most this far apart are merged
CELL = 64  # words
LEAST = 0.75  # share of a template's words that a verified span holds in order

# fixed values: base phrases and their labels
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
# fixed values: notices, grants, titles and conditions that licenses are known by
TEMPLATES = {
    "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at": "apache-2.0",
    "licensed under the apache license version 2 0": "apache-2.0",
    "apache license version 2 0 january 2004": "apache-2.0",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy of this software": "mit",
    "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement": "mit",
    "this project is licensed under the mit license": "mit",
    "released under the mit license": "mit",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies": "isc",
    "redistribution and use in source and binary forms with or without modification are permitted": "bsd",
    "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed": "bsd",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": "bsd",
    "licensed under the gnu general public license version 2": "gpl-2.0",
    "licensed under the gnu general public license version 3": "gpl-3.0",
    "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version": "gpl-2.0",
    "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version": "gpl-3.0",
    "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation": "lgpl",
    "you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation": "agpl",
    "licensed under the gnu lesser general public license": "lgpl",
    "licensed under the gnu affero general public license": "agpl",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "mpl-2.0",
    "subject to the terms of the mozilla public license v 2 0": "mpl-2.0",
    "licensed under cc by 4 0": "cc-by-4.0",
    "licensed under cc by sa 4 0": "cc-by-sa-4.0",
    "licensed under cc by nc 4 0": "cc-by-nc-4.0",
    "licensed under cc by nd 4 0": "cc-by-nd-4.0",
    "licensed under cc by nc sa 4 0": "cc-by-nc-sa-4.0",
    "licensed under cc by nc nd 4 0": "cc-by-nc-nd-4.0",
    "creative commons attribution 4 0 international license": "cc-by-4.0",
    "creative commons attribution sharealike 4 0 international license": "cc-by-sa-4.0",
    "creative commons attribution noncommercial 4 0 international license": "cc-by-nc-4.0",
    "creative commons attribution noderivatives 4 0 international license": "cc-by-nd-4.0",
    "creative commons attribution noncommercial sharealike 4 0 international license": "cc-by-nc-sa-4.0",
    "creative commons attribution noncommercial noderivatives 4 0 international license": "cc-by-nc-nd-4.0",
    "this work is dedicated to the public domain": "public-domain",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "no part of this publication may be reproduced without prior written permission": "reserved",
}


def ordered_words(words: list[int], at: list[int], k: int = K, reach: int = 64) -> tuple[int, int, int, int]:
    """(template words held in order, first word, end word, template words left out inside) of the heaviest run of
    k-gram hits (text word, template word) that ascends in both, a hit at most ``reach`` words after the one before."""
    hits = sorted(set(zip(words, at)))
    best: list[tuple[int, int, int]] = []  # words held up to the hit, first text word, first template word
    low = 0
    for i, (w, t) in enumerate(hits):
        top = (k, w, t)
        while hits[low][0] < w - reach:
            low += 1
        for (w0, t0), (held, first, start) in zip(hits[low:i], best[low:i]):
            if w0 < w and t0 < t:
                # grams that overlap alike share words; a hit further on in one of them adds what is new in both
                top = max(top, (held + min(k, w - w0, t - t0), first, start), key=lambda v: (v[0], v[1]))
        best.append(top)
    end = max(range(len(hits)), key=lambda i: (best[i][0], -i))
    held, first, start = best[end]
    return held, first, hits[end][0] + k, hits[end][1] + k - start - held


def _hash_words(text: str) -> np.ndarray:
    data = np.frombuffer(text.encode(), np.uint8)
    starts, ends, _ = word_spans(data, np.array([0, len(data)]), ALNUM)
    return word_hashes(data, starts, ends)


def template_rows(base: dict[str, str], templates: dict[str, str]) -> list[tuple]:
    """(gram, template no, position, label, grams of the template, its words, base?)."""
    out, no = [], 0
    for texts, is_base in ((base, True), (templates, False)):
        for text, label in texts.items():
            words = _hash_words(text)
            grams = signed(gram_hashes(words, len(words) if is_base else K))
            out += [(int(g), no, t, label, len(grams), len(words), is_base) for t, g in enumerate(grams)]
            no += 1
    return out


def gram_rows(docs: DataFrame, id_col: str, text_col: str, sizes: list[int]) -> DataFrame:
    """(row, doc, n_words, ends, grams): all rolling grams, one size after the other, a 0 first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, data, offs in text_parts(b, "text"):
                starts, ends, at = word_spans(data, offs, ALNUM)
                hashes = word_hashes(data, starts, ends)
                grams, lengths = [], []
                for i in range(hi - lo):
                    w = hashes[at[i]:at[i + 1]]
                    own = [np.zeros(1, np.uint64)] + [gram_hashes(w, k) for k in sizes]
                    grams += own
                    lengths.append(sum(map(len, own)))
                arrays = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(lengths)].astype(np.int32)),
                                                  pa.array(signed(np.concatenate(grams))))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), b.column(1).slice(lo, hi - lo),
                                                  pa.array(np.diff(at).astype(np.int64)), arrays],
                                                 names=["row", "doc", "n_words", "grams"])
    thin = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc"),
                       F.col(text_col).cast("string").alias("text"))
    return thin.mapInArrow(run, "row long, doc long, n_words long, grams array<long>")


def scan(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         base: dict[str, str] = BASE, templates: dict[str, str] = TEMPLATES) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score per document."""
    sizes = sorted({len(p.split()) for p in base} | {K})
    fields = "gram long, tmpl int, at int, label string, grams_in int, words_in int, is_base boolean"
    # gram 0 comes once per text and keeps texts without a hit
    known = spark.createDataFrame(template_rows(base, templates) + [(0, -1, 0, None, 1, 0, False)], fields)

    # where gram i of a text stands: grams of each size follow one another after the leading 0
    place, before = F.lit(0), F.lit(1)
    for k in sizes:
        count = F.greatest(F.col("n_words") - (k - 1), F.lit(0))
        place = F.when(F.col("i") >= before, F.col("i") - before).otherwise(place)
        before = before + count
    hits = (gram_rows(docs, id_col, text_col, sizes)
            .select("row", "doc", "n_words", F.posexplode("grams").alias("i", "gram"))
            .join(F.broadcast(known), "gram")
            .select("row", "doc", "n_words", "tmpl", "label", "grams_in", "words_in", "is_base",
                    place.cast("long").alias("word"), F.col("at").cast("long").alias("at")))
    key = ["row", "doc", "n_words", "tmpl", "label", "grams_in", "words_in", "is_base"]
    here = F.struct("word", "at")
    votes = (hits.withColumn("diagonal", F.col("word") - F.col("at")).groupBy(*key, "diagonal")
             .agg(F.count("*").alias("votes"), F.min("word").alias("first"), F.max("word").alias("last"),
                  F.when(~F.first("is_base") & (F.first("tmpl") >= 0), F.collect_list(here)).alias("hits")))
    line = Window.partitionBy("row", "tmpl").orderBy("diagonal", "first")
    # a diagonal goes on with the one before if it is near and its words follow or overlap
    apart = (F.coalesce(F.col("diagonal") - F.lag("diagonal").over(line) > NEAR, F.lit(True)) | F.col("is_base"))
    spans = (votes.withColumn("new", apart.cast("int")).withColumn("span", F.sum("new").over(line))
             .groupBy(*key, "span").agg(F.sum("votes").alias("votes"), F.min("first").alias("first"), F.max("last").alias("last"),
                                        F.flatten(F.collect_list("hits")).alias("hits")))
    base_ = F.col("is_base")
    enough = ~base_ & (F.col("tmpl") >= 0) & (F.col("votes") >= F.floor(F.col("words_in") * (1 - K * (1 - LEAST))))
    checked = verified(spans.where(enough).select("row", "tmpl", "span", "words_in", "label", "hits"))
    found = undefeated(checked).groupBy("row").agg(F.array_sort(F.collect_set("label")).alias("own"), F.max("share").alias("share"))
    rows = (spans.groupBy("row", "doc", "n_words")
            .agg(F.sum(F.when(base_, 1).otherwise(0)).cast("long").alias("n_base"),
                 F.min(F.when(base_, F.col("first"))).alias("first_word"), F.max(F.when(base_, F.col("first"))).alias("last_word"),
                 F.array_sort(F.collect_set(F.when(base_, F.col("label")))).alias("based")))
    labels = F.array_sort(F.array_union("based", F.coalesce("own", F.array().cast("array<string>"))))
    score = F.greatest(F.when(F.size("based") > 0, 1.0).otherwise(0.0), F.coalesce("share", F.lit(0.0)))
    return rows.join(found, "row", "left").select(
        F.col("doc").alias(id_col), "n_words", "n_base", "first_word", "last_word", F.array_join("based", ",").alias("base_labels"),
        F.array_join(labels, ",").alias("labels"), score.alias("score"))


def verified(spans: DataFrame) -> DataFrame:
    """(row, tmpl, label, first, end, share, worth): spans that hold LEAST of the template's words in order, with at most
    a quarter as many other words between; worth is the words held less those added and left out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for i, (size, hits) in enumerate(zip(b.column(3).to_pylist(), b.column(5).to_pylist())):
                held, first, end, out_of = ordered_words([h["word"] for h in hits], [h["at"] for h in hits])
                added = end - first - held
                if held >= LEAST * size and added <= 0.25 * size + 1:
                    out.append((i, first, end, min(1.0, held / size), held - added - out_of - (size - held)))
            if out:
                at, *cols = zip(*out)
                take = pa.array(at)
                yield pa.RecordBatch.from_arrays([b.column(0).take(take), b.column(1).take(take), b.column(4).take(take), pa.array(cols[0], pa.int64()),
                                                  pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.float64()), pa.array(cols[3], pa.int64())],
                                                 names=["row", "tmpl", "label", "first", "end", "share", "worth"])
    return spans.mapInArrow(run, "row long, tmpl int, label string, first long, end long, share double, worth long")


def undefeated(spans: DataFrame) -> DataFrame:
    """Without the spans of which a text has an overlapping one of another label that is worth more. Spans meet in
    cells of CELL words; of each label and place the worthiest is compared, so a cell holds a few per label."""
    cells = (spans.withColumn("cell", F.explode(F.sequence(F.floor(F.col("first") / CELL), F.floor((F.col("end") - 1) / CELL))))
             .groupBy("row", "cell", "label", "first").agg(F.max(F.struct("worth", "end")).alias("m")).select("row", "cell", "label", "first", "m.*"))
    other = cells.select("row", "cell", F.col("label").alias("label2"), F.col("first").alias("first2"), F.col("end").alias("end2"), F.col("worth").alias("worth2"))
    own = spans.withColumn("cell", F.explode(F.sequence(F.floor(F.col("first") / CELL), F.floor((F.col("end") - 1) / CELL))))
    beaten = (own.join(other, ["row", "cell"]).where("worth2 > worth and label2 <> label and first2 < end and first < end2")
              .select("row", "tmpl", "first").distinct())
    return spans.join(beaten, ["row", "tmpl", "first"], "left_anti")
