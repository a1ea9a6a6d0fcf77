"""License scan: exact containment join of text blocks with license templates, in SQL functions.

A text is cut into blocks of 2 * `stride` words, one every `stride` words, so that every run of up
to `stride` + 1 words lies in the block that owns its start. Tokens are ordered by their frequency
over all documents, rarest first (only template tokens can count, so only they are ranked). A
block can contain a template to `least` only if it shares one of the template's first
|T| - ceil(least * |T|) + 1 tokens: that prefix is the join key, the length filter and the
positional filter follow, and the whole overlap decides. Phrases are templates contained whole; a
block they join is searched for their words in sequence.

Blocks stay in the task of their text until each document is one row. Templates are a parameter
and stand in the plan; nothing that grows with the corpus is broadcast. The frequency pass
returns one row per template token.

Defined cases: a null or empty text has no words and no label; each row of the input gives one
row, repeated or not; a null doc_id stays null; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cuelake.llm.common import read

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
STRIDE = 32
LEAST = 0.9

# Fixed values of the query contract: label, phrase.
PHRASES = (("cc-by", "cc by"), ("gpl", "general public license"), ("reserved", "all rights reserved"))

# The scan's own templates: label, text. Well-known notices in their usual words.
TEMPLATES = (
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("apache-2.0-notice", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("bsd-clause", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0"),
    ("cc-by-sa-4.0", "licensed under cc by sa 4 0"),
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3"),
    ("gpl-notice", "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("mit", "released under the mit license"),
    ("mit-grant", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license"),
)


def words_of(text: str = "text"):
    """Lower-case A-Z, then words. lower() also folds letters outside ASCII, which no template has;
    only the Kelvin sign would become an ASCII letter, so it is set aside first."""
    folded = F.lower(F.translate(F.coalesce(F.col(text), F.lit("")), "K", "Å")) if False else F.lower(F.replace(F.coalesce(F.col(text), F.lit("")), F.lit("K"), F.lit("Å")))
    return F.regexp_extract_all(folded, F.lit(WORD), F.lit(0))


def frequencies(docs: DataFrame, tokens: list[str]) -> dict[str, int]:
    """How often each of `tokens` occurs in all texts."""
    kept = F.filter(words_of(), lambda w: w.isin(tokens))
    counts = docs.select(F.explode(kept).alias("w")).groupBy("w").count().collect()
    return {row["w"]: row["count"] for row in counts}


def scan(docs: DataFrame, phrases=PHRASES, templates=TEMPLATES, least: float = LEAST, stride: int = STRIDE) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score) for every row."""
    spark = docs.sparkSession
    cut = [(label, re.findall(WORD, text), True) for label, text in phrases] + [(label, re.findall(WORD, text), False) for label, text in templates]
    if any(exact and len(w) > stride + 1 for _, w, exact in cut):
        raise ValueError("a phrase must fit the overlap of two blocks")
    tokens = sorted({w for _, ws, _ in cut for w in ws})
    seen = frequencies(docs, tokens)
    rank = {w: k for k, w in enumerate(sorted(tokens, key=lambda w: (seen.get(w, 0), w)))}
    index, needs = [], []
    for at, (label, ws, exact) in enumerate(cut):
        own = sorted({rank[w] for w in ws})
        need = len(own) if exact else math.ceil(least * len(own) - 1e-9)
        needs.append(need)
        index += [(r, i, at, exact, len(own), need, own, ws if exact else None) for i, r in enumerate(own[: len(own) - need + 1])]
    table = spark.createDataFrame(index, "rank int, i int, at int, exact boolean, n_t int, need int, own array<int>, phrase array<string>")
    leading = sorted({r for r, *_ in index})

    ranks = F.create_map(*(x for w, r in rank.items() for x in (F.lit(w), F.lit(r))))
    rows = docs.select(F.col("doc_id").cast("long"), words_of().alias("words")).withColumn("row", F.monotonically_increasing_id())
    rows = rows.withColumn("n_words", F.size("words").cast("long"))
    starts = F.sequence(F.lit(0), F.greatest(F.size("words") - 1, F.lit(0)), F.lit(stride))
    blocks = rows.select("row", "doc_id", "n_words", F.explode(F.transform(starts, lambda i: F.struct(i.alias("start"), F.slice("words", i + 1, 2 * stride).alias("block")))).alias("b"))
    blocks = blocks.select("row", "doc_id", "n_words", "b.*")
    toks = F.array_sort(F.transform(F.array_distinct(F.filter("block", lambda w: w.isin(tokens))), lambda w: F.element_at(ranks, w)))
    blocks = blocks.withColumn("toks", toks)
    probes = F.filter(F.transform("toks", lambda r, j: F.struct(r.alias("rank"), j.alias("j"))), lambda p: p["rank"].isin(leading))
    probes = F.filter(probes, lambda p: p["j"] <= F.size("toks") - min(needs))
    probed = blocks.withColumn("p", F.explode_outer(probes)).select("row", "doc_id", "n_words", "start", "block", "toks", "p.*")
    n_b = F.size("toks")
    near = (n_b >= F.col("need")) & (1 + F.least(F.col("n_t") - F.col("i") - 1, n_b - F.col("j") - 1) >= F.col("need"))
    pairs = probed.join(F.broadcast(table), (probed["rank"] == table["rank"]) & near, "left")
    shared = F.size(F.array_intersect("toks", "own"))
    met = pairs.withColumn("shared", F.when(F.col("at").isNotNull(), shared)).withColumn("met", F.coalesce(F.col("shared") >= F.col("need"), F.lit(False)))
    found = F.filter(F.sequence(F.lit(0), F.least(F.lit(stride), F.size("block")) - 1), lambda k: F.slice("block", k + 1, F.size("phrase")) == F.col("phrase"))
    met = met.withColumn("places", F.when(F.col("met") & F.col("exact"), found)).withColumn("n", F.coalesce(F.size("places"), F.lit(0)))
    met = met.withColumn("n", F.greatest("n", F.lit(0)))
    hit = F.when(F.col("exact"), F.col("n") > 0).otherwise(F.col("met"))
    sums = [
        F.sum("n").cast("long").alias("n_base"),
        F.min(F.when(F.col("n") > 0, F.col("start") + F.element_at("places", 1))).cast("long").alias("first_word"),
        F.max(F.when(F.col("n") > 0, F.col("start") + F.element_at("places", -1))).cast("long").alias("last_word"),
        F.max(F.when(F.coalesce(hit, F.lit(False)), F.col("shared") / F.col("n_t")).otherwise(0.0)).alias("score"),
    ]
    masks = [F.bit_or(F.when(F.coalesce(hit, F.lit(False)) & F.col("at").between(k, k + 62), F.expr(f"shiftleft(1L, at - {k})")).otherwise(F.lit(0).cast("long"))).alias(f"m{k}") for k in range(0, len(cut), 63)]
    one = met.groupBy("row", "doc_id", "n_words").agg(*sums, *masks)

    def names(which):
        picked = [F.when(F.getbit(f"m{at // 63 * 63}", F.lit(at % 63)) == 1, F.lit(label)) for at, (label, _, exact) in enumerate(cut) if which(exact)]
        return F.array_join(F.array_sort(F.array_distinct(F.array_compact(F.array(*picked)))), ",")

    return one.select("doc_id", "n_words", "n_base", "first_word", "last_word", names(lambda exact: exact).alias("base_labels"), names(lambda exact: True).alias("labels"), "score")


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(read(spark, sf_dir, "documents"))


def _listed() -> str:
    rows = [(label, text, "TRUE") for label, text in PHRASES] + [(label, text, "FALSE") for label, text in TEMPLATES]
    return ", ".join(f"('{label}', string_split('{text}', ' '), {exact})" for label, text, exact in rows)


SQL = rf"""
WITH t(label, phrase, exact) AS (VALUES {_listed()}),
d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS w FROM documents),
b AS (SELECT doc_id, w, unnest(range(0, greatest(len(w), 1), {STRIDE})) AS i FROM d),
c AS (
  SELECT doc_id, w, i, label, phrase, exact,
         CAST(len(list_intersect(list_distinct(w[i + 1 : i + {2 * STRIDE}]), list_distinct(phrase))) AS DOUBLE) / len(list_distinct(phrase)) AS share
  FROM b, t),
m AS (
  SELECT doc_id, label, exact, share,
         CASE WHEN exact THEN list_filter(range(i, least(i + {STRIDE}, len(w))), lambda k: w[k + 1 : k + len(phrase)] = phrase) ELSE [] END AS places
  FROM c WHERE share >= CASE WHEN exact THEN 1.0 ELSE {LEAST} - 1e-9 END),
h AS (SELECT * FROM m WHERE NOT exact OR len(places) > 0)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(sum(len(places)), 0)::BIGINT AS n_base,
       min(list_min(places)) AS first_word, max(list_max(places)) AS last_word,
       coalesce(array_to_string(list_sort(list_distinct(list(label) FILTER (exact))), ','), '') AS base_labels,
       coalesce(array_to_string(list_sort(list_distinct(list(label) FILTER (label IS NOT NULL))), ','), '') AS labels,
       coalesce(max(share), 0.0) AS score
FROM d LEFT JOIN h USING (doc_id) GROUP BY d.doc_id, d.w
"""
