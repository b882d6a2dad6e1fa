"""License notices: an exact set-similarity join of text blocks with license templates.

A block is 64 words of a text, beginning at every 32nd, so any run of 33 words lies within one; with longer templates
both grow, so that any run as long as the longest does.  It meets a template when it holds at least the threshold share of the template's different words.  Tokens are ordered by how
often they occur in all documents, rarest first.  Whoever meets a template shares one of its rarest tokens, as
many as may be missing and one more: only blocks with one of those are built (prefix filter).  Blocks with
too few template words are left out (length filter), and so are pairs whose remaining tokens in that order
cannot reach the threshold any more (positional filter).  The rest is counted exactly.  Words that tell a license
from others have to be there whatever the share, and words that make it another one must not be.

Everything is DataFrame functions; texts are never shuffled.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm.common import table
from siltstone.sources.stage import stage

BLOCK, STEP = 64, 32
THRESHOLD = 0.8

# The phrases of the contract, and their labels.
PHRASES = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)

class Notice(NamedTuple):
    """Words of a license notice, its label, the words it takes to be that license, and those that make it another."""

    text: str
    label: str
    needs: str = ""
    bars: str = ""


# Words of public license notices.
TEMPLATES = (
    Notice("released under the mit license", "mit", "mit license"),
    Notice(
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in "
        "the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software",
        "mit", "permission granted free charge person obtaining copy software", "font",
    ),
    Notice("licensed under the apache license version 2 0", "apache-2", "apache 2"),
    Notice(
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at",
        "apache-2", "apache 2",
    ),
    Notice("licensed under cc by nc 4 0", "cc-by-nc", "cc by nc", "sa nd"),
    Notice("licensed under a creative commons attribution noncommercial 4 0 international license", "cc-by-nc", "creative commons attribution noncommercial", "sharealike noderivatives noderivs"),
    Notice("licensed under the gnu general public license version 3", "gpl-3", "gnu general public 3", "lesser library affero"),
    Notice(
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation "
        "either version 3 of the license or at your option any later version",
        "gpl-3", "gnu general public 3", "lesser library affero",
    ),
    Notice("released under the bsd license", "bsd", "bsd license"),
    Notice(
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
        "bsd", "redistribution source binary forms modification permitted conditions",
    ),
    Notice("subject to the terms of the mozilla public license v 2 0", "mpl-2", "mozilla public 2"),
)

#: Everything that parts words, once A-Z are lower-cased
_PARTS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Template(NamedTuple):
    number: int
    label: str
    tokens: list[int]  # ranks in the global order, ascending
    least: int  # tokens to share
    needs: list[int]  # of these, and of words that must not be there, the ranks
    bars: list[int]


def words(text: Column) -> Column:
    """A-Z lower-cased; the words in a row, null as empty."""
    plain = F.trim(F.regexp_replace(F.translate(F.coalesce(text.cast("string"), F.lit("")), _UPPER, _LOWER), _PARTS, " "))
    return F.when(plain == "", F.array().cast("array<string>")).otherwise(F.split(plain, " "))


def token_order(docs: DataFrame, tokens: list[str], text: str = "text") -> dict[str, int]:
    """Ranks of the tokens by their number in all texts, rarest first; ties in the order of their bytes.
    Reads one row a token on the driver."""
    found = docs.select(F.explode(words(F.col(text))).alias("token")).where(F.col("token").isin(tokens)).groupBy("token").agg(F.count("*").alias("n"))
    counts = {r["token"]: r["n"] for r in found.collect()}
    return {t: k for k, t in enumerate(sorted(tokens, key=lambda t: (counts.get(t, 0), t.encode())))}


def _templates(order: dict[str, int], templates: tuple[Notice, ...], threshold: float) -> list[Template]:
    out = []
    for number, t in enumerate(templates):
        ranks, needs, bars = (sorted(order[w] for w in set(x.split())) for x in (t.text, t.needs, t.bars))
        out.append(Template(number, t.label, ranks, math.ceil(round(threshold * len(ranks), 9)), needs, bars))
    return out


def _shape(templates: tuple[Notice, ...]) -> tuple[int, int]:
    """Words of a block, and from one to the next."""
    step = max([STEP, *(len(t.text.split()) - 1 for t in templates)])
    return BLOCK // STEP * step, step


def _places(spaced: Column, n_words: Column, phrase: str) -> tuple[Column, Column, Column]:
    """Number of places, and first and last start.  Each word of `spaced` has a space of its own on both sides,
    so neighbouring places share nothing and words are half the spaces."""
    target = "".join(f" {w} " for w in phrase.split())
    parts = F.split(spaced, target, -1)
    half = lambda x: F.floor((F.length(x) - F.length(F.replace(x, F.lit(" "), F.lit("")))) / 2).cast("long")
    there = spaced.contains(target)
    return (
        F.when(there, F.size(parts) - 1).otherwise(0).cast("long"),
        F.when(there, half(F.element_at(parts, 1))),
        F.when(there, n_words - half(F.element_at(parts, -1)) - len(phrase.split())),
    )


def license_scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", templates=TEMPLATES, phrases=PHRASES, threshold: float = THRESHOLD) -> DataFrame:
    """For every row of `docs`: `doc_id`, `n_words`, `n_base` (places of the phrases), `first_word` and
    `last_word` (their smallest and largest start), `base_labels`, `labels` (those of phrases and of templates
    met, distinct and sorted), `blocks` (block, template and containment of every template met) and `score`,
    1 with a phrase, else the largest containment, else 0.  A template is met by a block with the threshold share of
    its different words, among them all that it needs, and none that it bars.

    Null and empty texts have no words and no labels; long texts are taken apart within their row.  Repeated rows and null ids are kept.  Other columns are
    ignored.  Runs jobs: narrow rows are written once to the shared folder.
    """
    spark = docs.sparkSession
    templates = tuple(Notice(*t) for t in templates)
    block, step = _shape(templates)
    vocabulary = sorted({w for t in templates for x in (t.text, t.needs, t.bars) for w in x.split()})
    order = token_order(docs, vocabulary, text)
    ranked = _templates(order, templates, threshold)
    token = {k: t for t, k in order.items()}
    prefixes = sorted({token[k] for t in ranked for k in t.tokens[: len(t.tokens) - t.least + 1]})
    rank = F.create_map(*[F.lit(x) for pair in order.items() for x in pair])

    ws = F.col("words")
    at = F.array_compact(F.transform(ws, lambda w, i: F.when(w.isin(prefixes), i)))
    near = F.array_distinct(F.flatten(F.transform(at, lambda i: F.array(F.floor(i / step).cast("int"), F.floor(i / step).cast("int") - 1))))
    held = lambda b: F.array_sort(F.transform(F.array_intersect(F.slice(ws, b * step + 1, F.lit(block)), F.array(*map(F.lit, vocabulary))), lambda t: rank[t]))
    blocks = F.transform(F.filter(near, lambda b: b >= 0), lambda b: F.struct(b.alias("block"), held(b).alias("tokens")))
    blocks = F.filter(blocks, lambda b: F.size(b["tokens"]) >= min(t.least for t in ranked))
    n_words = F.size(ws).cast("long")
    spaced = F.when(n_words == 0, "").otherwise(F.concat(F.lit(" "), F.array_join(ws, "  "), F.lit(" ")))
    base = docs.select(F.col(doc_id).alias("doc_id"), words(F.col(text)).alias("words")).select("doc_id", "words", n_words.alias("n_words"), spaced.alias("spaced"))
    places = [_places(F.col("spaced"), F.col("n_words"), phrase) for phrase, _ in phrases]
    written = stage(
        base.select(
            F.monotonically_increasing_id().alias("row"), "doc_id", "n_words", sum(p[0] for p in places).alias("n_base"),
            F.least(*[p[1] for p in places]).alias("first_word"), F.greatest(*[p[2] for p in places]).alias("last_word"),
            F.array_sort(F.array_distinct(F.array_compact(F.array(*[F.when(p[0] > 0, label) for p, (_, label) in zip(places, phrases, strict=True)])))).alias("base_labels"),
            blocks.alias("candidates"),
        ),
        "license-blocks",
    )
    # one row for each template and prefix token: as many as the templates have words, at most
    postings = spark.createDataFrame(
        [(k, p, *t) for t in ranked for p, k in enumerate(t.tokens[: len(t.tokens) - t.least + 1])],
        "token int, place int, template int, label string, template_tokens array<int>, least int, needs array<int>, bars array<int>",
    )
    pairs = (
        written.select("row", F.explode("candidates").alias("b")).select("row", "b.block", "b.tokens", F.posexplode("b.tokens").alias("block_place", "token"))
        .join(F.broadcast(postings), "token")
        .where((F.size("tokens") >= F.col("least")) & (1 + F.least(F.size("template_tokens") - 1 - F.col("place"), F.size("tokens") - 1 - F.col("block_place")) >= F.col("least")))
        .withColumn("shared", F.size(F.array_intersect("tokens", "template_tokens")))
        .where((F.col("shared") >= F.col("least")) & (F.size(F.array_except("needs", "tokens")) == 0) & ~F.arrays_overlap("bars", "tokens"))
        .select("row", "block", "template", "label", (F.col("shared") / F.size("template_tokens")).alias("containment"))
        .distinct()
    )
    met = pairs.groupBy("row").agg(
        F.collect_set("label").alias("met"), F.max("containment").alias("most"), F.sort_array(F.collect_list(F.struct("block", "template", "containment"))).alias("blocks")
    )  # of one text
    none = F.array().cast("array<string>")
    return written.join(met, "row", "left").select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels",
        F.array_sort(F.array_union("base_labels", F.coalesce("met", none))).alias("labels"),
        F.coalesce("blocks", F.array().cast(met.schema["blocks"].dataType)).alias("blocks"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("most", F.lit(0.0))).alias("score"),
    )


# --- query


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base_labels", ",").alias("base_labels"), F.array_join("labels", ",").alias("labels"), "score"
    )


def _sql() -> str:
    """All blocks with all templates, without filters; places from the words themselves."""
    rows = ", ".join(f"('{t.label}', '{t.text}', '{t.needs}', '{t.bars}')" for t in TEMPLATES)
    block, step = _shape(TEMPLATES)
    phrases = ", ".join(f"('{text}', '{label}', {len(text.split())})" for text, label in PHRASES)
    return rf"""
WITH templates AS (
  SELECT label, list_distinct(string_split(words, ' ')) AS tokens, string_split(needs, ' ') AS needs, string_split(bars, ' ') AS bars FROM (VALUES {rows}) t(label, words, needs, bars)
), phrases AS (SELECT * FROM (VALUES {phrases}) p(phrase, label, size)),
d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), places AS (
  SELECT doc_id, label, s FROM (SELECT doc_id, w, unnest(range(0, len(w))) AS s FROM d), phrases WHERE array_to_string(w[s + 1:s + size], ' ') = phrase
), base AS (
  SELECT doc_id, count(*) AS n_base, min(s) AS first_word, max(s) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM places GROUP BY doc_id
), blocks AS (
  SELECT doc_id, list_distinct(w[s + 1:s + {block}]) AS b FROM (SELECT doc_id, w, unnest(range(0, len(w), {step})) AS s FROM d)
), met AS (
  SELECT doc_id, label, len(list_intersect(b, tokens)) / len(tokens) AS c FROM blocks, templates
  WHERE len(list_intersect(b, tokens)) >= ceil({THRESHOLD} * len(tokens)) AND list_has_all(b, needs) AND NOT list_has_any(b, bars)
), every_label AS (SELECT doc_id, label FROM places UNION SELECT doc_id, label FROM met),
labels AS (SELECT doc_id, string_agg(label, ',' ORDER BY label) AS labels FROM every_label GROUP BY doc_id),
best AS (SELECT doc_id, max(c) AS c FROM met GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels,
  coalesce(labels, '') AS labels, CASE WHEN n_base > 0 THEN 1.0 ELSE coalesce(c, 0.0) END::DOUBLE AS score
FROM d LEFT JOIN base USING (doc_id) LEFT JOIN labels USING (doc_id) LEFT JOIN best USING (doc_id)
"""


OP4_SQL = _sql()
