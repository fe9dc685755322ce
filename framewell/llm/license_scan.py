"""License scans: an exact set-similarity join of text blocks and license templates.

Built-in functions only.  A text is read as overlapping blocks of ``2 * step`` words, so
every run of up to ``step`` words lies whole in one block; templates longer than
``step`` words are cut into pieces of that many.  A block has a template's label when
it holds at least ``percent`` of the template's distinct words (containment).

*Join.*  The words of the templates are ordered by their number of occurrences in all
documents, rarest first.  A block with ``c`` of a template's ``t`` words must hold one
of the template's first ``t - c + 1`` words (prefix filter), so only blocks around such
words are cut out, in the scan.  A block with fewer than ``c`` words of the vocabulary
is dropped (length filter), and a shared word at places i and j of the two ordered
sets leaves room for at most ``1 + min(rest of one, rest of the other)`` common words
when it is the first shared one (positional filter).  What remains is compared by
intersection.  Nothing but candidate blocks leaves the scan.

*Phrases* are found in the same words: the places where all words of a phrase stand
one after another.

Templates and phrases are the caller's own short lists; they travel as literals.
Words are runs of ASCII letters and digits and of all non-ASCII characters, A-Z in
lower case.  Defined cases: null and empty texts have no words, no labels and score 0;
texts of any length are read whole; rows that repeat an id or a text are each
reported; a null id stays null; an empty table gives an empty result; further columns
are ignored; no templates leave the labels of the phrases.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framewell.llm.common import BROADCAST_BYTES, join_classes, pick, settle_sized
from framewell.llm.decontaminate import number_of_words, split_words
from framewell.plans.settle import settle

STEP = 16
PERCENT = 80

# The phrases and labels of the scan's contract.
PHRASES = [
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
]

# Usual notices of public licenses, as words.
TEMPLATES = [
    ("released under the mit license", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software", "mit"),
    ("licensed under the apache license version 2 0", "apache-2"),
    ("you may not use this file except in compliance with the license", "apache-2"),
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("creative commons attribution noncommercial 4 0 international license", "cc-by-nc"),
    ("creative commons attribution sharealike 4 0 international license", "cc-by-sa"),
    ("licensed under the gnu general public license version 3", "gpl-3"),
    ("licensed under the gnu general public license version 2", "gpl-2"),
    ("gnu lesser general public license version 3", "lgpl-3"),
    ("gnu affero general public license version 3", "agpl-3"),
    ("redistribution and use in source and binary forms with or without modification are permitted", "bsd"),
    ("subject to the terms of the mozilla public license v 2 0", "mpl-2"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
]


def template_pieces(templates: list[tuple[str, str]], step: int) -> list[tuple[int, str, list[str]]]:
    """``(piece, label, distinct words)`` of every template, long ones cut."""
    pieces = []
    for text, label in templates:
        words = text.split()
        for at in range(0, len(words), step):
            pieces.append((len(pieces), label, list(dict.fromkeys(words[at : at + step]))))
    return pieces


def ordered_templates(docs: DataFrame, templates: list[tuple[str, str]], *, step: int, percent: int) -> tuple[list[str], list[tuple]]:
    """The vocabulary, rarest word first, and ``(label, ranks of its words, least)`` of each piece; ranks follow that order.

    Occurrences are counted over all documents.
    """
    pieces = template_pieces(templates, step)
    words = sorted({w for _, _, ws in pieces for w in ws})
    tokens = docs.select(F.explode(split_words(F.col("text"))).alias("term"))
    counted = tokens.where(F.col("term").isin(words)).groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    n = {r["term"]: r["n"] for r in counted.collect()}  # at most the templates' own words
    order = sorted(words, key=lambda w: (n.get(w, 0), w))
    rank = {w: i for i, w in enumerate(order)}
    return order, [(label, sorted(rank[w] for w in ws), -(-percent * len(ws) // 100)) for _, label, ws in pieces]


def candidate_blocks(docs: DataFrame, prefix_words: list[str], *, step: int) -> DataFrame:
    """``key, block``: distinct blocks around words of the templates' prefixes, by hash of the whole text.

    Equal blocks of one text are one.
    """
    wanted = F.array(*[F.lit(w) for w in prefix_words])
    cut = docs.select("key", split_words(F.col("text")).alias("words")).where(F.arrays_overlap("words", wanted))
    # positions as split_words counts them: an empty first part only shifts all blocks by one
    places = F.filter(
        F.transform("words", lambda w, i: F.when(F.array_contains(wanted, w), i)), lambda p: p.isNotNull()
    )
    cut = cut.select("key", "words", F.array_distinct(F.transform(places, lambda p: F.floor(p / step))).alias("cells"))
    starts = F.array_distinct(F.flatten(F.transform("cells", lambda c: F.array(F.greatest(c - 1, F.lit(0)), c))))
    blocks = F.array_distinct(F.transform(starts, lambda c: F.slice(F.col("words"), (c * step + 1).cast("int"), 2 * step)))
    return cut.select("key", F.explode(blocks).alias("block"))


def similar_blocks(blocks: DataFrame, order: list[str], pieces: list[tuple]) -> DataFrame:
    """``key, label, score``: every block that meets a template's threshold, with the share of its words."""
    spark = blocks.sparkSession
    ranks = F.create_map(*[x for i, w in enumerate(order) for x in (F.lit(w), F.lit(i))])
    held = F.filter(F.transform(F.array_distinct("block"), lambda w: F.try_element_at(ranks, w)), lambda r: r.isNotNull())
    blocks = blocks.select("key", F.array_sort(held).alias("b"))
    blocks = blocks.where(F.size("b") >= min(least for _, _, least in pieces))
    prefixes = [
        (rank, i, label, ids, least)
        for label, ids, least in pieces
        for i, rank in enumerate(ids[: len(ids) - least + 1])
    ]
    table = spark.createDataFrame(prefixes, "rank int, i int, label string, t array<int>, least int")  # of the caller's own list
    met = blocks.select("key", "b", F.posexplode("b").alias("j", "rank")).join(F.broadcast(table), "rank")
    room = 1 + F.least(F.size("t") - F.col("i") - 1, F.size("b") - F.col("j") - 1)
    first = F.element_at(F.array_intersect("b", "t"), 1) == F.col("rank")  # the first shared word decides, so a block meets a template once
    met = met.where((F.size("b") >= F.col("least")) & (room >= F.col("least")) & first)
    common = F.size(F.array_intersect("b", "t"))
    return met.withColumn("common", common).where(F.col("common") >= F.col("least")).select(
        "key", "label", (F.col("common") / F.size("t")).alias("score")
    )


def phrase_places(parts: Column, phrase: str, first_part: Column) -> Column:
    """Starts of ``phrase`` in the words of a text, words from 0; ``first_part`` is 1 if the parts begin with an empty one."""
    words = phrase.split()
    at = F.filter(
        F.transform(parts, lambda w, i: F.when(w == words[0], i)), lambda p: p.isNotNull()
    )
    whole = F.filter(at, lambda p: F.slice(parts, (p + 1).cast("int"), len(words)) == F.array(*[F.lit(w) for w in words]))
    return F.transform(whole, lambda p: (p - first_part).cast("bigint"))


def scan_licenses(
    docs: DataFrame,
    *,
    phrases: list[tuple[str, str]] | None = None,
    templates: list[tuple[str, str]] | None = None,
    step: int = STEP,
    percent: int = PERCENT,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per row of ``docs``: ``id_col, n_words, places`` (phrase and start of every place), ``template_labels, score``.

    ``score`` is the largest share of a template's words in a block that meets the threshold, 1 for a phrase, else 0.
    """
    phrases = PHRASES if phrases is None else phrases
    templates = TEMPLATES if templates is None else templates
    docs = pick(docs, doc_id=id_col, text=text_col)
    keyed = docs.withColumn("key", F.md5(F.coalesce("text", F.lit("")).cast("binary")))

    parts = F.col("parts")
    lead = F.when(F.element_at(parts, 1) == "", 1).otherwise(0)
    normal = F.concat(F.lit(" "), F.array_join(parts, " "), F.lit(" "))
    nothing = F.array().cast("array<struct<label:string,at:bigint>>")

    def named(phrase: str, label: str) -> Column:
        found = F.transform(phrase_places(parts, phrase, lead), lambda p: F.struct(F.lit(label).alias("label"), p.alias("at")))
        return F.when(F.contains(F.col("normal"), F.lit(f" {phrase} ")), found).otherwise(nothing)

    rows = keyed.select("doc_id", "key", split_words(F.col("text")).alias("parts"))
    rows = rows.select("doc_id", "key", "parts", normal.alias("normal"))
    places = F.concat(nothing, *[named(*p) for p in phrases])
    rows = rows.select("doc_id", "key", number_of_words(parts).cast("long").alias("n_words"), places.alias("places"))

    if templates:
        order, pieces = ordered_templates(docs, templates, step=step, percent=percent)
        prefix_words = sorted({order[r] for _, ids, least in pieces for r in ids[: len(ids) - least + 1]})
        found = similar_blocks(candidate_blocks(keyed, prefix_words, step=step), order, pieces)
        per_text = found.groupBy("key").agg(
            F.array_sort(F.collect_set("label")).alias("template_labels"), F.max("score").alias("best"), F.lit(1).alias("n")
        )
        weight = F.lit(80) + 16 * F.size("template_labels")
        per_text, size = settle_sized(per_text, weight, "licenses")
        if size <= BROADCAST_BYTES:
            joined = rows.join(F.broadcast(per_text), "key", "left")
        else:  # copies of one text may be many: count them, and spread the rows of a hot one
            copies = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("copies"))
            classes = settle(per_text.join(copies, "key"), "classes")
            rows = settle(rows, "scanned")
            joined = join_classes(rows, classes, "key", "copies").drop("copies").unionByName(
                rows.join(classes.select("key"), "key", "left_anti"), allowMissingColumns=True
            )
    else:
        joined = rows.withColumn("template_labels", F.array().cast("array<string>")).withColumn("best", F.lit(0.0))
    score = F.when(F.size("places") > 0, F.lit(1.0)).otherwise(F.coalesce("best", F.lit(0.0)))
    return joined.select(
        F.col("doc_id").alias(id_col), "n_words", F.array_sort("places").alias("places"),
        F.coalesce("template_labels", F.array().cast("array<string>")).alias("template_labels"), score.alias("score"),
    )
