"""Benchmark decontamination with a distributed positional inverted index.

Built-in functions only.  The index holds postings ``term, doc_id, pos`` of training
tokens.  Items (benchmark texts) are cut into windows of consecutive words.  For each
window its rarest terms are looked up: their postings, moved back by the term's place
in the item, give possible starts, and a start common to all of them survives (the
intersection is one aggregate, so a hot term or document is folded before the
shuffle).  With a tolerance the same lists give proximity matches.  Survivors are then
compared word by word with the documents, which yields exact phrase matches.

Only terms that some window needs are looked up: term counts over all documents come
first, windows with a word that no document has are dropped, and the index is built
for the terms that remain.  ``postings`` builds it for any set of terms, or all.

Words are runs of ASCII letters and digits and of all non-ASCII characters, with A-Z
in lower case.  Defined cases: null and empty texts have no words; an item of fewer
words than a window, but some, is one window; items without words match nothing;
rows that repeat an id are compared one by one with their own text; repeated items
count once for each ``item_id``; empty tables give no matches; further columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framewell.llm.common import free_names, join_sized, pick
from framewell.plans.joins import join_counted
from framewell.plans.settle import settle, working

BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def split_words(text: Column) -> Column:
    """The words of a text in order, A-Z in lower case.

    A text that begins or ends with a separator has an empty string at that end; positions count it, in the
    index as in the comparison, and :func:`number_of_words` does not.
    """
    return F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), BETWEEN_WORDS)


def number_of_words(parts: Column) -> Column:
    empty_ends = (F.element_at(parts, 1) == "").cast("int") + (F.element_at(parts, -1) == "").cast("int")
    return F.greatest(F.size(parts) - empty_ends, F.lit(0))


def postings(docs: DataFrame, terms: DataFrame | None = None) -> DataFrame:
    """The positional index ``term, doc_id, pos`` of ``doc_id, text``; only of ``terms`` if given.

    The terms are broadcast if they are few, so only their postings leave the scan.
    """
    tokens = docs.select("doc_id", F.posexplode(split_words(F.col("text"))).alias("pos", "term"))
    return tokens if terms is None else join_counted(tokens, terms, ["term"])


def item_windows(items: DataFrame, size: int) -> DataFrame:
    """``item, words, at, span``: every window of an item; ``item`` numbers the rows of the table."""
    held = items.select("item_id", F.array_remove(split_words(F.col("text")), "").alias("words")).where(F.size("words") > 0)
    numbered = settle(held.withColumn("item", F.monotonically_increasing_id()), "items")
    last = F.greatest(F.size("words") - size, F.lit(0))
    return numbered.select(
        "item", "item_id", "words", F.explode(F.sequence(F.lit(0), last)).alias("at")
    ).withColumn("span", F.least(F.lit(size), F.size("words")))


def rarest_terms(windows: DataFrame, counts: DataFrame, picks: int) -> DataFrame:
    """``item, at, term, place``: the rarest ``picks`` words of each window, all of whose words occur.

    ``place`` is the word's position in the item.  Words the documents lack leave no window.
    """
    words = windows.select(
        "item", "at", "span", F.posexplode(F.slice("words", F.col("at") + 1, F.col("span"))).alias("k", "term")
    )
    known = words.join(counts, "term").select("item", "at", "span", "term", (F.col("at") + F.col("k")).alias("place"), "n")
    best = F.slice(F.array_sort(F.collect_list(F.struct("n", "place", "term"))), 1, picks)
    whole = known.groupBy("item", "at", "span").agg(best.alias("best"), F.count(F.lit(1)).alias("found"))
    return whole.where(F.col("found") == F.col("span")).select(
        "item", "at", F.posexplode("best").alias("bit", "b"), F.size("best").alias("picks")
    ).select("item", "at", "bit", "picks", "b.term", "b.place")


def intersect(index: DataFrame, picked: DataFrame, slop: int = 0) -> DataFrame:
    """Starts at which all picked terms of a window occur: ``item, at, doc_id, shift``.

    ``shift`` is the position in the document of the item's first word.  With ``slop`` all placements are
    found whose terms are moved by up to that many words against each other, and none by more than twice that
    plus one (terms meet in overlapping cells); ``shift`` is then near the start.
    """
    hits = index.join(picked, "term").withColumn("shift", F.col("pos") - F.col("place"))
    if slop:
        width = slop + 1
        cell = F.floor(F.col("shift") / width)
        hits = hits.withColumn("shift", F.explode(F.array(cell * width, (cell + 1) * width)))
    mask = F.bit_or(F.expr("shiftleft(1, bit)"))
    return (
        hits.groupBy("item", "at", "doc_id", "shift")
        .agg(mask.alias("mask"), F.max("picks").alias("picks"))
        .where(F.col("mask") == F.expr("shiftleft(1, picks) - 1"))
        .drop("mask", "picks")
    )


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    *,
    size: int = 10,
    picks: int = 2,
    slop: int | None = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    only_found: bool = False,
) -> DataFrame:
    """Per document: ``id_col, n_words, hits, item_ids, near_items``.

    Without ``slop`` proximity is not looked for and ``near_items`` is null; with ``only_found`` the documents
    in which no item may occur are left out.
    ``hits`` lists the positions (see :func:`split_words`) of words inside an exact occurrence of a window, ``item_ids`` the items with such
    a window (strings, sorted), ``near_items`` how many items have all picked terms of a window within ``slop``.
    """
    docs = pick(docs, doc_id=id_col, text=text_col)
    items = pick(items, item_id=item_col, text=item_text_col)
    windows = settle(item_windows(items, size), "windows")
    vocabulary = windows.select(F.explode("words").alias("term")).distinct()
    counts = postings(docs, vocabulary).groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    picked = settle(rarest_terms(windows, counts, picks), "picked")
    index = settle(postings(docs, picked.select("term").distinct()), "postings")
    exact = intersect(index, picked).select("doc_id", "item", "shift").distinct()
    texts = windows.where("at = 0").select("item", "item_id", "words")
    size_of = F.aggregate("words", F.lit(64), lambda s, w: s + 24 + F.octet_length(w))
    places = join_sized(exact, texts, "item", size_of, "items", "inner").groupBy("doc_id").agg(
        F.collect_list(F.struct(F.col("item_id").cast("string").alias("item_id"), "shift", "words")).alias("places")
    )
    if slop is None:
        found = places.select(F.col("doc_id").alias("_doc"), F.lit(None).cast("long").alias("near_items"), "places")
    else:
        near = intersect(index, picked, slop).groupBy("doc_id").agg(F.count_distinct("item").alias("near_items"))
        found = near.join(places, near["doc_id"].eqNullSafe(places["doc_id"]), "left").select(
            near["doc_id"].alias("_doc"), "near_items", "places"
        )
    weight = F.lit(32) + F.coalesce(F.aggregate("places", F.lit(0), lambda s, p: s + 40 + 16 * F.size(p["words"])), F.lit(0))
    words = docs.select("doc_id", split_words(F.col("text")).alias("doc"))
    joined = join_sized(words, found, F.col("doc_id").eqNullSafe(F.col("_doc")), weight, "found", "inner" if only_found else "left")

    def starts(place: Column) -> Column:
        """Positions in the document where a window of the placed item begins and matches throughout."""
        item, shift = place["words"], place["shift"]
        span = F.least(F.lit(size), F.size(item))
        every = F.sequence(F.greatest(F.lit(0), -shift), F.greatest(F.greatest(F.lit(0), -shift), F.size(item) - span))
        fits = F.filter(every, lambda s: (s + span <= F.size(item)) & (F.slice(F.col("doc"), shift + s + 1, span) == F.slice(item, s + 1, span)))
        return F.transform(fits, lambda s: F.struct((shift + s).alias("from"), (shift + s + span - 1).alias("to"), place["item_id"].alias("item_id")))

    matches = F.flatten(F.transform(F.coalesce("places", F.array().cast(found.schema["places"].dataType)), starts))
    checked = joined.select("doc_id", number_of_words(F.col("doc")).alias("n_words"), "near_items", matches.alias("m"))
    covered = F.array_distinct(F.flatten(F.transform("m", lambda m: F.sequence(m["from"], m["to"]))))
    return checked.select(
        F.col("doc_id").alias(id_col),
        "n_words",
        F.array_sort(covered).alias("hits"),
        F.array_sort(F.array_distinct(F.col("m.item_id"))).alias("item_ids"),
        (F.col("near_items") if slop is None else F.coalesce("near_items", F.lit(0))).alias("near_items"),
    )


def clean_documents(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The documents in which no window of an item occurs, whole.

    A row is decided by its own text, whatever its id: rows without an id and rows that share one too.
    """
    text_col = options.pop("text_col", "text")
    options = {k: v for k, v in options.items() if k not in ("id_col", "slop", "only_found")}
    (key,) = free_names(docs, "_text")
    keyed = docs.withColumn(key, F.unhex(F.md5(F.coalesce(F.col(f"`{text_col}`"), F.lit("")).cast("binary"))))
    with working() as scope:
        # only exact occurrences decide, so proximity, which is most of the index's matches, is not looked for
        found = decontaminate(keyed, items, id_col=key, text_col=text_col, slop=None, only_found=True, **options)
        hit = scope.keep(found.where(F.size("hits") > 0).select(key).distinct(), "contaminated")
    return join_sized(keyed, hit, key, F.lit(48), "hit", "left_anti").drop(key)
