"""Exact similarity self-join of documents on word n-grams, by PartEnum signatures.

A document is the set of its distinct word n-grams; two documents link when their
Jaccard similarity is at least ``percent`` / 100.

*Signatures* (PartEnum).  Sets are put into overlapping size bands, so that any two sets
that can link share a band.  In a band the feature domain is split into parts and each
part into three; every subset of two of the three gives one signature, its content.
Sets of ``a`` and ``b`` elements that link differ in at most ``h = (a + b)(100 - p) /
(100 + p)`` elements.  A set sends the signatures of its first parts, in one order for all,
until ``h // 2 + 1`` of them hold elements in two of their three pieces (``h`` for its
largest partner).  Over the parts that both sets send, one with at most one difference
is among those, the difference lies in one piece, and the other two are a signature
that both have and that is not empty.  A set with too few such parts sends all and one
more that stands for such sets.

*Links.*  Equal sets are one node.  Signatures that only one node has are dropped, and of
those with the same nodes one is kept.  The members of large groups are told how many of
their elements no other such member has: two of them have no more in common than the
others, so a member leaves each large group in which that is too few for a link with even
its smallest one.  In rounds, representatives of each group are
compared with its other members in other components, and links merge components: first
the member with the fewest such elements, then 16, 256 and up to 1024 a round, the like of
every class of a hash.  In crowds that the first
one leaves open, members are told by the elements in which they differ from it: two differ in
all of those but the common ones, twice, which rules most links out.  A representative that
was compared leaves its group, so every pair of a group is compared or already in one
component when no group joins two components any more.  Before two sets are fetched
their sizes and bit sketches are compared: sketches differ in no more bits than the sets
in elements, so only pairs that cannot link are left out.

Defined cases: null and empty texts have no n-grams and are linked with nothing; a
text of fewer words is one n-gram; very long texts are read whole; rows that
repeat an id are linked like other rows, null ids are passed over when a component is
named (null if it has no other); an empty table gives an empty result; further columns are
ignored; :func:`keep_one` decides by row, see there.  N-grams are told
apart by 64-bit hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from framewell.llm.common import BROADCAST_BYTES, free_names, join_classes, join_sized, pick
from framewell.llm.components import components
from framewell.plans.settle import release, settle, settle_counted, working

BAND_RATIO = 1.6
CACHED_WORDS = 500_000
# Texts that are hashed at once, in bytes, and the longest words that are.
BLOCK_BYTES, LONG_WORD = 500_000, 64
BATCH_ROWS = 1000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
# Signatures are shuffled in so many turns, so that no more than one turn's lie on disk; the result is the same for any number.
TURNS = 4
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
BREAK = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
KEPT_BYTES = np.array([(1 << 8 * i) - 1 for i in range(9)], np.uint64)
# Rounds with one representative, the same for all groups it is in; the result is the same for any number.
HUB_ROUNDS = 1
# Representatives of a group in the round after those, in every further one 16 times as many, and at most.
FIRST_REPRESENTATIVES, MOST_REPRESENTATIVES = 16, 1024
# Groups of at least so many members lose those that cannot link; the result is the same for any number.
LARGE_GROUP = 32
# In groups of at least so many that a hub left open, differences from the hub are counted; the result is the same for any number.
CROWD = 128
SKETCH_WORDS = 32
# Sketches sent to every executor at once, in bytes.
SKETCH_BYTES = 8 * 1024 * 1024


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value


def mixed(x: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit finaliser, different for each seed."""
    x = (x ^ np.uint64(seed * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(29))


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of every word of the texts, A-Z lower-cased, and the number of its text."""
    data = LOWER[np.frombuffer(b" ".join([*texts, b" " * 8]), np.uint8)]
    inside = np.concatenate([[False], ~BREAK[data]])  # the last byte is a space
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    begin, size = edges[::2], edges[1::2] - edges[::2]
    ends = np.cumsum([len(t) + 1 for t in texts])
    lanes = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))
    out = size.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for at in range(0, min(int(size.max(initial=0)), LONG_WORD), 8):
        some = np.flatnonzero(size > at)
        eight = lanes[begin[some] + at] & KEPT_BYTES[np.minimum(size[some] - at, 8)]
        out[some] = mixed(out[some] * np.uint64(31) + eight, at + 1)
    for i in np.flatnonzero(size > LONG_WORD):
        out[i] = xxhash.xxh64_intdigest(data[begin[i] : begin[i] + size[i]].tobytes())
    return out, np.searchsorted(ends, begin, "right")


def shingle_sets(texts: list[bytes], n: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of the n-grams of each text given as UTF-8."""
    words, of = word_hashes(texts)
    count = np.bincount(of, minlength=len(texts))
    first = np.cumsum(count) - count

    def grams(at: np.ndarray, size: int) -> np.ndarray:
        total = np.full(max(len(at) - size + 1, 0), size, np.uint64)
        for i in range(size):
            total = mixed(total * np.uint64(31) + at[i : i + len(total)], i + 1)
        return total

    whole = grams(words, n)  # those across two texts are not used
    return [np.unique(whole[a : a + c - n + 1]) if c >= n else grams(words[a : a + c], c) if c else np.empty(0, np.uint64) for a, c in zip(first, count, strict=True)]


def blocks(batch: pa.RecordBatch, n: int) -> Iterator[tuple[int, list[bytes], list[np.ndarray]]]:
    """First row, texts and sets of runs of rows that are worked on at once."""
    begin, texts, weight = 0, [], 0
    for i, text in enumerate(batch.column("text").cast(pa.binary())):
        texts.append(text.as_py() or b"")
        weight += len(texts[-1])
        if weight > BLOCK_BYTES or i + 1 == batch.num_rows:
            yield begin, texts, shingle_sets(texts, n)
            begin, texts, weight = i + 1, [], 0


def bands(percent: int, largest: int) -> list[tuple[int, int]]:
    """Smallest and largest size of every band that sizes up to ``largest`` need."""
    out, low = [], 1
    while low <= largest:
        following = max(low + 1, int(low * BAND_RATIO))
        out.append((low, (following - 1) * 100 // percent))
        low = following
    return out


def allowed(a: int, b: int, percent: int) -> int:
    """In how many elements linked sets of these sizes can differ at most."""
    return (a + b) * (100 - percent) // (100 + percent)


def signatures_of(sets: list[np.ndarray], percent: int) -> tuple[np.ndarray, np.ndarray]:
    """The 64-bit signatures of sets, of all their bands (see the module), and how many each set has."""
    sizes = np.array([len(s) for s in sets], np.int64)
    owners, out = [np.empty(0, np.int64)], [np.empty(0, np.uint64)]
    for band, (low, high) in enumerate(bands(percent, int(sizes.max(initial=0)))):
        most = (sizes + np.minimum(high, sizes * 100 // percent)) * (100 - percent) // (100 + percent)
        of = np.flatnonzero((sizes >= low) & (sizes <= high) & (most > 0))  # with none only equal sets link, and those are one node already
        if not len(of):
            continue
        parts = int(1.25 * (allowed(high, high, percent) // 2 + 1)) + 4
        # elements are hashes themselves: a multiplication deals them anew in every band, and their sum tells contents apart
        elements = np.concatenate([sets[i] for i in of])
        key = (elements * np.uint64((band * 2 + 101) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF | 1)) >> np.uint64(32)
        piece = ((key * np.uint64(3 * parts)) >> np.uint64(32)).astype(np.int64)  # piece 3 i + j is the j-th of part i
        piece += np.repeat(np.arange(len(of)) * (3 * parts), sizes[of])
        shape = (len(of), parts, 3)
        halves = [np.bincount(piece, h.astype(float), len(of) * 3 * parts).astype(np.uint64) for h in (elements & np.uint64(0xFFFFFFFF), elements >> np.uint64(32))]
        content = (halves[0] + (halves[1] << np.uint64(32))).reshape(shape)  # sums of 32-bit numbers are exact as doubles
        filled = (np.bincount(piece, minlength=len(of) * 3 * parts) > 0).reshape(shape)
        counted = (filled.sum(axis=2) >= 2).cumsum(axis=1)
        last = (counted <= most[of, None] // 2).sum(axis=1) + 1  # parts up to the one that completes the number
        use = np.arange(parts) < last[:, None]
        for left_out in range(3):
            one, two = [j for j in range(3) if j != left_out]
            which, at = np.nonzero((filled[:, :, one] | filled[:, :, two]) & use)
            mark = mixed((at * 3 + left_out).astype(np.uint64), band + 7)
            both = mixed(content[which, at, one], 11) + mixed(content[which, at, two], 13)
            owners.append(of[which])
            out.append(mixed(both ^ mark, 17))
        few = of[last > parts]
        owners.append(few)
        out.append(np.repeat(mixed(np.array([band], np.uint64), 3), len(few)))
    owner = np.concatenate(owners)
    return np.concatenate(out)[np.argsort(owner, kind="stable")], np.bincount(owner, minlength=len(sets))


def signatures(elements: np.ndarray, percent: int) -> np.ndarray:
    """The signatures of one set."""
    return signatures_of([elements], percent)[0]


def sketches(sets: list[np.ndarray]) -> np.ndarray:
    """Which of some 2000 bits an odd number of elements falls on, a row for each set."""
    bits = 64 * SKETCH_WORDS
    at = ((mixed(np.concatenate(sets), 5) >> np.uint64(40)) % np.uint64(bits)).astype(np.int64)
    at += np.repeat(np.arange(len(sets)) * bits, [len(s) for s in sets])
    odd = (np.bincount(at, minlength=len(sets) * bits) & 1).astype(np.uint8)
    return np.packbits(odd).view(np.int64).reshape(len(sets), SKETCH_WORDS)


def sketch(elements: np.ndarray) -> np.ndarray:
    """The sketch of one set."""
    return sketches([elements])[0]


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Whole texts go to Python in batches of ``BATCH_ROWS``: a batch lies in the JVM and in the worker at once."""
    keep = spark.conf.get(_BATCH)
    spark.conf.set(_BATCH, str(BATCH_ROWS))
    try:
        yield
    finally:
        spark.conf.set(_BATCH, keep)


def lists(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """The values as lists of these sizes."""
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.view(np.int64)))


def hashed_documents(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """``row, doc_id, key`` (hash of the text), ``n_shingles, same`` (hash of the set), ``sent`` (signatures) and ``sketch``, written once."""
    kind = {f.name: f.dataType for f in docs.schema}["doc_id"].simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, texts, sets in blocks(batch, n):
                same = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
                arrays = {
                    "doc_id": batch.column("doc_id").slice(begin, len(texts)),
                    "key": pa.array([hashlib.md5(t).digest() for t in texts], pa.binary()),
                    "n_shingles": pa.array([len(s) for s in sets], pa.int64()),
                    "same": pa.array(same, pa.binary()),
                    "sent": lists(*signatures_of(sets, percent)),
                    "sketch": lists(sketches(sets).reshape(-1), np.full(len(sets), SKETCH_WORDS)),
                }
                yield pa.RecordBatch.from_arrays(list(arrays.values()), names=list(arrays))

    schema = f"doc_id {kind}, key binary, n_shingles bigint, same binary, sent array<bigint>, sketch array<bigint>"
    with small_batches(docs.sparkSession):
        return settle(docs.mapInArrow(run, schema).withColumn("row", F.monotonically_increasing_id()), "shingles")


def sets_of(texts: DataFrame, n: int) -> DataFrame:
    """``node, elements`` of every ``node, text``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, held, sets in blocks(batch, n):
                elements = lists(np.concatenate(sets), np.array([len(s) for s in sets]))
                yield pa.RecordBatch.from_arrays([batch.column("node").slice(begin, len(held)), elements], names=["node", "elements"])

    return texts.select("node", "text").mapInArrow(run, "node bigint, elements array<bigint>")


def groups_of(nodes: DataFrame) -> DataFrame:
    """``node, token, freq``: the signatures that several (``freq``) nodes have; of those with the very same nodes one."""
    # one shuffle of all signatures, in turns: a node sends each once, so the most frequent has one row of the hundreds of a node
    tokens, parts = nodes.select("node", F.explode("sent").alias("token")), []
    for turn in range(TURNS):
        counted = tokens.where(F.pmod("token", F.lit(TURNS)) == turn).withColumn("freq", F.count(F.lit(1)).over(Window.partitionBy("token")))
        parts.append(settle(counted.where("freq > 1").select("node", "token"), "held"))
    held = reduce(DataFrame.unionByName, parts)
    who = [F.count(F.lit(1)), F.min("node"), F.max("node"), F.bit_xor(F.xxhash64("node")), F.bit_xor(F.xxhash64("node", F.lit(1)))]
    marks = ["freq", "low", "high", "x", "z"]
    told_apart = held.groupBy("token").agg(*[w.alias(m) for w, m in zip(who, marks, strict=True)])
    chosen = settle(told_apart.groupBy(*marks).agg(F.min("token").alias("token")).select("token", "freq"), "chosen")
    out = settle(join_classes(held, chosen, "token", "freq").select("node", "token", "freq"), "groups")
    release(*parts, chosen)
    return out


def narrowed(groups: DataFrame, nodes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``node, token, n, usable`` of the members that may link with another of their group.

    ``usable`` is the most elements that a member can have in common with another of its group: in a large group those of
    its ``n`` that any other member of a large group has, in others all.
    """
    sized = nodes.select("node", F.col("n_shingles").cast("int").alias("n"))
    large, small = groups.where(F.col("freq") >= LARGE_GROUP), groups.where(F.col("freq") < LARGE_GROUP)
    inside = settle(large.select("node").distinct(), "inside")
    elements = join_sized(sets, inside, "node", F.lit(16), "inside", "left_semi").select("node", F.explode("elements").alias("e"))
    alone = elements.groupBy("e").agg(F.min("node").alias("node"), F.count(F.lit(1)).alias("held")).where("held = 1")
    own = alone.groupBy("node").agg(F.count(F.lit(1)).cast("int").alias("own"))
    known = sized.join(inside, "node", "left_semi").join(own, "node", "left")
    known = known.select("node", "n", (F.col("n") - F.coalesce("own", F.lit(0))).alias("usable"))
    members = settle(join_sized(large, known, "node", F.lit(24), "known", "inner"), "large")
    least = members.groupBy("token").agg(F.min("n").alias("least"))
    links = F.col("usable") * (100 + percent) >= (F.col("n") + F.col("least")) * percent
    able = join_sized(members, least, "token", F.lit(24), "least", "inner").where(links)
    columns = ["node", "token", "n", "usable"]
    others = join_sized(small, sized, "node", F.lit(24), "sized", "inner").withColumn("usable", F.col("n"))
    return settle(able.select(*columns).unionByName(others.select(*columns)), "narrowed")


def broadcast_from(theirs: DataFrame) -> int:
    """The smallest power of two so that the rows ``n, v_s`` of at least that ``n`` can be broadcast."""
    steps = theirs.groupBy(F.floor(F.log2("n")).cast("int").alias("step")).agg(F.count(F.lit(1)).alias("rows")).collect()
    left, least = SKETCH_BYTES // (8 * SKETCH_WORDS + 64), 2**62
    for step, rows in sorted(map(tuple, steps), reverse=True):
        if rows > left:
            return least
        left, least = left - rows, 2**step
    return 1


def verified(pairs: DataFrame, nodes: DataFrame, sets: DataFrame, percent: int) -> DataFrame | None:
    """The pairs ``u, v`` (``v`` may stand in many) whose sets link, or None; every pair is compared once.

    Sizes and sketches go first: sketches of the ``v`` with most pairs are broadcast, as far as they fit, so that pairs are
    shuffled as two numbers; only those of a ``v`` with few carry one.  For what they leave, the set of a ``v`` with many pairs is copied for as many groups of them
    as it has thousandths of all pairs.
    """
    sized = lambda as_: nodes.select(F.col("node").alias(as_), F.col("n_shingles").alias(f"{as_}_n"), F.col("sketch").alias(f"{as_}_s"))
    theirs = settle(pairs.groupBy("v").agg(F.count(F.lit(1)).alias("n")).join(sized("v"), "v"), "sketches")
    least = broadcast_from(theirs)
    hot, cold = F.broadcast(theirs.where(F.col("n") >= least)), theirs.where(F.col("n") < least)
    near = pairs if least == 1 else pairs.join(hot.select("v"), "v", "left_semi")
    met = near.join(sized("u"), "u").join(hot, "v")
    if least > 1:
        rest = pairs.join(hot.select("v"), "v", "left_anti").join(cold, "v").join(sized("u"), "u")
        met = met.unionByName(rest)
    apart = F.aggregate(F.zip_with("u_s", "v_s", lambda a, b: F.bit_count(a.bitwiseXOR(b))), F.lit(0), lambda s, x: s + x)
    h = F.floor((F.col("u_n") + F.col("v_n")) * (100 - percent) / (100 + percent))
    likely = met.where((F.abs(F.col("u_n") - F.col("v_n")) <= h) & (apart <= h)).select("u", "v")
    likely, some = settle_counted(likely, "candidates")
    release(theirs)
    if not some:
        release(likely)
        return None

    def wanted(end: str) -> DataFrame:
        """Only the sets of the candidates are shuffled, as long as their numbers can be broadcast."""
        ends = likely.select(F.col(end).alias("node")).distinct()
        return sets.join(F.broadcast(ends), "node", "left_semi") if 32 * some <= BROADCAST_BYTES else sets

    copies = F.ceil(F.col("n") * 1000 / F.lit(some)).cast("int")
    hubs = likely.groupBy("v").agg(F.count(F.lit(1)).alias("n")).select("v", copies.alias("copies"))
    many = F.broadcast(hubs.where("copies > 1"))  # fewer than 1000
    dealt = likely.select("u", "v").join(many, "v", "left").withColumn("salt", F.pmod(F.xxhash64("u"), F.coalesce("copies", F.lit(1))).cast("int"))
    whole = hubs.join(wanted("v").select(F.col("node").alias("v"), F.col("elements").alias("b")), "v")
    whole = whole.select("v", "b", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("salt"))
    beside = dealt.join(wanted("u").select(F.col("node").alias("u"), F.col("elements").alias("a")), "u").join(whole, ["v", "salt"])
    common = F.size(F.array_intersect("a", "b"))
    linked = common * 100 >= (F.size("a") + F.size("b") - common) * percent
    found, some = settle_counted(beside.where(linked).select("u", "v"), "links")
    release(likely)
    return found if some else None


def representatives(named: DataFrame, times: int) -> DataFrame:
    """``token, members, reps`` of the groups that join different components.

    ``reps`` are up to ``times`` members with their component: of each class of a hash that with the fewest elements of
    its own, of those the smallest.
    """
    salt = F.pmod(F.xxhash64("node", F.lit(times)), F.lit(times))
    its = [F.col("node").alias("rep"), F.col("component").alias("its"), F.col("n").alias("its_n"), F.col("far").alias("its_far"), F.col("shared").alias("its_shared")]
    first = F.min(F.struct((F.col("n") - F.col("usable")).alias("own"), *its))
    ends = [F.min("component").alias("low"), F.max("component").alias("high"), F.count(F.lit(1)).alias("members")]
    each = named.groupBy("token", salt.alias("salt")).agg(first.alias("r"), *ends)
    rep = F.struct("r.rep", "r.its", "r.its_n", "r.its_far", "r.its_shared", (F.col("r.its_n") - F.col("r.own")).alias("its_usable"))
    whole = each.groupBy("token").agg(
        F.collect_list(rep).alias("reps"), F.min("low").alias("low"), F.max("high").alias("high"), F.sum("members").alias("members")
    )
    return whole.where("low <> high").select("token", "members", "reps")


def told_by_hubs(rest: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``rest`` (with ``hub``, whom its group was compared with) with ``far`` and ``shared``, without members that cannot link.

    In crowds the elements in which a member differs from the hub are counted: all, and as ``shared`` those in which another
    member that has this hub differs as well.  Two members differ in all elements of both but twice the common ones, so
    they link only if twice the lesser ``shared`` makes up for ``far`` of both: the differences beyond what the sizes allow.
    """
    size, spare = 100 + percent, 100 - percent
    open_ends = [F.min("component").alias("low"), F.max("component").alias("high"), F.count(F.lit(1)).alias("members")]
    crowds, some = settle_counted(rest.groupBy("token").agg(*open_ends).where((F.col("low") != F.col("high")) & (F.col("members") >= CROWD)).select("token"), "crowds")
    if not some:
        return rest
    ends = join_sized(rest, crowds, "token", F.lit(16), "crowded", "left_semi").where("node <> hub").select("node", "hub").distinct()
    ends = settle(ends, "ends")
    ours = join_sized(sets, ends, "node", F.lit(24), "tied", "inner")
    hubs = sets.join(ends.select(F.col("hub").alias("node")).distinct(), "node", "left_semi").select(F.col("node").alias("hub"), F.col("elements").alias("its"))
    both = join_sized(ours, hubs, "hub", F.size("its") * 8 + 16, "hubs", "inner")
    differ = F.concat(F.array_except("elements", "its"), F.array_except("its", "elements"))
    apart = settle(both.select("hub", "node", F.size("elements").alias("n"), differ.alias("differ")), "apart")
    alone = apart.select("hub", "node", F.explode("differ").alias("e")).groupBy("hub", "e").agg(F.min("node").alias("node"), F.count(F.lit(1)).alias("held"))
    alone = alone.where("held = 1").groupBy("hub", "node").agg(F.count(F.lit(1)).alias("alone"))
    known = apart.select("hub", "node", "n", F.size("differ").alias("d")).join(alone, ["hub", "node"], "left")
    far, shared = F.col("d") * size - F.col("n") * spare, F.col("d") - F.coalesce("alone", F.lit(0))
    known = known.select("hub", "node", far.cast("int").alias("far"), shared.cast("int").alias("shared"))
    told = settle(join_sized(rest.drop("far", "shared"), known, ["hub", "node"], F.lit(32), "known", "left"), "told")
    nearest = told.groupBy("token").agg(F.min(F.coalesce("far", F.lit(-(2**30)))).alias("nearest"), F.count(F.lit(1)).alias("members"))
    nearest = join_sized(told.where("far is not null"), nearest.where("nearest > -(1 << 30)"), "token", F.lit(24), "nearest", "inner")
    lost = nearest.where(2 * F.col("shared") * size < F.col("far") + F.col("nearest")).select("token", "node")
    out = join_sized(told, lost, ["token", "node"], F.lit(24), "lost", "left_anti")
    release(apart, ends, crowds)
    return out


def link_components(groups: DataFrame, nodes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``node, component`` of all nodes with a link."""
    labels = groups.sparkSession.createDataFrame([], "node bigint, component bigint")
    edges = groups.sparkSession.createDataFrame([], "u bigint, v bigint")
    columns = ["node", "token", "n", "usable", "far", "shared", "component"]
    unknown = F.lit(None).cast("int")
    first = narrowed(groups, nodes, sets, percent)
    named, turn = first.withColumns({"component": F.col("node"), "far": unknown, "shared": unknown}), 0
    while True:
        times = 1 if turn < HUB_ROUNDS else min(FIRST_REPRESENTATIVES * 16 ** min(turn - HUB_ROUNDS, 8), MOST_REPRESENTATIVES)
        hubs, turn = turn < HUB_ROUNDS, turn + 1
        reps, some = settle_counted(representatives(named, times), "reps")
        if not some:
            return labels
        met = join_classes(named, reps, "token", "members")  # not written: the lists stand beside every member
        others = met.select(*columns, F.explode("reps").alias("r")).select(*columns, "r.*").where("component <> its")
        enough = F.least("usable", "its_usable") * (100 + percent) >= (F.col("n") + F.col("its_n")) * percent
        near = 2 * F.least("shared", "its_shared") * (100 + percent) >= F.col("far") + F.col("its_far")
        enough = enough & (F.col("far").isNull() | F.col("its_far").isNull() | near)
        ends = [F.least("node", "rep").alias("low"), F.greatest("node", "rep").alias("high")]
        once = others.where(enough).groupBy(*ends).agg(F.min("rep").alias("v"))
        pairs = settle(once.select(F.when(F.col("v") == F.col("low"), F.col("high")).otherwise(F.col("low")).alias("u"), "v"), "pairs")
        found = verified(pairs, nodes, sets, percent)
        # whoever was compared with all others of its group leaves it
        rest = met.where(~F.exists("reps", lambda r: r["rep"] == F.col("node"))).select(*columns, F.col("reps")[0]["rep"].alias("hub"))
        if found is not None:
            edges = settle(edges.union(found), "edges")
            labels, size = settle_counted(components(edges), "labels")
            small = F.broadcast(labels) if 32 * size <= BROADCAST_BYTES else labels
            rest = rest.drop("component").join(small, "node", "left").withColumn("component", F.coalesce("component", "node"))
        if hubs:
            rest = told_by_hubs(settle(rest, "rest"), sets, percent)
        following = settle(rest.select(*columns), "named")
        release(first, reps, pairs, named)
        named = following


def members(docs: DataFrame, *, n: int, percent: int) -> DataFrame:
    """``doc_id, key, n_shingles, component`` (null without n-grams) and ``component_id`` of ``doc_id, text``, one row per document."""
    hashed = hashed_documents(docs, n, percent)
    some = hashed.where("n_shingles > 0")
    classes = settle(
        some.groupBy("same").agg(F.min("row").alias("node"), F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("copies"), F.min("key").alias("any_key")),
        "classes",
    )
    copies = some.join(classes.where("copies > 1").select("same", "node"), "same").where("row <> node").select("row")
    nodes = join_sized(some.select("row", "sent"), copies, "row", F.lit(16), "copies", "left_anti")
    groups = groups_of(nodes.withColumnRenamed("row", "node"))

    compared = settle(classes.join(groups.select("node").distinct(), "node").select("node", "any_key", "copies"), "compared")
    sketched = settle(some.select(F.col("row").alias("node"), "n_shingles", "sketch").join(compared.select("node"), "node", "left_semi"), "sketches")
    slim = settle(hashed.select("row", "doc_id", "key", "n_shingles", "same"), "rows")
    release(hashed)
    keyed = docs.withColumn("_key", F.unhex(F.md5(F.coalesce("text", F.lit("")).cast("binary"))))
    # a node is one text; only those that stand in several rows are shuffled to be told apart
    wanted = compared.select(F.col("any_key").alias("_key"), "node", "copies")
    once = join_sized(keyed, wanted.where("copies = 1"), "_key", F.lit(40), "once", "inner").select("node", "text")
    several = join_sized(keyed, wanted.where("copies > 1"), "_key", F.lit(40), "several", "inner").select("node", "text")
    sets = sets_of(once.unionByName(several.dropDuplicates(["node"])), n)
    with small_batches(docs.sparkSession):
        sets = settle(sets, "sets")
    labels = link_components(groups, sketched, sets, percent)

    joined = settle(classes.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node")), "joined")
    least = joined.groupBy("component").agg(F.min("least").alias("component_id"), F.count(F.lit(1)).alias("_n"))
    named = settle(join_classes(joined, settle(least, "named"), "component", "_n").select("same", "component", "component_id", "copies"), "members")
    linked = join_classes(slim.where("n_shingles > 0"), named, "same", "copies").drop("copies", "same", "row")
    alone = slim.where("n_shingles = 0").select("doc_id", "key", "n_shingles", F.lit(None).cast("bigint").alias("component"), F.col("doc_id").alias("component_id"))
    return linked.unionByName(alone)


def jaccard_classes(
    docs: DataFrame, *, n: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: ``id_col, n_shingles, component_id`` (the smallest id reachable by links)."""
    with working() as scope:
        found = members(pick(docs, doc_id=id_col, text=text_col), n=n, percent=percent)
        return scope.keep(found.select(F.col("doc_id").alias(id_col), "n_shingles", "component_id"), "jaccard")


def keep_one(docs: DataFrame, *, n: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each component, whole: that with the smallest id (without an id only if none has one).

    Rows are told apart by id and text, not by id alone: rows that share an id but not their text are decided one by one,
    and of rows that repeat both one is left.  Documents without n-grams are linked with nothing and all stay.
    """
    hash_of = F.unhex(F.md5(F.coalesce(F.col(f"`{text_col}`"), F.lit("")).cast("binary")))
    with working() as scope:
        found = members(pick(docs, doc_id=id_col, text=text_col), n=n, percent=percent).where("n_shingles > 0")
        rows = settle(found.groupBy("component", "doc_id", "key").agg(F.count(F.lit(1)).alias("n")), "rows")
        first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "key"))
        best = settle(rows.groupBy("component").agg(first.alias("best"), F.count(F.lit(1)).alias("_n")), "best")
        told = join_classes(rows, best, "component", "_n")
        kept = told["doc_id"].eqNullSafe(told["best.doc_id"]) & (told["key"] == told["best.key"])
        told = told.select(F.col("doc_id").alias("_id"), F.col("key").alias("_key"), "n", kept.alias("kept"))
        decided = scope.keep(told.where(~F.col("kept") | (F.col("n") > 1)), "decided")
    text, key, own = free_names(docs, "_text", "_key", "_id")
    decided = decided.select(F.col("_id").alias(own), F.col("_key").alias(key), "kept")
    keyed = docs.withColumn(text, hash_of)
    same_row = (F.col(text) == F.col(key)) & F.col(f"`{id_col}`").eqNullSafe(F.col(own))
    left = join_sized(keyed, decided.select(own, key), same_row, F.lit(32), "gone", "left_anti")
    repeated = decided.where("kept")
    if repeated.take(1):
        once = join_sized(keyed, repeated.select(own, key), same_row, F.lit(32), "repeated", "left_semi")
        # rows of one id and text may be many: fold whole rows before the shuffle
        whole = once.select(F.col(text).alias("text"), F.col(f"`{id_col}`").alias("id"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
        folded = whole.groupBy("text", "id").agg(F.first("row").alias("row"))
        left = left.drop(text).unionByName(folded.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns]))
    return left.drop(text)
