"""Language identification by the nearest of several centroids per language.

Texts become vectors of character n-grams (one to three letters, hashed into a
fixed number of buckets), weighted by logarithmic term frequency and inverse
document frequency and brought to unit length.  Each language's training vectors are
clustered into a few centroids by spherical k-means, and a text gets the language of
the centroid with the largest cosine.  A text whose cosine falls well below what
labelled texts of that language and of about its length reach is rejected: it is too
distant from every language learned.  Those labelled texts are held out of the
centroids, and a low quantile and the median of their cosines count, so that neither a
text's share in its own centroid nor a few odd texts set the limit.

Fitting uses a bounded sample: at most ``per_language`` labelled documents of each
language for the centroids and a quarter as many for the limits, those with the
smallest hash of their id (a documented bound, independent of the input's size);
lengthy texts also serve as short snippets, so that short texts have their own
distance limits.  Of a language with fewer than five documents none is held out; it
takes the smallest limits of the others, and without others nothing is rejected for
its distance.  Prediction reads every whole text and
shuffles nothing: the model is broadcast (languages x clusters x buckets numbers,
with at most ``MAX_LANGUAGES`` languages).

Defined cases: null texts and texts without a letter are ``und`` with score 0, and
rejected; ties go to the language that sorts first; without labelled documents
everything is ``und``; rows that repeat an id are treated one by one; further columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framewell.llm.common import pick
from framewell.plans.settle import settle

UNKNOWN = "und"
# The labelled documents of a language are ranked in so many slices before those left are ranked together.
RANK_SLICES = 16
MAX_LANGUAGES = 1000
BUCKETS = 8192
SNIPPETS = (12, 40, 160, 640)  # letters and spaces of the shorter training texts
LENGTH_BANDS = 24
HELD_OUT = 5  # every fifth sampled document is for the limits
LEAST_COSINES = 50  # of a length band, else shorter texts count too


@dataclass
class Model:
    languages: list[str]  # of every centroid
    centroids: np.ndarray  # centroids x buckets, unit rows
    idf: np.ndarray
    limits: np.ndarray  # smallest accepted cosine by centroid and length band


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """For every code point whether it is a letter."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000)


def letters_only(text: str) -> np.ndarray:
    """Code points of the lower-cased text with every run of other characters as one space."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype="<u4")
    is_letter = _letters()[points]
    gap = ~is_letter
    keep = is_letter.copy()
    keep[1:] |= gap[1:] & is_letter[:-1]
    out = np.where(is_letter, points, 32)[keep]
    return np.concatenate([[32], out, [32]] if not out.size or out[-1] != 32 else [[32], out]).astype(np.uint64)


def ngram_counts(points: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket numbers and counts of all n-grams of one to three characters."""
    one = points * np.uint64(0x9E3779B97F4A7C15)
    two = (one[:-1] ^ (one[:-1] >> np.uint64(29))) + points[1:] * np.uint64(0xC2B2AE3D27D4EB4F)
    three = (two[:-1] ^ (two[:-1] >> np.uint64(31))) * np.uint64(0x165667B19E3779F9) + points[2:]
    mixed = np.concatenate([one, two * np.uint64(0x9FB21C651E98DF25), three * np.uint64(0xD6E8FEB86659FD93)])
    counts = np.bincount((mixed >> np.uint64(40)).astype(np.int64) % buckets, minlength=buckets)
    at = np.flatnonzero(counts)
    return at, counts[at]


def weighted(at: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    values = (1 + np.log(counts)) * idf[at]
    norm = np.sqrt(values @ values)
    return values / norm if norm > 0 else values


def length_band(n: int) -> int:
    return min(int(n).bit_length(), LENGTH_BANDS - 1)


def spherical_kmeans(rows: np.ndarray, clusters: int, rounds: int) -> np.ndarray:
    """Unit centroids; the start is spread by taking the row farthest from those chosen."""
    centers = [rows.mean(axis=0)]
    nearest = rows @ centers[0]
    while len(centers) < min(clusters, len(rows)):
        centers.append(rows[int(nearest.argmin())])
        nearest = np.maximum(nearest, rows @ centers[-1])
    found = np.array(centers)
    for _ in range(rounds):
        owner = (rows @ found.T).argmax(axis=1)
        for k in range(len(found)):
            if (owner == k).any():
                found[k] = rows[owner == k].mean(axis=0)
        found /= np.maximum(np.linalg.norm(found, axis=1, keepdims=True), 1e-12)
    return found


def training_sample(docs: DataFrame, per_language: int) -> DataFrame:
    """At most so many documents of each language and a quarter as many that are ``held``.

    Ids and hashes are ranked, first in slices of a language and then those left of all its slices; texts follow for the chosen.
    """
    keyed = docs.select("doc_id", "lang", F.xxhash64("doc_id", "text").alias("_order"))
    most = per_language * HELD_OUT // (HELD_OUT - 1)
    place = F.row_number().over(Window.partitionBy("lang", "_slice").orderBy("_order", "doc_id"))
    first = keyed.withColumn("_slice", F.pmod("_order", F.lit(RANK_SLICES))).withColumn("_rank", place).where(F.col("_rank") <= most)
    first = settle(first.select(*keyed.columns), "ranked")
    ranked = first.withColumn("_rank", F.row_number().over(Window.partitionBy("lang").orderBy("_order", "doc_id")))
    chosen = ranked.where(F.col("_rank") <= most).withColumn("held", F.col("_rank") % HELD_OUT == 0)
    chosen = settle(chosen.groupBy("doc_id", "lang", "_order").agg(F.min("held").alias("held")), "sample")
    if chosen.select("lang").distinct().count() > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    same = docs.withColumn("_order", F.xxhash64("doc_id", "text"))
    # 1.25 times per_language rows of at most MAX_LANGUAGES languages
    return same.join(F.broadcast(chosen), ["doc_id", "lang", "_order"]).select("lang", "text", "held")


def band_limits(cosines: dict[int, list[float]], quantile: float, tolerance: float) -> np.ndarray:
    """The limit of every length band from the cosines by band.

    A band counts with its neighbours, and with ever shorter texts until there are enough.
    """
    limits = np.zeros(LENGTH_BANDS)
    for band in range(LENGTH_BANDS):
        near = [*cosines.get(band, []), *cosines.get(band + 1, [])]
        for shorter in range(band - 1, -1, -1):
            if shorter < band - 1 and len(near) >= LEAST_COSINES:
                break
            near += cosines.get(shorter, [])
        limits[band] = max(min(tolerance * np.median(near), np.quantile(near, quantile)), 0.0) if near else 0.0
    return limits


def fit(
    labelled: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    per_language: int = 400,
    clusters: int = 4,
    rounds: int = 8,
    buckets: int = BUCKETS,
    tolerance: float = 0.4,
    quantile: float = 0.02,
) -> Model:
    """Learn from ``labelled`` (rows without a label are skipped).

    A text is rejected below the ``quantile`` of the cosines that held-out texts of its language reach, and
    below ``tolerance`` times their median, whichever is less (see :func:`band_limits`).
    """
    docs = pick(labelled, doc_id=id_col, text=text_col, lang=lang_col).where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    docs = docs.withColumn("lang", F.col("lang").cast("string"))
    sample = training_sample(docs, per_language)

    def count(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for lang, text, held in zip(batch["lang"], batch["text"], batch["held"], strict=True):
                points = letters_only(text)
                for size in (*SNIPPETS, None):
                    part = points[:size] if size else points
                    if (part != 32).any() and (size is None or held and len(points) > size):
                        at, counts = ngram_counts(part, buckets)
                        out.append((lang, held, len(part), at.tolist(), counts.tolist()))
            yield pd.DataFrame(out, columns=["lang", "held", "n", "at", "counts"])

    vectors = settle(sample.mapInPandas(count, "lang string, held boolean, n int, at array<int>, counts array<int>"), "vectors")
    full = vectors.where("not held")
    n_docs = full.count()
    idf = np.full(buckets, np.log(1 + n_docs) + 1)
    for r in full.select(F.explode("at").alias("at")).groupBy("at").count().collect():  # one row per bucket at most
        idf[r["at"]] = np.log((1 + n_docs) / (1 + r["count"])) + 1

    def dense(part: pd.DataFrame) -> np.ndarray:
        rows = np.zeros((len(part), buckets), dtype=np.float32)
        for i, (at, counts) in enumerate(zip(part["at"], part["counts"], strict=True)):
            rows[i, at] = weighted(np.asarray(at), np.asarray(counts), idf)
        return rows

    def cluster(part: pd.DataFrame) -> pd.DataFrame:
        rows = dense(part.sort_values("n", kind="stable"))
        found = spherical_kmeans(rows, clusters, rounds)
        return pd.DataFrame({"lang": part["lang"].iloc[0], "centroid": [c.tolist() for c in found]})

    centroids = full.select("lang", "n", "at", "counts").groupBy("lang").applyInPandas(cluster, "lang string, centroid array<float>")
    learned = sorted((r["lang"], r["centroid"]) for r in centroids.collect())
    model = Model([lang for lang, _ in learned], np.array([c for _, c in learned], dtype=np.float32).reshape(-1, buckets), idf, np.zeros((len(learned), LENGTH_BANDS)))
    if not learned:
        return model

    def nearest(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            own = [np.array([lang == x for x in model.languages]) for lang in batch["lang"]]
            cosine = [
                float((model.centroids[mask][:, at] @ weighted(np.asarray(at), np.asarray(counts), model.idf)).max())
                for mask, at, counts in zip(own, batch["at"], batch["counts"], strict=True)
            ]
            yield pd.DataFrame({"lang": batch["lang"], "band": [length_band(n) for n in batch["n"]], "cosine": cosine})

    learned_too = F.col("lang").isin(sorted(set(model.languages)))  # not those of which only held-out texts have letters
    held = vectors.where("held").where(learned_too).select("lang", "n", "at", "counts")
    reached: dict[str, dict[int, list[float]]] = {}
    for r in held.mapInPandas(nearest, "lang string, band int, cosine double").collect():  # a quarter of per_language texts, five lengths
        reached.setdefault(r["lang"], {}).setdefault(r["band"], []).append(r["cosine"])
    limits = {lang: band_limits(cosines, quantile, tolerance) for lang, cosines in reached.items()}
    if limits:
        others = np.min(list(limits.values()), axis=0)
        model.limits = np.array([limits.get(lang, others) for lang in model.languages])
    return model


def predict(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text", keep: list[Column] | None = None, with_text: bool = False) -> DataFrame:
    """``id_col, lang_pred, score, rejected`` for every row, the columns of ``keep`` and the text if asked for.

    ``score`` is the cosine of the nearest centroid.
    """
    buckets = model.idf.size
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = [c.alias(f"_keep{i}") for i, c in enumerate(keep or [])]
    names = [docs.select(c).columns[0] for c in keep or []]
    rows = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("_text"), *kept)

    def classify(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = shared.value
        columns = np.ascontiguousarray(fitted.centroids.T)
        for batch in batches:
            langs, scores, far = [], [], []
            for text in batch.column("_text"):
                lang, score, reject = UNKNOWN, 0.0, True
                points = letters_only(text.as_py() or "")
                if (points != 32).any() and fitted.languages:
                    at, counts = ngram_counts(points, buckets)
                    cosines = weighted(at, counts, fitted.idf) @ columns[at]
                    best = int(cosines.argmax())
                    score = min(max(float(cosines[best]), 0.0), 1.0)
                    lang, reject = fitted.languages[best], score < fitted.limits[best, length_band(len(points))]
                langs.append(lang)
                scores.append(score)
                far.append(bool(reject))
            names_out = [c for c in batch.schema.names if with_text or c != "_text"]
            rest = [batch.column(c) for c in names_out]
            out = [*rest, pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(far, pa.bool_())]
            yield pa.RecordBatch.from_arrays(out, names=[*names_out, "lang_pred", "score", "rejected"])

    inner = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if with_text or f.name != "_text"]
    made = rows.mapInArrow(classify, ", ".join([*inner, "lang_pred string", "score double", "rejected boolean"]))
    return made.select(
        F.col("_id").alias(id_col),
        *[F.col(f"_keep{i}").alias(n) for i, n in enumerate(names)],
        *([F.col("_text").alias(text_col)] if with_text else []),
        "lang_pred", "score", "rejected",
    )


def held_out(id_col: Column) -> Column:
    """Whether a document is held out of training: the CRC-32 of its id, as text, leaves 1 modulo 3."""
    return F.coalesce(F.crc32(F.encode(id_col.cast("string"), "UTF-8")) % 3 == 1, F.lit(False))


def keep_known(docs: DataFrame, model: Model, *, text_col: str = "text") -> DataFrame:
    """The documents that are not rejected, whole, in one pass without a join."""
    names = docs.columns
    rest = [c for c in names if c != text_col]
    found = predict(docs, model, id_col=rest[0], text_col=text_col, keep=[F.col(f"`{c}`") for c in rest[1:]], with_text=True)
    return found.where(~F.col("rejected")).select(*[F.col(f"`{c}`") for c in names])
