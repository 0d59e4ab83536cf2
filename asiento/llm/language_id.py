"""Language identification by nearest centroids.

A text becomes a TF-IDF vector over its letter n-grams of one to three letters, folded into
a fixed number of slots and scaled to length one. Each language has a few centroids, found
by spherical k-means over a bounded sample of labelled texts, so that one language can hold
unlike kinds of text. A text gets the language of the centroid with the largest cosine. If
that cosine is below what the language's own texts of such a length reach, less a margin, the text is
rejected: it is too far from every language known.

Fitting reads at most ``Parameters.sample`` distinct texts of each language; that bound, and one row per
centroid, is all that one task or the driver ever holds. Prediction is one pass over all rows.

Defined results: NULL texts and texts without a letter are ``und`` with score 0, and are
rejected; so is every text where nothing was learned. Rows without a language
teach nothing. Copies teach once. Equal cosines go to the language first in order. A letter is what Unicode
calls one: digits, fractions and Roman numerals of their own are not. Very long texts are counted in slices. Other
columns are left alone.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from asiento.llm.tables import write_shared

UNKNOWN = "und"
NO_LETTERS = regex.compile(r"\P{L}+")
SLICE = 1 << 16  # characters of a text whose n-grams are counted at once
PREDICTION = "struct<lang_pred:string,score:double,rejected:boolean>"


@dataclass(frozen=True)
class Parameters:
    sample: int = 1500  # distinct texts of each language to learn from
    centroids: int = 3  # of each language
    slots: int = 1 << 13
    orders: int = 3  # n-grams of 1 to so many letters
    rounds: int = 8  # of k-means
    bands: tuple[int, ...] = (16, 64, 256)  # letters, for the limits of rejection
    quantile: float = 0.001  # of its own texts a language may lie below the limit, before the margin
    margin: float = 0.7  # share of that cosine that still passes


@dataclass(frozen=True)
class Model:
    """What was learned: small, whatever the size of the corpus."""

    languages: tuple[str, ...]  # of each centroid
    centroids: np.ndarray  # centroid x slot, rows of length one
    idf: np.ndarray  # slot
    limits: np.ndarray  # centroid x length band
    parameters: Parameters


def counts(text: str | None, p: Parameters) -> tuple[np.ndarray | None, int]:
    """Slot counts of the letter n-grams of the whole text, and the number of letters."""
    plain = NO_LETTERS.sub(" ", (text or "").lower()).strip()
    if not plain:
        return None, 0
    framed, total = f" {plain} ", np.zeros(p.slots)
    for start in range(0, len(framed), SLICE):
        part = framed[start : start + SLICE + p.orders - 1]  # with the n-grams that begin in the slice
        points = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        key = np.zeros(len(points), np.uint64)
        for order in range(1, p.orders + 1):
            key = key[: max(len(points) - order + 1, 0)] * np.uint64(0x100000001B3) + points[order - 1 :]
            mixed = (key[:SLICE] ^ np.uint64(order)) * np.uint64(0x9E3779B97F4A7C15)
            slots = (mixed >> np.uint64(40)).astype(np.int64) % p.slots
            total += np.bincount(slots, minlength=p.slots)
    return total, len(plain) - plain.count(" ")


def _unit(rows: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(rows, axis=-1, keepdims=True)
    return rows / np.where(length > 0, length, 1)


def _vectors(texts, p: Parameters, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    rows, letters = np.zeros((len(texts), p.slots), np.float32), np.zeros(len(texts), np.int64)
    for n, text in enumerate(texts):
        found, letters[n] = counts(text, p)
        if found is not None:
            rows[n] = np.log1p(found) * idf
    return _unit(rows), letters


def _clusters(rows: np.ndarray, p: Parameters) -> np.ndarray:
    """Spherical k-means; each new seed is the row farthest from the seeds so far."""
    centres = _unit(rows.mean(axis=0, keepdims=True))
    while len(centres) < min(p.centroids, len(rows)):
        centres = np.vstack([centres, rows[(rows @ centres.T).max(axis=1).argmin()]])
    for _ in range(p.rounds):
        nearest = (rows @ centres.T).argmax(axis=1)
        centres = np.vstack(
            [_unit(rows[nearest == c].mean(axis=0)) if (nearest == c).any() else centres[c] for c in range(len(centres))]
        )
    return centres


def sample(labelled: DataFrame, p: Parameters) -> DataFrame:
    """At most ``p.sample`` distinct texts of each language, picked by a hash of the text.

    The texts with the smallest hashes are an even sample that does not depend on the order of
    rows. Sizes of the languages give a threshold first, so that no language is sorted whole.
    """
    usable = labelled.select("lang", "text").where("lang IS NOT NULL").where(F.col("text").rlike(r"\p{L}"))
    hashed = usable.withColumn("at", F.xxhash64("text"))
    sizes = hashed.groupBy("lang").agg(F.approx_count_distinct("at").alias("texts")).collect()  # a row a language
    # Twice the share that is wanted: HyperLogLog's error cannot leave too few.
    share = {r.lang: min(1.0, 2.0 * p.sample / max(r.texts, 1)) for r in sizes}
    if not share:
        return usable
    limits = F.create_map(*[F.lit(x) for pair in share.items() for x in pair])
    near = hashed.where(F.col("at") / F.lit(2.0**64) + 0.5 <= limits[F.col("lang")])
    order = Window.partitionBy("lang").orderBy("at", "text")
    ranked = near.dropDuplicates(["lang", "text"]).withColumn("place", F.row_number().over(order))
    return write_shared(ranked.where(F.col("place") <= p.sample).select("lang", "text"), "labelled")


def fit(labelled: DataFrame, p: Parameters = Parameters()) -> Model:
    """Learn from the columns ``text`` and ``lang``."""
    chosen = sample(labelled, p)

    def frequencies(group: pd.DataFrame) -> pd.DataFrame:
        found = [c for t in group["text"] if (c := counts(t, p)[0]) is not None]
        total = np.sum([c > 0 for c in found], axis=0, dtype=np.int64)
        return pd.DataFrame({"lang": [group["lang"].iloc[0]], "n": [len(found)], "df": [total.tobytes()]})

    rows = chosen.groupBy("lang").applyInPandas(frequencies, "lang string, n long, df binary").collect()
    seen = sum((np.frombuffer(r.df, np.int64) for r in rows), np.zeros(p.slots, np.int64))
    idf = np.log((1 + sum(r.n for r in rows)) / (1 + seen)) + 1

    def centroids(group: pd.DataFrame) -> pd.DataFrame:
        vectors, letters = _vectors(list(group["text"]), p, idf)
        centres = _clusters(vectors, p)
        cosine = (vectors @ centres.T).max(axis=1)
        limits, low = [], 1.0
        for band in reversed(range(len(p.bands) + 1)):  # a shorter text is never held to a higher limit
            own = cosine[np.searchsorted(p.bands, letters, side="right") == band]
            low = min(low, float(np.quantile(own, p.quantile))) if len(own) else low
            limits.insert(0, low * p.margin)
        out = [(group["lang"].iloc[0], c.astype(np.float32).tobytes(), limits) for c in centres]
        return pd.DataFrame(out, columns=["lang", "centre", "limits"])

    rows = chosen.groupBy("lang").applyInPandas(centroids, "lang string, centre binary, limits array<double>").collect()
    rows.sort(key=lambda r: (r.lang, r.centre))
    return Model(
        tuple(r.lang for r in rows),
        np.array([np.frombuffer(r.centre, np.float32) for r in rows]).reshape(-1, p.slots),
        idf,
        np.array([r.limits for r in rows]).reshape(-1, len(p.bands) + 1),
        p,
    )


def predict(model: Model, text: Column) -> Column:
    """``PREDICTION`` of each text."""
    p = model.parameters
    languages = [*model.languages, UNKNOWN]

    @F.arrow_udf(PREDICTION)
    def prediction(texts: pa.Array) -> pa.Array:
        names, scores, away = [], [], []
        for start in range(0, len(texts), 256):
            rows, letters = _vectors(texts.slice(start, 256).to_pylist(), p, model.idf)
            if len(model.languages):
                cosines = rows @ model.centroids.T
                best = cosines.argmax(axis=1)
                score = np.clip(cosines[np.arange(len(rows)), best], 0, 1).astype(float)
                limit = model.limits[best, np.searchsorted(p.bands, letters, side="right")]
                known = letters > 0
            else:
                best, score = np.zeros(len(rows), int), np.zeros(len(rows))
                limit, known = score, np.zeros(len(rows), bool)
            names += [languages[b if k else -1] for b, k in zip(best, known)]
            scores += np.where(known, score, 0.0).tolist()
            away += (~known | (score < limit)).tolist()
        return pa.StructArray.from_arrays(
            [pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(away, pa.bool_())],
            ["lang_pred", "score", "rejected"],
        )

    return prediction(text.cast("string"))


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, lang_pred, score, rejected``, one row for each row of ``docs``."""
    found = docs.select("doc_id", predict(model, F.col("text")).alias("found"))
    return found.select("doc_id", "found.*")


def keep_known(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` that are not rejected, with the columns of ``docs``."""
    held = docs.select(F.struct("*").alias("row"), predict(model, F.col("text")).alias("found"))
    return held.where("NOT found.rejected").select("row.*")
