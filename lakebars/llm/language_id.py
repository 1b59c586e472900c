"""Language of a text as a mixture of languages, by expectation-maximisation.

Each language is a distribution over letter trigrams, learned from labelled
texts. A text's trigrams are taken as drawn from a mixture; expectation-
maximisation finds the shares of the languages. Languages enter the mixture one
by one, by the gain in likelihood, as long as the gain outweighs the penalty for
one more share. The prediction is the language with the largest share.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakebars.llm.common import hashed_share, slices, text_of, written

TRAIN_ROWS_PER_LANGUAGE = 5_000
BUCKETS = 1 << 15
STEPS = 25
TOLERANCE = 1e-4
PENALTY = 2.0  # per share, times the logarithm of the number of trigrams
UNKNOWN = "und"
BATCH_DOCS = 512
_CHUNK = 1 << 20  # characters of a text handled at once


def _letters(text: str) -> np.ndarray:
    """Code points in lower case; whatever is no letter is 0."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    known = codes[codes < len(_IS_LETTER)]
    if len(known) == len(codes):
        return np.where(_IS_LETTER[codes], codes, 0)
    far = codes >= len(_IS_LETTER)
    letter = np.zeros(len(codes), bool)
    letter[~far] = _IS_LETTER[known]
    letter[far] = [chr(c).isalpha() for c in codes[far].tolist()]
    return np.where(letter, codes, 0)


_IS_LETTER = np.array([chr(c).isalpha() for c in range(0x3000)])


def trigram_counts(text: str) -> np.ndarray:
    """Counts of the letter trigrams, hashed; a word's edges, and those of a stretch of a very long text, count as a blank."""
    counts = np.zeros(BUCKETS, np.int64)
    for start in range(0, max(1, len(text)), _CHUNK):
        codes = _letters(text[start : start + _CHUNK])
        # Several characters without letters in a row are one edge.
        codes = codes[(codes > 0) | np.concatenate([[True], codes[:-1] > 0])[: len(codes)]]
        codes = np.concatenate([[0], codes, [0]]).astype(np.uint64)
        a, b, c = codes[:-2], codes[1:-1], codes[2:]
        keep = b > 0
        mixed = (a * np.uint64(0x9E3779B1) + b * np.uint64(0x85EBCA77) + c * np.uint64(0xC2B2AE3D))[keep]
        mixed = (mixed ^ (mixed >> np.uint64(15))) * np.uint64(0x27D4EB2F165667C5)
        counts += np.bincount((mixed >> np.uint64(49)).astype(np.int64), minlength=BUCKETS)
    return counts


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    log_p: np.ndarray  # languages x buckets

    def shares(self, counts: np.ndarray) -> np.ndarray:
        """Share of each language; zero for those left out."""
        at = np.flatnonzero(counts)
        n = counts[at].astype(float)
        log_p = self.log_p[:, at]
        top = log_p.max(axis=0)
        p = np.exp(log_p - top)  # likelihoods relative to the best language of each trigram
        alone = np.log(np.maximum(p, 1e-300)) @ n
        chosen = [int(np.argmax(alone))]
        share, best = np.ones(1), float(alone[chosen[0]])
        penalty = PENALTY * np.log(n.sum() + 1)
        while len(chosen) < len(self.languages):
            trials = [
                (*_mixture(p[[*chosen, other]], n, share), other)
                for other in range(len(self.languages))
                if other not in chosen
            ]
            likelihood, shares, other = max(trials, key=lambda trial: trial[0])
            if likelihood - best <= penalty:
                break
            chosen, share, best = [*chosen, other], shares, likelihood
        found = np.zeros(len(self.languages))
        found[chosen] = share
        return found

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not self.languages:
            return UNKNOWN, 0.0
        counts = trigram_counts(text)
        if not counts.any():
            return UNKNOWN, 0.0
        shares = self.shares(counts)
        return self.languages[int(np.argmax(shares))], float(shares.max())


def _mixture(p: np.ndarray, n: np.ndarray, share: np.ndarray) -> tuple[float, np.ndarray]:
    """Log likelihood and shares of a mixture, from the shares without the last language."""
    share = np.append(share * 0.8, 0.2)
    total = n.sum()
    for _ in range(STEPS):
        weighted = share[:, None] * p
        new = (weighted / weighted.sum(axis=0)) @ n / total
        moved, share = np.abs(new - share).max(), new
        if moved < TOLERANCE:
            break
    return float(np.log(share @ p) @ n), share


def fit_languages(rows: DataFrame) -> LanguageModel:
    """Fit on `rows` (`text, lang`): one smoothed distribution for each value of `lang` with a letter in its texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, np.ndarray] = {}
        for batch in slices(batches, BATCH_DOCS):
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                seen[lang] = seen.get(lang, 0) + trigram_counts(text)
        for lang, counts in seen.items():
            at = np.flatnonzero(counts)
            names = pa.array([lang] * len(at), pa.string())
            yield pa.RecordBatch.from_arrays([names, pa.array(at.astype(np.int32)), pa.array(counts[at])], ["lang", "bucket", "n"])

    counted = rows.select(text_of("text").alias("text"), "lang").mapInArrow(run, "lang string, bucket int, n long")
    # One row for each language and bucket: the size of the model.
    found = counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    languages = tuple(sorted(found["lang"].unique()))
    n = np.zeros((len(languages), BUCKETS))
    n[found["lang"].map({lang: i for i, lang in enumerate(languages)}).to_numpy(int), found["bucket"].to_numpy(int)] = found["n"]
    used = max(1, int((n.sum(axis=0) > 0).sum()))
    n += 0.5 * np.maximum(n.sum(axis=1, keepdims=True), 1) / (used * 50)
    return LanguageModel(languages, np.log(n / n.sum(axis=1, keepdims=True)))


def training_rows(docs: DataFrame, allowed: Column, per_language: int = TRAIN_ROWS_PER_LANGUAGE) -> DataFrame:
    """`text, lang` of about `per_language` documents of each language among those that `allowed` lets in."""
    rows = docs.filter(F.col("lang").isNotNull() & allowed)
    totals = {row.lang: row["count"] for row in rows.groupBy("lang").count().collect()}  # one row per language
    if not totals:
        return rows.limit(0).select("text", "lang")
    # All of a language with no more rows; of the others a share, by a hash of the id.
    parts = {lang: min(1.0, per_language / n) for lang, n in totals.items()}
    share = F.create_map(*(F.lit(x) for pair in parts.items() for x in pair))[F.col("lang")]
    chosen = rows.filter(hashed_share(["doc_id"], seed=9) < share)
    return written(chosen.select("text", "lang"), "language-sample")


def predict_language(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """`docs` with `lang_pred` and `score`, the share of that language.

    Only `text` is read. A null text, or one without a letter, is `und` with
    score 0, and so is every text if no language was learned. Every row is
    predicted by itself.
    """
    names = [c for c in docs.columns if c.lower() not in ("lang_pred", "score")]
    place = names.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, BATCH_DOCS):
            found = [model.predict(text) for text in batch.column(place).to_pylist()]
            lang, score = pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, lang, score], [*names, "lang_pred", "score"])

    rows = docs.select(*names)
    schema = rows.withColumn("lang_pred", F.lit("")).withColumn("score", F.lit(0.0)).schema
    return rows.mapInArrow(run, schema)
