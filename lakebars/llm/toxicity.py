"""Toxicity scores: gradient-boosted trees over dense features of a text, calibrated.

The lexicons (whole words, and beginnings of words) are learned from labelled
rows by how much more often a term stands in toxic texts. A text's features are
densities of lexicon hits, their nearness to the second person, capitals,
punctuation and words that hide letters. The model is fitted on at most about
`TRAIN_ROWS` labelled rows; every row is scored over its whole text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakebars.llm.boosting import Isotonic, Trees, fit_isotonic, fit_trees, out_of_fold
from lakebars.llm.common import sampled, slices, text_of, written

TRAIN_ROWS = 16_000
LEXICON_TERMS = 512
LEAST_TOXIC = 5  # toxic texts a term must stand in
LEAST_ODDS = 2.5  # log odds by which toxic texts must prefer it
PREFIXES = (4, 5)
TOXIC_FROM = 0.7
BATCH_DOCS = 512
KNOWN_WORDS = 1 << 16  # tokens a task remembers

# Second-person words of the four languages.
SECOND_PERSON = frozenset(
    "you your yours yourself u ur du dich dir dein deine ihr euch euer tu te toi ton ta tes vous votre vos "
    "usted ustedes ti tú tus vosotros vuestro".split()
)
# Characters that stand in for letters.
STAND_INS = str.maketrans("013457@$!", "oieastasi")

WORD, BEGIN, YOU, CAPS, HIDDEN, UNHIDDEN = 1, 2, 4, 8, 16, 32
_LETTERS = re.compile(r"[^\W\d_]+")
_MIXED = re.compile(r"[^\W\d_][\d@$*!#%&]+[^\W\d_]")
_JUNK = re.compile(r"[^\w]|_")


@dataclass(frozen=True)
class Lexicon:
    words: frozenset[str]
    begins: frozenset[str]

    def has(self, word: str) -> int:
        return (WORD if word in self.words else 0) | (BEGIN if any(word[:n] in self.begins for n in PREFIXES) else 0)


class _Marks(dict):
    """Marks of a token, remembered for up to `KNOWN_WORDS` distinct tokens."""

    def __init__(self, lexicon: Lexicon) -> None:
        super().__init__()
        self.lexicon = lexicon

    def __missing__(self, token: str) -> int:
        low = token.lower()
        found = 0
        for word in _LETTERS.findall(low):
            found |= self.lexicon.has(word) | (YOU if word in SECOND_PERSON else 0)
        if len(token) > 1 and token.isupper():
            found |= CAPS
        if _MIXED.search(low):
            found |= HIDDEN
            plain = _JUNK.sub("", low.translate(STAND_INS))
            if self.lexicon.has(plain) or self.lexicon.has(_JUNK.sub("", low)):
                found |= UNHIDDEN
        if len(self) >= KNOWN_WORDS:
            self.clear()
        self[token] = found
        return found


FEATURES = 16
_UPPER = np.zeros(256, bool)
_UPPER[[*range(65, 91), *range(0xC0, 0xD7), *range(0xD8, 0xDF)]] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(0xC0, 0xD7), *range(0xD8, 0xF7), *range(0xF8, 256)]] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_MARK = np.zeros(256, bool)
_MARK[[c for c in range(33, 127) if not (_LETTER[c] or _DIGIT[c])]] = True


def features(text: str, marks: _Marks) -> list[float]:
    tokens = text.split()
    n = max(1, len(tokens))
    found = np.frombuffer(bytes(map(marks.__getitem__, tokens)), np.uint8)
    count = lambda bit: int(np.count_nonzero(found & bit))
    hits = np.flatnonzero(found & (WORD | BEGIN | UNHIDDEN))
    you = np.flatnonzero(found & YOU)
    near = 0.0
    if len(hits) and len(you):
        at = np.searchsorted(you, hits)
        gap = np.minimum(np.abs(you[np.minimum(at, len(you) - 1)] - hits), np.abs(hits - you[np.maximum(at - 1, 0)]))
        near = 1.0 / (1.0 + float(gap.min()))
    chars = np.bincount(np.frombuffer(text.encode("latin-1", "replace"), np.uint8), minlength=256)
    size, letters = max(1, len(text)), max(1, int(chars[_LETTER].sum()))
    span = int(hits.max() - hits.min() + 1) / n if len(hits) else 0.0
    return [
        np.log1p(count(WORD)),
        np.log1p(count(BEGIN)),
        np.log1p(count(UNHIDDEN)),
        count(WORD) / n,
        count(BEGIN) / n,
        len(hits) / n,
        span,
        near,
        count(YOU) / n,
        count(CAPS) / n,
        int(chars[_UPPER].sum()) / letters,
        int(chars[_MARK].sum()) / size,
        int(chars[33]) / size,
        int(chars[_DIGIT].sum()) / size,
        count(HIDDEN) / n,
        np.log1p(len(tokens)),
    ]


@dataclass(frozen=True)
class ToxicityModel:
    lexicon: Lexicon
    trees: Trees | None  # none if only one class was seen
    calibrated: Isotonic | None
    base: float

    def scores(self, texts: list[str | None], marks: _Marks) -> np.ndarray:
        if self.trees is None:
            return np.full(len(texts), self.base)
        x = np.array([features(text or "", marks) for text in texts]).reshape(-1, FEATURES)
        return self.calibrated(self.trees.margin(x))


def learn_lexicon(rows: DataFrame) -> Lexicon:
    """Terms of `rows` (`text, toxic`) that toxic texts prefer, by number of texts, the strongest first."""
    letters = F.split(F.lower(text_of("text")), r"[^\p{L}]+")
    words = F.array_distinct(F.filter(letters, lambda w: w != ""))
    begins = [F.transform(F.filter("words", lambda w, n=n: F.length(w) > n), lambda w, n=n: F.concat(F.lit("^"), F.substring(w, 1, n))) for n in PREFIXES]
    terms = rows.select("toxic", words.alias("words")).select(
        "toxic", F.explode(F.array_distinct(F.concat("words", *begins))).alias("term")
    )
    total = rows.agg(F.sum("toxic").alias("toxic"), F.count("*").alias("n")).first()
    bad, good = float(total.toxic or 0), float(total.n - (total.toxic or 0))
    counts = terms.groupBy("term").agg(F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("good"))
    odds = F.log((F.col("bad") + 0.5) / (bad + 1)) - F.log((F.col("good") + 0.5) / (good + 1))
    strong = counts.filter(F.col("bad") >= LEAST_TOXIC).withColumn("odds", odds).filter(F.col("odds") >= LEAST_ODDS)
    best = strong.orderBy((F.col("odds") * F.sqrt("bad")).desc(), "term").limit(LEXICON_TERMS).select("term").collect()
    found = [row.term for row in best]
    return Lexicon(
        frozenset(t for t in found if t[0] != "^"), frozenset(t[1:] for t in found if t[0] == "^")
    )


def fit_toxicity(rows: DataFrame) -> ToxicityModel:
    """Fit on `rows` (`text, toxic`, perhaps `stands_for`), a bounded sample.

    Scores are probabilities among the rows that the sample stands for.
    """
    lexicon = learn_lexicon(rows)
    weights = {0: 1.0, 1: 1.0}
    if "stands_for" in rows.columns:
        weights |= {int(r.toxic): r.w for r in rows.groupBy("toxic").agg(F.max("stands_for").alias("w")).collect()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = _Marks(lexicon)
        for batch in slices(batches, BATCH_DOCS):
            x = [features(text or "", marks) for text in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.list_(pa.float64())), batch.column(1)], ["x", "toxic"])

    found = rows.select("text", F.col("toxic").cast("int").alias("toxic")).mapInArrow(run, "x array<double>, toxic int")
    table = found.toPandas()  # TRAIN_ROWS rows of a few numbers
    y = table["toxic"].to_numpy(float)
    bad, good = float(y.sum()) * weights[1], float((1 - y).sum()) * weights[0]
    base = (bad + 0.5) / (bad + good + 1)
    if len(np.unique(y)) < 2:
        return ToxicityModel(lexicon, None, None, base)
    x = np.stack(table["x"].to_numpy())
    order = np.lexsort((*x.T, y))  # the sums of the fit then do not depend on how rows arrive
    x, y = x[order], y[order]
    calibrated = fit_isotonic(out_of_fold(x, y), y)
    # The sample's odds of a class become those of the rows it stands for.
    bad, good = calibrated.share * weights[1], (1 - calibrated.share) * weights[0]
    return ToxicityModel(lexicon, fit_trees(x, y), Isotonic(calibrated.at, bad / (bad + good)), base)


def training_rows(docs: DataFrame, labels: DataFrame, allowed: Column, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """`text, toxic, stands_for` of about `train_rows` labelled documents; `allowed` chooses among `doc_id`.

    Each class may take half of the rows, and what the other leaves: rare toxic
    documents are all there until they fill their half. A row stands for so
    many labelled rows of its class.
    """
    marked = labels.select("doc_id", "toxic").filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & allowed)
    marked = marked.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    bad = F.col("toxic") == 1
    sizes = marked.agg(F.count(F.when(bad, 1)).alias("bad"), F.count(F.when(~bad, 1)).alias("good")).first()

    def chosen(of: Column, n: int, others: int) -> DataFrame:
        most = train_rows - min(others, train_rows // 2)
        some = sampled(marked.filter(of), ["doc_id"], most, n, seed=8)
        return some.withColumn("stands_for", F.lit(max(1.0, n / most)))

    some = chosen(bad, sizes.bad, sizes.good).unionByName(chosen(~bad, sizes.good, sizes.bad))
    # Bounded by `train_rows`, so it may be sent to every task.
    rows = docs.select("doc_id", "text").join(F.broadcast(some), "doc_id").select("text", "toxic", "stands_for")
    return written(rows, "toxicity-sample")


def score_toxicity(docs: DataFrame, model: ToxicityModel, text: str = "text", prefix: str = "") -> DataFrame:
    """`docs` with `score` (0 to 1) and `predicted` (1 from `TOXIC_FROM` on).

    Only `text` is read; null counts as empty and gets a score as well. Every
    row is scored by itself. A model of one class gives its share of toxic rows.
    `prefix` stands before the two names; columns of `docs` that have them already are replaced.
    """
    score, predicted = f"{prefix}score", f"{prefix}predicted"
    names = [c for c in docs.columns if c.lower() not in (score.lower(), predicted.lower())]
    place = names.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = _Marks(model.lexicon)
        for batch in slices(batches, BATCH_DOCS):
            found = model.scores(batch.column(place).to_pylist(), marks)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.float64())], [*names, score])

    rows = docs.select(*names)
    scored = rows.mapInArrow(run, rows.withColumn(score, F.lit(0.0)).schema)
    return scored.withColumn(predicted, (F.col(score) >= TOXIC_FROM).cast("int"))
