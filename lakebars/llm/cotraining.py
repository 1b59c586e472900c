"""Quality scores by co-training of a text view and a metadata view.

The text view is boosted trees over shape features of the text; the metadata
view is a logistic model of the other columns. Over a few rounds each view labels
the unlabelled documents it is sure of, by its calibrated score, and these join
the other view's training rows. At the end both views are calibrated on labelled
rows that neither has trained on, and their odds are combined.

Of labelled documents the fit takes a bounded sample, of unlabelled ones all: they
stay spread over the executors, and the driver gets sums only, by bin for the
trees and by combination of metadata categories for the logistic model. Every row
is scored over its whole text.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import add, eq
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakebars.llm.boosting import (
    Isotonic,
    Trees,
    add_counts,
    bucket_counts,
    bucket_edges,
    codes,
    fit_isotonic,
    grow_trees,
    level_sums,
)
from lakebars.llm.common import sampled, slices, written

LABELLED_ROWS = 16_000
ROUNDS = 3
SURE = 0.95  # calibrated probability from which a view's label counts for the other
GOOD_FROM = 0.5
CALIBRATION = 4  # one labelled row in so many calibrates and is not trained on
METADATA = ("source", "lang", "n_chars")
CATEGORIES = 64
RIDGE = 1.0
BATCH_DOCS = 512
BLOCK_ROWS = 8_192
CONJUGATE_STEPS = 200

_SYMBOLS = np.array([c in b"#$%&*|@^~<>=+\\/_" for c in range(256)])
_UPPER = np.array([chr(c).isupper() for c in range(256)])
_LETTER = np.array([chr(c).isalpha() for c in range(256)])
_POINTS = np.array([c in b".,;:!?'\"()-" for c in range(256)])


def content_features(text: str) -> list[float]:
    """Repetition, line and character shapes of a text."""
    tokens = text.split()
    n = max(1, len(tokens))
    chars = np.bincount(np.frombuffer(text.encode("latin-1", "replace"), np.uint8), minlength=256)
    size, letters = max(1, len(text)), max(1, int(chars[_LETTER].sum()))
    lines = [line for line in text.split("\n") if line.strip()]
    lengths = np.fromiter(map(len, tokens), np.int64, len(tokens)) if tokens else np.zeros(1, np.int64)
    return [
        np.log1p(len(tokens)),
        len(set(tokens)) / n,
        max(Counter(tokens).values(), default=0) / n,
        sum(map(eq, tokens, tokens[1:])) / n,
        len(set(zip(tokens, tokens[1:], strict=False))) / max(1, n - 1),
        float(lengths.mean()),
        float((lengths > 20).mean()),
        float((lengths == 1).mean()),
        sum(map(str.isupper, tokens)) / n,
        np.log1p(len(lines)),
        len(set(lines)) / max(1, len(lines)),
        len(tokens) / max(1, len(lines)),
        int(chars[_UPPER].sum()) / letters,
        letters / size,
        int(chars[48:58].sum()) / size,
        int(chars[_SYMBOLS].sum()) / size,
        int(chars[_POINTS].sum()) / size,
        int(chars[33]) / size,
        int(chars[124]) / size,
        int(chars[63]) / size,
    ]


def metadata_categories(values: Sequence[object]) -> list[int]:
    """A category per column: of a number its magnitude, of anything else its hash; null is a category too."""
    found = []
    for place, value in enumerate(values):
        if isinstance(value, (int, float)) and value == value:
            value = f"size {min(40, int(2 * np.log2(1 + abs(value))))}"
        found.append(place * CATEGORIES + zlib.crc32(repr(value).encode()) % CATEGORIES)
    return found


@dataclass(frozen=True)
class Logistic:
    weights: np.ndarray  # of the categories, then the constant

    def margin(self, x: np.ndarray) -> np.ndarray:
        return self.weights[x].sum(axis=1) + self.weights[-1]


def fit_logistic(x: np.ndarray, y: np.ndarray, categories: int, steps: int = 12, rows: np.ndarray | None = None) -> Logistic:
    """Ridge-penalised Newton steps; `x` holds the categories of each row, which stands for so many `rows`.

    Each step is solved by conjugate gradients, which need memory for the rows
    and the categories but not for pairs of categories.
    """
    rows = np.ones(len(x)) if rows is None else rows
    ridge = np.full(categories + 1, RIDGE)
    ridge[-1] = 1e-6

    def gathered(w: np.ndarray) -> np.ndarray:
        total = sum(np.bincount(column, w, categories + 1) for column in x.T)
        total[-1] = w.sum()
        return total

    weights = np.zeros(categories + 1)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(Logistic(weights).margin(x), -30, 30)))
        bend = rows * p * (1 - p)
        scale = gathered(bend) + ridge
        rest = gathered(rows * (y - p)) - ridge * weights
        step, limit = np.zeros_like(weights), 1e-10 * np.sqrt((rest**2 / scale).sum())
        way = rest / scale
        size = rest @ way
        for _ in range(CONJUGATE_STEPS):
            if size <= limit**2 or size == 0:
                break
            image = gathered(bend * Logistic(way).margin(x)) + ridge * way
            length = size / (way @ image)
            step, rest = step + length * way, rest - length * image
            last, size = size, rest @ (rest / scale)
            way = rest / scale + size / last * way
        weights = weights + step
    return Logistic(weights)


def _odds(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


@dataclass(frozen=True)
class QualityModel:
    base: float
    content: Trees | None  # none if only one class was seen
    metadata: Logistic | None
    content_share: Isotonic | None
    metadata_share: Isotonic | None

    def scores(self, content: np.ndarray, metadata: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Combined score, and the calibrated score of either view."""
        if self.content is None:
            same = np.full(len(content), self.base)
            return same, same, same
        text = self.content_share(self.content.margin(content))
        meta = self.metadata_share(self.metadata.margin(metadata))
        odds = _odds(text) + _odds(meta) - _odds(np.array(self.base))
        return 1 / (1 + np.exp(-odds)), text, meta


class Pool(Protocol):
    """Blocks of rows, held wherever they are."""

    def each(self, change: Callable) -> Pool: ...

    def total(self, measure: Callable, plus: Callable = add) -> object | None:
        """`measure` of all blocks, added; none without blocks."""

    def done(self) -> None: ...


@dataclass(frozen=True)
class Here:
    blocks: list

    def each(self, change: Callable) -> Here:
        return Here([change(block) for block in self.blocks])

    def total(self, measure: Callable, plus: Callable = add) -> object | None:
        return reduce(plus, map(measure, self.blocks)) if self.blocks else None

    def done(self) -> None:
        pass


@dataclass(frozen=True)
class Spread:
    blocks: RDD

    def each(self, change: Callable) -> Spread:
        return Spread(self.blocks.map(change).persist(StorageLevel.MEMORY_AND_DISK))

    def total(self, measure: Callable, plus: Callable = add) -> object | None:
        def part(blocks: Iterator) -> Iterator:
            found = [measure(block) for block in blocks]
            return iter([reduce(plus, found)] if found else [])

        parts = self.blocks.mapPartitions(part).collect()
        return reduce(plus, parts) if parts else None

    def done(self) -> None:
        self.blocks.unpersist()


def _sure(share: np.ndarray) -> np.ndarray:
    return np.where(share >= SURE, 1, np.where(share <= 1 - SURE, 0, -1))


def _combinations(metadata: np.ndarray, label: np.ndarray) -> Counter:
    """Rows of each combination of categories and sure label."""
    return Counter(map(tuple, np.column_stack([metadata, label])[label >= 0].tolist()))


def fit_views(
    content: np.ndarray, metadata: np.ndarray, y: np.ndarray, held: np.ndarray, columns: int = len(METADATA), rounds: int = ROUNDS
) -> QualityModel:
    """Co-train on rows with `y` 0 or 1 and the pool, whose `y` is -1; rows `held` only calibrate."""
    known = y >= 0
    pool = Here([] if known.all() else [(content[~known], metadata[~known])])
    return co_train(content[known], metadata[known], y[known], held[known], pool, columns, rounds)


def co_train(
    content: np.ndarray, metadata: np.ndarray, y: np.ndarray, held: np.ndarray, pool: Pool, columns: int, rounds: int = ROUNDS
) -> QualityModel:
    """Co-train on labelled rows and the whole `pool` of pairs like `content, metadata`; rows `held` only calibrate."""
    known, check = ~held, held
    if not check.any():
        check = known
    base = float((y.sum() + 0.5) / (len(y) + 1))
    if len(np.unique(y[known])) < 2 or len(np.unique(y[check])) < 2:
        return QualityModel(base, None, None, None, None)
    own = content[known], metadata[known], y[known]
    model: QualityModel | None = None
    for turn in range(rounds + 1):
        taught, combined = Here([]), _combinations(own[1], own[2])
        if model is not None:
            combined += pool.total(lambda block, m=model: _combinations(block[1], _sure(m.scores(*block)[1]))) or Counter()
            taught = pool.each(lambda block, m=model: _labelled(block[0], _sure(m.metadata_share(m.metadata.margin(block[1])))))
        trees = _text_view(own[0], own[2], taught)
        taught.done()
        table = np.array([(*key, n) for key, n in sorted(combined.items())])
        linear = fit_logistic(table[:, :columns], table[:, columns], columns * CATEGORIES, rows=table[:, -1].astype(float))
        shares = [
            fit_isotonic(m.margin(x[check]), y[check].astype(float)) for m, x in ((trees, content), (linear, metadata))
        ]
        model = QualityModel(base, trees, linear, *shares)
    pool.done()
    return model


def _labelled(content: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return content[label >= 0], label[label >= 0]


def _text_view(content: np.ndarray, y: np.ndarray, taught: Pool) -> Trees:
    """Trees of the rows given and of the blocks of `taught`, by sums over both."""
    plus = lambda a, b: a if b is None else a + b
    good, rows = plus(np.array([y.sum(), len(y)]), taught.total(lambda block: np.array([block[1].sum(), len(block[1])])))
    counts, others = bucket_counts(content), taught.total(lambda block: bucket_counts(block[0]), add_counts)
    edges = bucket_edges(counts if others is None else add_counts(counts, others), content.shape[1])
    if rows == len(y):
        taught = Here([])
    code = codes(content, edges)
    coded = taught.each(lambda block: (codes(block[0], edges), block[1]))

    def sums(trees: Trees, r: int, level: int) -> np.ndarray:
        return plus(level_sums(code, y, trees, r, level), coded.total(lambda block: level_sums(*block, trees, r, level)))

    trees = grow_trees(edges, (good + 0.5) / (rows + 1), sums)
    coded.done()
    return trees


def training_rows(
    docs: DataFrame, labels: DataFrame, allowed: Column, labelled: int = LABELLED_ROWS, metadata: Sequence[str] = METADATA
) -> DataFrame:
    """`content, *metadata, quality, held`: about `labelled` labelled documents, and all without a label, whose `quality` is null.

    `content` holds the features of the text; texts are not shuffled.
    """
    marked = labels.filter(F.col("doc_id").isNotNull()).select("doc_id", "quality")
    graded = marked.filter(F.col("quality").isNotNull() & allowed).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    some = sampled(graded, ["doc_id"], labelled, graded.count(), seed=7)
    marks = marked.select("doc_id").distinct().join(some, "doc_id", "left")
    marks = written(marks.select("doc_id", F.col("quality").cast("int").alias("quality"), F.lit(True).alias("marked")), "quality-marks")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, BATCH_DOCS):
            content = pa.array([content_features(t or "") for t in batch.column(0).to_pylist()], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([content, *batch.columns[1:]], ["content", *batch.schema.names[1:]])

    texts = docs.filter(F.col("doc_id").isNotNull()).select(
        F.col("text").alias("content"), "doc_id", *(F.col(c).alias(f"m{i}") for i, c in enumerate(metadata))
    )
    found = texts.mapInArrow(run, texts.withColumn("content", F.lit(None).cast("array<double>")).schema)
    held = F.pmod(F.xxhash64(F.lit(77), "doc_id"), F.lit(CALIBRATION)) == 0
    # A label that is not among the sampled ones makes no document unlabelled.
    rows = found.join(marks, "doc_id", "left").filter(F.col("marked").isNull() | F.col("quality").isNotNull())
    names = (F.col(f"m{i}").alias(c) for i, c in enumerate(metadata))
    return written(rows.select("content", *names, "quality", held.alias("held")), "quality-rows")


def _views(batch: pa.RecordBatch, text: int, metadata: Sequence[int]) -> tuple[np.ndarray, np.ndarray]:
    content = np.array([content_features(t or "") for t in batch.column(text).to_pylist()])
    rows = zip(*(batch.column(place).to_pylist() for place in metadata), strict=True)
    return content, np.array([metadata_categories(row) for row in rows], np.int64)


def _features(lists: pa.Array) -> np.ndarray:
    return lists.flatten().to_numpy().reshape(len(lists), -1)


def fit_quality(rows: DataFrame, metadata: Sequence[str] = METADATA) -> QualityModel:
    """Fit on the rows of `training_rows`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, BLOCK_ROWS):
            if not batch.num_rows:
                continue
            columns = zip(*(column.to_pylist() for column in batch.columns[1:]), strict=True)
            other = np.array([metadata_categories(row) for row in columns], np.int32)
            blocks = pa.array([_features(batch.column(0)).tobytes()]), pa.array([other.tobytes()])
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), *blocks], ["n", "content", "other"])

    def block(row: tuple) -> tuple[np.ndarray, np.ndarray]:
        return np.frombuffer(row[1]).reshape(row[0], -1), np.frombuffer(row[2], np.int32).reshape(row[0], -1)

    table = rows.filter(F.col("quality").isNotNull()).toPandas()  # a bounded sample of a few numbers a row
    if table.empty:
        return QualityModel(0.5, None, None, None, None)
    content = np.stack(table["content"].to_numpy())
    values = table[list(metadata)].astype(object)
    values = values.where(values.notna(), None)
    other = np.array([metadata_categories(row) for row in values.itertuples(index=False, name=None)], np.int64)
    y, held = table["quality"].to_numpy(np.int64), table["held"].to_numpy(bool)
    order = np.lexsort((*content.T, *other.T, y))  # the fit then does not depend on how rows arrive
    bare = rows.filter(F.col("quality").isNull()).select("content", *metadata)
    blocks = bare.mapInArrow(run, "n long, content binary, other binary").rdd
    pool = Spread(blocks.coalesce(rows.sparkSession.sparkContext.defaultParallelism)).each(block)
    return co_train(content[order], other[order], y[order], held[order], pool, len(metadata))


def score_quality(
    docs: DataFrame, model: QualityModel, metadata: Sequence[str] = METADATA, text: str = "text", prefix: str = ""
) -> DataFrame:
    """`docs` with `score` (0 to 1, higher: better), `content_score`, `metadata_score` and `predicted` (1 from `GOOD_FROM` on).

    A null text counts as empty, a null in a metadata column is a value of its
    own. Every row is scored by itself. If the labels show one class only, every
    score is its share. `prefix` stands before the four names; columns of `docs`
    that have them already are replaced.
    """
    made = [f"{prefix}{name}" for name in ("score", "content_score", "metadata_score")]
    predicted = f"{prefix}predicted"
    names = [c for c in docs.columns if c.lower() not in {new.lower() for new in (*made, predicted)}]
    at, places = names.index(text), [names.index(c) for c in metadata]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, BATCH_DOCS):
            scores = model.scores(*_views(batch, at, places))
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(s, pa.float64()) for s in scores)], [*names, *made])

    rows = docs.select(*names)
    schema = rows.select("*", *(F.lit(0.0).alias(c) for c in made)).schema
    return rows.mapInArrow(run, schema).withColumn(predicted, (F.col(made[0]) >= GOOD_FROM).cast("int"))
