"""Quality classifier: random Fourier features over document statistics, ridge by normal equations, isotonic calibration.

Statistics are taken in one pass over the texts and kept as a narrow table. Random cosine
features approximate a Gaussian kernel on the standardized statistics; every partition of
labelled rows sums its own normal equations, Spark adds those up row by row, and the driver
solves one ``features`` x ``features`` system. A part of the labelled rows is held back to fit the isotonic
map from raw scores to probabilities, on score bins, by pooling adjacent violators.

Scale: the driver gets ``features`` + 1 rows of as many numbers and ``bins`` rows of sums, whatever the input.

Edge cases: null and empty texts have statistics (all zero) and so a score; without labelled rows
or with one class only, every score is the share of 1 among them (0.5 if there are none); rows whose
label is null teach nothing; repeated rows are scored one by one; of repeated labels the largest
counts; labels without a document are ignored; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._store import materialize, small_batches
from ._text import BLANK, LOWER, buffer, list_array, prefix_hash, shingle_sets, span_hash, words

NAMES = [
    "log_bytes", "upper", "digit", "blank", "non_ascii", "newline", "comma", "stop", "symbol", "pipe", "exclaim", "mark",
    "mean_word", "sd_word", "short_words", "long_words", "distinct_words", "distinct_shingles", "distinct_lines", "words_per_line", "words_per_stop", "capital_starts",
]


def _class(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


_LETTERS = _class(b"abcdefghijklmnopqrstuvwxyz")
_UPPER = _class(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_SETS = {
    "upper": _UPPER,
    "digit": _class(b"0123456789"),
    "blank": BLANK,
    "non_ascii": np.arange(256) >= 128,
    "newline": _class(b"\n"),
    "comma": _class(b",;:"),
    "stop": _class(b".?!"),
    "symbol": _class(b"#$%&*@^~=+<>/\\_{}[]"),
    "pipe": _class(b"|"),
    "exclaim": _class(b"!"),
    "mark": ~(_LETTERS | _UPPER | _class(b"0123456789") | BLANK | (np.arange(256) >= 128)),
}
_NOT_NEWLINE = ~_SETS["newline"]


def _per_doc(values: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(doc, weights=values, minlength=n)


def _distinct(hashes: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    """Distinct over all, per document; 1 where there is none."""
    order = np.lexsort((hashes, doc))
    h, d = hashes[order], doc[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
    total = np.bincount(doc, minlength=n)
    return np.where(total > 0, np.bincount(d[new], minlength=n) / np.maximum(total, 1), 1.0)


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of ``NAMES`` for each text."""
    n = len(offsets) - 1
    size = np.diff(offsets)
    full = np.maximum(size, 1)
    out = {"log_bytes": np.log1p(size)}
    count = {}
    for name, chars in _SETS.items():
        sums = np.concatenate([[0], np.cumsum(chars[data], dtype=np.int64)])
        count[name] = sums[offsets[1:]] - sums[offsets[:-1]]
        out[name] = count[name] / full
    start, end, doc = words(data, offsets, BLANK)
    k = np.bincount(doc, minlength=n)
    some = np.maximum(k, 1)
    length = (end - start).astype(float)
    out["mean_word"] = _per_doc(length, doc, n) / some
    out["sd_word"] = np.sqrt(np.maximum(_per_doc(length**2, doc, n) / some - out["mean_word"] ** 2, 0))
    out["short_words"] = _per_doc(length <= 3, doc, n) / some
    out["long_words"] = _per_doc(length >= 12, doc, n) / some
    prefix = prefix_hash(LOWER[data])
    out["distinct_words"] = _distinct(span_hash(prefix, start, end), doc, n) if len(start) else np.ones(n)
    _, bounds = shingle_sets(data, offsets, 3)
    out["distinct_shingles"] = np.where(k > 0, np.diff(bounds) / np.maximum(k - 2, 1), 1.0)
    ls, le, ldoc = words(data, offsets, ~_NOT_NEWLINE)
    lines = np.maximum(np.bincount(ldoc, minlength=n), 1)
    out["distinct_lines"] = _distinct(span_hash(prefix, ls, le), ldoc, n) if len(ls) else np.ones(n)
    out["words_per_line"] = np.log1p(k / lines)
    out["words_per_stop"] = np.log1p(k / np.maximum(count["stop"], 1))
    out["capital_starts"] = _per_doc(_UPPER[data[start]], doc, n) / some if len(start) else np.zeros(n)
    return np.stack([out[x] for x in NAMES], axis=1)


def document_statistics(docs: DataFrame) -> DataFrame:
    """doc_id, stats array<double>: one scan of the texts."""
    small_batches(docs.sparkSession)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = statistics(*buffer(batch.column(1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), list_array(x.ravel(), np.arange(len(x) + 1) * len(NAMES), pa.float64())], names=["doc_id", "stats"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(scan, "doc_id long, stats array<double>")


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


class Model:
    """Standardization, random features, weights and the calibration map; a few hundred KB, sent with the tasks."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, features: int, gamma: float, seed: int):
        r = np.random.default_rng(seed)
        self.mean, self.scale = mean, scale
        self.w = r.normal(size=(len(mean), features)) * np.sqrt(2 * gamma)
        self.b = r.uniform(0, 2 * np.pi, features)
        self.beta = np.zeros(features + 1)
        self.knots, self.values = np.array([0.0]), np.array([0.5])

    def transform(self, stats: np.ndarray) -> np.ndarray:
        z = np.clip((stats - self.mean) / self.scale, -8, 8)
        x = np.cos(z @ self.w + self.b) * np.sqrt(2 / len(self.b))
        return np.concatenate([x, np.ones((len(x), 1))], axis=1)

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.transform(stats) @ self.beta

    def score(self, stats: np.ndarray) -> np.ndarray:
        return np.interp(self.raw(stats), self.knots, self.values)


def isotonic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators over points sorted by x: (mean x, mean y) of the pools, y not falling."""
    pools: list[list[float]] = []
    for a, b, w in zip(x, y, weight, strict=True):
        pools.append([a * w, b * w, w])
        while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
            last = pools.pop()
            pools[-1] = [p + q for p, q in zip(pools[-1], last, strict=True)]
    return np.array([p[0] / p[2] for p in pools]), np.array([p[1] / p[2] for p in pools])


def fit(labelled: DataFrame, features: int = 256, gamma: float = 0.03, ridge: float = 1.0, bins: int = 400, seed: int = 7, groups: int = 64) -> Model:
    """Fit on rows (doc_id, stats, y): four fifths for the weights, one fifth for the calibration."""
    k = len(NAMES)
    held = F.pmod(F.xxhash64("doc_id", F.lit("calibration")), F.lit(5)) == 0
    head = labelled.select(F.count("*").alias("n"), F.avg("y").alias("y"), *[F.avg(F.col("stats")[i]).alias(f"m{i}") for i in range(k)], *[F.stddev_pop(F.col("stats")[i]).alias(f"s{i}") for i in range(k)]).first()
    if not head["n"] or head["y"] in (0.0, 1.0):
        model = Model(np.zeros(k), np.ones(k), features, gamma, seed)
        model.values = np.array([0.5 if not head["n"] else head["y"]])
        return model
    model = Model(np.array([head[f"m{i}"] for i in range(k)]), np.maximum([head[f"s{i}"] for i in range(k)], 1e-6), features, gamma, seed)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((features + 1, features + 2))
        for batch in batches:
            z = model.transform(_matrix(batch.column(0), k))
            total[:, :-1] += z.T @ z
            total[:, -1] += z.T @ batch.column(1).to_numpy(zero_copy_only=False)
        group = np.full(features + 1, TaskContext.get().partitionId() % groups)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(features + 1), pa.int32()), pa.array(group, pa.int32()), list_array(total.ravel(), np.arange(features + 2) * (features + 2), pa.float64())], names=["i", "part", "row"])

    def add(table: pa.Table) -> pa.Table:
        rows = table.column("row").combine_chunks()
        total = _matrix(rows, features + 2).sum(axis=0)
        return pa.table({"i": table.column("i")[:1], "part": table.column("part")[:1], "row": list_array(total, np.array([0, len(total)]), pa.float64())})

    system = labelled.filter(~held).select("stats", "y").mapInArrow(sums, "i int, part int, row array<double>")
    for keys in (["i", "part"], ["i"]):  # partitions sum up in groups, and those in turn
        system = system.groupBy(*keys).applyInArrow(add, "i int, part int, row array<double>")
    system = np.array([r["row"] for r in sorted(system.collect())])
    penalty = ridge * np.eye(features + 1)
    penalty[-1, -1] = 0
    model.beta = np.linalg.solve(system[:, :-1] + penalty, system[:, -1])

    def raw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(model.raw(_matrix(batch.column(0), k))), batch.column(1)], names=["raw", "y"])

    scored = labelled.filter(held).select("stats", "y").mapInArrow(raw, "raw double, y double")
    bin_ = F.floor(F.greatest(F.lit(0.0), F.least(F.lit(0.999999), (F.col("raw") + 0.5) / 2)) * bins)
    pooled = scored.groupBy(bin_.alias("b")).agg(F.avg("raw").alias("x"), F.avg("y").alias("y"), F.count("*").alias("n"))
    got = sorted(pooled.collect(), key=lambda r: r["x"])
    if got:
        x, y, n = (np.array([r[c] for r in got], float) for c in ("x", "y", "n"))
        model.knots, model.values = isotonic(x, y, n)
    else:
        model.knots, model.values = np.array([0.0, 1.0]), np.array([0.0, 1.0])
    return model


def predict(stats: DataFrame, model: Model) -> DataFrame:
    """doc_id, score of every row."""
    k = len(NAMES)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.clip(model.score(_matrix(batch.column(1), k)), 0, 1))], names=["doc_id", "score"])

    return stats.select("doc_id", "stats").mapInArrow(score, "doc_id long, score double")


def labelled_rows(rows: DataFrame, labels: DataFrame, column: str, train: Column) -> DataFrame:
    """``rows`` with y from ``labels[column]``, where ``train`` holds; one y per doc_id."""
    y = labels.filter(F.col(column).isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(column).cast("double").alias("y"))
    return rows.filter(train).join(y, "doc_id")


def bucket(column: str, n: int) -> Column:
    """crc32 of the id as text, modulo n."""
    return F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(n))


def classify_quality(docs: DataFrame, labels: DataFrame, folds: int = 5, threshold: float = 0.3, **options) -> DataFrame:
    """doc_id, held_out, score, predicted for every row; labels of fold 0 are never used."""
    stats = materialize(document_statistics(docs), "quality-stats")
    model = fit(labelled_rows(stats, labels, "quality", F.coalesce(bucket("doc_id", folds) != 0, F.lit(False))), **options)
    held = F.coalesce(bucket("doc_id", folds) == 0, F.lit(False))
    return predict(stats, model).select("doc_id", held.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def reject_low_quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, **options) -> DataFrame:
    """``docs`` without the rows scored below ``threshold``; columns and values as they were."""
    small_batches(docs.sparkSession)
    stats = materialize(document_statistics(docs), "quality-stats")
    model = fit(labelled_rows(stats, labels, "quality", F.coalesce(bucket("doc_id", 5) != 0, F.lit(False))), **options)
    return keep_scored(docs, model, threshold)


def keep_scored(docs: DataFrame, model: Model, threshold: float) -> DataFrame:
    """The rows of ``docs`` whose text scores at least ``threshold``; a second scan instead of a join."""
    names, at = docs.columns, docs.columns.index("text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = model.score(statistics(*buffer(batch.column(at))))
            yield pa.RecordBatch.from_arrays(batch.filter(pa.array(score >= threshold)).columns, names=names)

    return docs.mapInArrow(keep, docs.schema)
