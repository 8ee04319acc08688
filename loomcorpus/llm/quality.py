"""Quality rules: plain text measures, and a calibrated classifier where the rules pass a text.

The classifier is a logistic regression over the frequencies of hashed words, word pairs and
``GRAM``-character grams (a quarter, a quarter and half of the table), trained on a bounded sample of the labelled rows; a Platt scale fitted on a held-out part of that sample
turns its margin into a probability, which is held against a fixed threshold. Texts are scored in
Arrow batches with numpy: every word, pair and gram looks its weight up in one table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomcorpus.llm.shingles import _SPACE, chunks, mix, word_hashes

BITS = 16
DIMENSIONS = 1 << BITS
GRAM = 4
#: Bound of the fit: so many labelled rows, chosen by a hash of their id.
TRAINING_ROWS = 6000
THRESHOLD = 0.5
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
_EPOCHS, _RATE, _DECAY = 30, 0.5, 1e-6
_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>")] = True


@dataclass(frozen=True)
class Classifier:
    """Weights per hashed feature, bias, and the Platt scale of the margin."""

    weights: np.ndarray
    bias: float
    slope: float
    shift: float


def _per_row(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    sums = np.concatenate(([0], np.cumsum(flags)))
    return sums[bounds[1:]] - sums[bounds[:-1]]


def _repeated(values: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each value within its row: whether it occurs twice or more, and whether it did before."""
    order = np.lexsort((np.arange(len(values)), values, rows))
    v, r = values[order], rows[order]
    same = np.concatenate(([False], (v[1:] == v[:-1]) & (r[1:] == r[:-1]))) if len(v) else np.zeros(0, bool)
    again, twice = np.zeros(len(v), bool), np.zeros(len(v), bool)
    again[order] = same
    twice[order] = same | np.append(same[1:], False)
    return twice, again


def measures(texts: pa.Array) -> Iterator[dict[str, np.ndarray]]:
    """The rule measures of each text, chunk by chunk (no lower-casing)."""
    for first, last, buffer, row_starts in chunks(texts, lower=False):
        bounds = np.append(row_starts, len(buffer))
        words, at = word_hashes(buffer)
        word_bounds = np.append(np.searchsorted(at, row_starts), len(words))
        rows = np.repeat(np.arange(last - first), np.diff(word_bounds))
        points = ~_SPACE[buffer] & ((buffer & 0xC0) != 0x80)
        covered = np.zeros(len(words), bool)
        if len(words) > 2:
            windows = mix(words[:-2] * np.uint64(3) + mix(words[1:-1] * np.uint64(5) + words[2:]))
            inside = rows[:-2] == rows[2:]
            twice, _ = _repeated(windows[inside], rows[:-2][inside])
            hit = np.flatnonzero(inside)[twice]
            for i in range(3):
                covered[hit + i] = True
        # Lines: from one newline to the next; rows end in one that isn't part of the text.
        ends = np.flatnonzero(buffer == 0x0A)
        starts = np.concatenate(([0], ends[:-1] + 1)) if len(ends) else ends
        has_word = np.searchsorted(at, ends) > np.searchsorted(at, starts)
        lines = _line_hashes(buffer, starts, ends)[has_word]
        line_rows = np.searchsorted(row_starts, starts[has_word], "right") - 1
        _, again = _repeated(lines, line_rows)
        yield {
            "n_words": np.diff(word_bounds),
            "word_chars": _per_row(points, bounds),
            "n_symbols": _per_row(_SYMBOL[buffer], bounds),
            "n_dup_lines": np.bincount(line_rows[again], minlength=last - first),
            "n_repeat_words": _per_row(covered, word_bounds),
        }


def _line_hashes(buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each line's bytes: a sum of mixed (byte, place in line) values, and the length."""
    lengths = ends - starts + 1
    place = np.arange(len(buffer)) - np.repeat(starts, lengths)
    values = mix(buffer.astype(np.uint64) + (place.astype(np.uint64) << np.uint64(8)) + np.uint64(1 << 50))
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)))
    return mix((sums[ends] - sums[starts]) + lengths.astype(np.uint64))


def _features(buffer: np.ndarray, row_starts: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Hashed words, word pairs and character grams of a chunk, each as ``(index, first, end)`` with the
    bounds of each row. No gram reaches beyond its row, so a row has the same features in any batch."""
    ends = np.append(row_starts[1:], len(buffer)) - 1  # the newline that sets rows apart
    words, at = word_hashes(buffer)
    low, high = np.searchsorted(at, row_starts), np.searchsorted(at, ends)
    single = (words >> np.uint64(64 - BITS + 2)).astype(np.int32)
    pairs = (mix(words[:-1] * np.uint64(3) + words[1:]) >> np.uint64(64 - BITS + 2)).astype(np.int32) + DIMENSIONS // 4
    # Characters: the places of the code points, and what they are.
    places = np.cumsum((buffer & 0xC0) != 0x80) - 1
    points = np.frombuffer(buffer.tobytes().decode().encode("utf-32-le"), np.uint32)
    grams = np.zeros(max(0, len(points) - GRAM + 1), np.uint64)
    for i in range(GRAM if len(grams) else 0):
        grams = grams * np.uint64(0x9E3779B97F4A7C15) + points[i : i + len(grams)]
    grams = (mix(grams) >> np.uint64(64 - BITS + 1)).astype(np.int32) + DIMENSIONS // 2
    first = places[row_starts]
    # (The newline behind a row is one of its characters, the end of its last word.)
    return [(single, low, high), (pairs, low, np.maximum(low, high - 1)), (grams, first, np.maximum(first, places[ends] - GRAM + 2))]


def _means(weights: np.ndarray, found: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
    index, first, end = found
    out = np.zeros(len(first))
    for i in np.flatnonzero(end > first):
        # A sum of its own for each row: it doesn't depend on the rows before.
        out[i] = weights[index[first[i] : end[i]]].sum(dtype=np.float64) / (end[i] - first[i])
    return out


def probabilities(model: Classifier, texts: pa.Array) -> Iterator[np.ndarray]:
    for _, _, buffer, row_starts in chunks(texts):
        margin = sum(_means(model.weights, found) for found in _features(buffer, row_starts)) + model.bias
        yield 1 / (1 + np.exp(-np.clip(model.slope * margin + model.shift, -60, 60)))


def _train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Fit on all rows of one task (at most ``TRAINING_ROWS``) and yield the packed model."""
    samples, labels = [], []
    for batch in batches:
        texts, good = batch.column("text"), batch.column("good").to_pylist()
        labels += good
        for _, _, buffer, row_starts in chunks(texts):
            found = _features(buffer, row_starts)
            for i in range(len(row_starts)):
                each = [np.unique(values[first[i] : end[i]], return_counts=True) for values, first, end in found]
                samples.append((np.concatenate([x[0] for x in each]), np.concatenate([x[1] / max(1, x[1].sum()) for x in each])))
    y = np.array(labels, dtype=np.float64)
    weights, bias = np.zeros(DIMENSIONS), 0.0
    squares = np.full(DIMENSIONS, 1e-8)
    held = np.arange(len(y)) % 5 == 0
    rng = np.random.default_rng(0)
    fitted = np.flatnonzero(~held)
    for _ in range(_EPOCHS if len(set(labels)) > 1 else 0):
        for i in rng.permutation(fitted):
            ids, x = samples[i]
            g = 1 / (1 + np.exp(-np.clip(weights[ids] @ x + bias, -60, 60))) - y[i]
            step = g * x + _DECAY * weights[ids]
            squares[ids] += step * step
            weights[ids] -= _RATE * step / np.sqrt(squares[ids])
            bias -= 0.02 * g
    slope, shift = 1.0, 0.0
    margins = np.array([weights[samples[i][0]] @ samples[i][1] + bias for i in np.flatnonzero(held)])
    target = y[held]
    if len(set(target)) > 1:
        # Platt: smoothed targets, Newton steps on slope and shift.
        n1, n0 = target.sum(), (1 - target).sum()
        soft = np.where(target > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
        scale = max(1e-9, np.abs(margins).max())
        a, b, z = 1.0, 0.0, margins / scale
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(a * z + b, -60, 60)))
            w = p * (1 - p) + 1e-9
            grad = np.array([((p - soft) * z).sum() + 1e-3 * a, (p - soft).sum()])
            hess = np.array([[(w * z * z).sum() + 1e-3, (w * z).sum()], [(w * z).sum(), w.sum() + 1e-6]])
            a, b = np.array([a, b]) - np.linalg.solve(hess, grad)
        slope, shift = a / scale, b
    yield pa.record_batch([pa.array([weights.astype(np.float32).tobytes()]), pa.array([bias]), pa.array([slope]), pa.array([shift])], names=["weights", "bias", "slope", "shift"])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Classifier:
    """Train on at most ``TRAINING_ROWS`` labelled texts, chosen by a hash of the id.

    Rows with a null text or label are left out; repeated labels of an id count once, the greatest
    holding, and so do repeated texts of an id, the one of least hash. Without both classes the model is neutral: probability 0.5 for every text.
    """
    marks = labels.where(F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).alias("good"))
    chosen = marks.orderBy(F.xxhash64("id"), "id").limit(TRAINING_ROWS)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where("text is not null")
    rows = rows.join(F.broadcast(chosen), "id").groupBy("id", "good").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text"))["text"].alias("text"))
    rows = rows.repartition(1).sortWithinPartitions(F.xxhash64("id"), "id")
    r = rows.select("text", F.col("good").cast("int").alias("good")).mapInArrow(_train, "weights binary, bias double, slope double, shift double").first()
    if r is None:
        return Classifier(np.zeros(DIMENSIONS, np.float32), 0.0, 1.0, 0.0)
    return Classifier(np.frombuffer(r.weights, np.float32), r.bias, r.slope, r.shift)


def _judged(batches: Iterator[pa.RecordBatch], model: Classifier, threshold: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text")
        if not len(texts):
            continue
        found = list(measures(texts))
        m = {k: np.concatenate([x[k] for x in found]).astype(np.int64) for k in found[0]}
        p = np.concatenate(list(probabilities(model, texts)))
        failed = (m["n_words"] < MIN_WORDS) | (100 * m["n_repeat_words"] > MAX_REPEAT_PERCENT * m["n_words"])
        columns = {name: batch.column(name) for name in batch.schema.names if name != "text"}
        columns |= {k: pa.array(v) for k, v in m.items()}
        columns |= {"base_failed": pa.array(failed), "quality": pa.array(p), "kept": pa.array(~failed & (p >= threshold))}
        yield pa.record_batch(list(columns.values()), names=list(columns))


def judge(docs: DataFrame, model: Classifier, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Measures, ``base_failed``, calibrated ``quality`` and ``kept`` of every row.

    Null and empty texts have no words, so they fail the base rules. Ties at the threshold are kept.
    Repeated rows each get the same result, whatever rows share their batch. Other columns are ignored.
    """
    rows = docs.select(F.col(id_col), F.col(text_col).alias("text"))
    kind = rows.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, quality double, kept boolean"
    return rows.mapInArrow(lambda b: _judged(b, model, threshold), schema)


_MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = list(measures(batch.column("text")))
        columns = [pa.array(np.concatenate([x[k] for x in found]).astype(np.int64) if found else np.empty(0, np.int64)) for k in _MEASURES]
        yield pa.record_batch([batch.column("id"), *columns], names=["id", *_MEASURES])


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The base measures of every row and ``base_failed``, without a model. Null and empty texts have no words and fail."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    out = rows.mapInArrow(_measured, f"id {rows.schema['id'].dataType.simpleString()}, {', '.join(f'{k} long' for k in _MEASURES)}")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return out.select(F.col("id").alias(id_col), *_MEASURES, failed.alias("base_failed"))


#: Of the measures, which need no model.
MEASURES_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents
), w AS (SELECT doc_id, t, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM d
), g AS (SELECT doc_id, i, (w[i], w[i + 1], w[i + 2]) AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM w WHERE len(w) > 2)
), r AS (SELECT doc_id, g FROM g GROUP BY doc_id, g HAVING count(*) > 1
), c AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM g SEMI JOIN r USING (doc_id, g)) GROUP BY doc_id
), l AS (SELECT doc_id, count(*) - count(DISTINCT x) AS n FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS x FROM d) WHERE regexp_matches(x, '[^\x20\x09-\x0D]') GROUP BY doc_id
), m AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
    CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, coalesce(l.n, 0) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words
  FROM w LEFT JOIN l USING (doc_id) LEFT JOIN c USING (doc_id)
)
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m
"""
