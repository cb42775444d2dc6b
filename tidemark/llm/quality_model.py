"""A factorisation machine over hashed words, structure statistics and text metadata.

score = sigmoid(w0 + sum w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j), where the pairwise sum is taken in time linear in
the features by 1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2). It is fitted on a bounded sample of
labelled rows on the driver and applied to every row where it lies, without a shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import bounded_batches


@dataclass(frozen=True)
class MachineConfig:
    """`sample_rows` bounds the labelled rows that are fitted, whatever the size of the corpus."""

    buckets: int = 1 << 15
    factors: int = 8
    sample_rows: int = 8_000
    steps: int = 400
    batch: int = 256
    rate: float = 0.02
    decay: float = 1e-5
    seed: int = 7


#: Structure statistics, in order; each falls into one of `len(EDGES) + 1` bins, a feature each.
STATISTICS = (
    "symbols", "upper", "digits", "exclaims", "pipes", "short_words", "word_length",
    "repeated_words", "distinct_words", "repeated_lines", "line_words", "commas", "log_words",
    "log_chars",
)
EDGES = np.array([0.005, 0.02, 0.05, 0.1, 0.15, 0.2, 0.3, 0.4, 0.5, 0.65, 0.8, 0.95])
N_STATISTIC_FEATURES = len(STATISTICS) * (len(EDGES) + 1)

_SYMBOLS, _PIPES, _DIGITS = b"#*$%&<>@~^{}", b"|", b"0123456789"
_UPPER = re.compile(r"[^\W\d_a-z]")


def statistics(text: str, raw: bytes, words: list[bytes], n_chars: int) -> list[float]:
    """Shares and scaled counts of one whole text, each about 0 to 1, in the order of `STATISTICS`."""
    n, size = max(len(words), 1), max(len(raw), 1)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    triples = list(zip(words, words[1:], words[2:], strict=False))
    count = lambda of: size - len(raw.translate(None, of)) if raw else 0
    upper = sum(1 for c in _UPPER.findall(text) if c.isupper())
    return [
        count(_SYMBOLS) / size,
        upper / size,
        count(_DIGITS) / size,
        raw.count(b"!") / n,
        count(_PIPES) / n,
        sum(len(w) <= 3 for w in words) / n,
        min(sum(map(len, words)) / n / 20, 1.0),
        1 - len(set(triples)) / len(triples) if triples else 0.0,
        len(set(words)) / n,
        1 - len(set(lines)) / len(lines) if lines else 0.0,
        min(n / max(len(lines), 1) / 100, 1.0),
        raw.count(b",") / n,
        min(np.log1p(len(words)) / 12, 1.0),
        min(np.log1p(n_chars) / 16, 1.0),
    ]


def features(text: str | None, n_chars: int | None, config: MachineConfig) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers (ascending) and values of one text; null is the empty text, a null length its length."""
    text = text or ""
    raw = text.encode()
    words = raw.split()
    ids, counts = np.unique(np.fromiter(map(crc32, raw.lower().split()), np.int64) % config.buckets, return_counts=True)
    values = np.log1p(counts)
    if len(values):
        values /= np.sqrt((values**2).sum())
    measured = statistics(text, raw, words, len(text) if n_chars is None else max(n_chars, 0))
    bins = np.searchsorted(EDGES, measured, "right")
    own = config.buckets + np.arange(len(STATISTICS)) * (len(EDGES) + 1) + bins
    return (
        np.concatenate((ids, own)).astype(np.int32),
        np.concatenate((values, np.full(len(STATISTICS), 0.5))).astype(np.float32),
    )


@dataclass
class Machine:
    bias: float
    weights: np.ndarray
    vectors: np.ndarray  # features x factors
    config: MachineConfig

    def scores(self, ids: np.ndarray, values: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Scores of texts whose features are concatenated; every text has some."""
        linear = np.add.reduceat(self.weights[ids] * values, starts)
        weighted = self.vectors[ids] * values[:, None]
        sums, squares = np.add.reduceat(weighted, starts), np.add.reduceat(weighted**2, starts)
        odds = self.bias + linear + 0.5 * (sums**2 - squares).sum(1)
        return 1 / (1 + np.exp(-np.clip(odds.astype(np.float64), -30, 30)))


def fit(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, config: MachineConfig) -> Machine:
    """Logistic loss by Adam over shuffled batches. Without rows of both labels the score is their share (0.5 without any)."""
    size = config.buckets + N_STATISTIC_FEATURES
    drawn = np.random.Generator(np.random.PCG64(config.seed))
    share = float(labels.mean()) if len(labels) else 0.5
    share = min(max(share, 0.01), 0.99) if len(labels) else 0.5
    machine = Machine(float(np.log(share / (1 - share))), np.zeros(size, np.float32), np.zeros((size, config.factors), np.float32), config)
    if len(labels) == 0 or labels.min() == labels.max():
        return machine
    machine.vectors = drawn.normal(0, 0.05, (size, config.factors)).astype(np.float32)
    table = np.concatenate((machine.weights[:, None], machine.vectors), 1)
    first, second, step = np.zeros_like(table), np.zeros_like(table), 0
    while step < config.steps:
        order = drawn.permutation(len(rows))
        for at in range(0, len(order), config.batch):
            chosen = order[at : at + config.batch]
            ids = np.concatenate([rows[i][0] for i in chosen])
            values = np.concatenate([rows[i][1] for i in chosen])
            lengths = np.array([len(rows[i][0]) for i in chosen])
            starts = np.cumsum(lengths) - lengths
            part, place = np.unique(ids, return_inverse=True)
            weighted = table[ids, 1:] * values[:, None]
            sums = np.add.reduceat(weighted, starts)
            odds = machine.bias + np.add.reduceat(table[ids, 0] * values, starts)
            odds = odds + 0.5 * (sums**2 - np.add.reduceat(weighted**2, starts)).sum(1)
            error = np.repeat(1 / (1 + np.exp(-np.clip(odds, -30, 30))) - labels[chosen], lengths) * values / len(chosen)
            each = np.empty((len(ids), 1 + config.factors), np.float32)
            each[:, 0] = error
            each[:, 1:] = error[:, None] * (np.repeat(sums, lengths, 0) - weighted)
            grad = np.stack([np.bincount(place, each[:, k], len(part)) for k in range(each.shape[1])], 1)
            grad += config.decay * table[part]
            step += 1
            first[part] = 0.9 * first[part] + 0.1 * grad
            second[part] = 0.99 * second[part] + 0.01 * grad**2
            table[part] -= config.rate * (first[part] / (1 - 0.9**step)) / (np.sqrt(second[part] / (1 - 0.99**step)) + 1e-7)
            machine.bias -= config.rate * float((error / np.maximum(values, 1e-6))[starts].sum())
    machine.weights, machine.vectors = table[:, 0].copy(), table[:, 1:].copy()
    return machine


def held_out(key: str = "doc_id") -> Column:
    """Whether a row is kept from learning: crc32 of the id as text, mod 5, is 0 (a null id: not held out)."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, config: MachineConfig = MachineConfig()) -> Machine:
    """Fit on labelled rows that are not held out: of more than `sample_rows`, those with the smallest id hashes.

    `docs`: doc_id, text, n_chars; `labels`: doc_id, quality. A row labelled twice takes the lower label;
    labels that are null or neither 0 nor 1, and labels of no document, are passed over. Of rows that repeat an id,
    the one with the least hash of text and length is fitted. Without any label the machine is the untrained one.
    """
    chosen = (
        labels.select("doc_id", F.col("quality").cast("int").alias("quality"))
        .filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(config.sample_rows)
    )

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [features(t.as_py(), n.as_py(), config) for t, n in zip(batch.column("text"), batch.column("n_chars"), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("quality"), pa.array([i.tobytes() for i, _ in found], pa.binary()), pa.array([v.tobytes() for _, v in found], pa.binary())],
                ["doc_id", "quality", "ids", "values"],
            )

    # the sample has at most sample_rows rows of two numbers, so it is sent to the documents
    sample = docs.select("doc_id", "text", F.col("n_chars").cast("bigint")).join(F.broadcast(chosen), "doc_id")
    # an id may repeat; the row with the least hash is fitted whatever the order of rows, and the bound holds
    by_hash = F.struct(F.xxhash64("text", "n_chars").alias("h"), "text", "n_chars")
    single = sample.groupBy("doc_id", "quality").agg(F.min(by_hash).alias("row"))
    rows = single.select("doc_id", "quality", "row.text", "row.n_chars").mapInArrow(made, "doc_id bigint, quality int, ids binary, values binary")
    got = sorted(rows.toLocalIterator(), key=lambda r: r["doc_id"])
    return fit(
        [(np.frombuffer(r["ids"], np.int32), np.frombuffer(r["values"], np.float32)) for r in got],
        np.array([r["quality"] for r in got], np.float32),
        config,
    )


def scored(docs: DataFrame, machine: Machine, text: str = "text", n_chars: str = "n_chars", score: str = "score") -> DataFrame:
    """`docs` with a column `score` from 0 to 1 made of each whole text and its length; a column of that name is replaced.

    Rows and all other columns stay as they are. Null and empty texts get the score of the empty text; an empty table
    stays empty.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    shared = spark.sparkContext.broadcast(machine)  # a few MB, fixed by the config

    @F.pandas_udf("double")
    def score_of(texts: pd.Series, lengths: pd.Series) -> pd.Series:
        m = shared.value
        out = []
        for at in range(0, len(texts), 256):
            part = zip(texts.iloc[at : at + 256], lengths.iloc[at : at + 256], strict=True)
            found = [features(t, None if n is None or n != n else int(n), m.config) for t, n in part]
            starts = np.cumsum([0, *[len(i) for i, _ in found[:-1]]])
            out.append(m.scores(np.concatenate([i for i, _ in found]), np.concatenate([v for _, v in found]), starts))
        return pd.Series(np.concatenate(out) if out else np.zeros(0))

    return docs.withColumn(score, score_of(F.col(text), F.col(n_chars).cast("bigint")))
