"""Product codes for vectors, with codebooks fitted by exact rounds of nearest entries that bounds make cheap.

Each component becomes a whole number, each vector is cut into consecutive parts, and each part position has a
codebook. A part keeps the distance to its entry (an upper bound) and, for each group of entries, the least distance to
one that is not its own (lower bounds), each with the round it was taken in. The codebooks of all rounds are
retained, so a bound of round s is moved to round r by the true net displacement ||entry(r) - entry(s)||, the
norm of the sum of the steps between, which is never more than the sum of their norms. Only parts whose bounds cross
are compared with all entries again, exactly. Distances are of whole numbers below 2**53 and so exact in
doubles, bounds are rounded outwards, and an entry keeps its part only if it is nearer for certain: the
codes are those of comparing everything.

The vectors and their bounds stay in their rows. Of a round only the sums per (part, entry) are shuffled and reach
the driver, a number of rows that does not depend on the data.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.names import private
from tidemark.session import materialize, release

#: Whole components are held within this, so that sums of squares of up to 4,096 of them are exact in doubles.
LARGEST = 1 << 20
#: Vectors worked on at once in a task.
SLICE = 2048


@dataclass(frozen=True)
class CodeConfig:
    parts: int = 16
    entries: int = 64
    rounds: int = 2
    scale: int = 256
    #: Entries that share one lower bound.
    group: int = 16

    def __post_init__(self) -> None:
        if not (1 <= self.entries <= 256 and 0 <= self.rounds < 1 << 16 and self.parts > 0 and self.group > 0):
            raise ValueError("at most 256 entries, fewer than 65536 rounds, at least one part")


def _down(x: np.ndarray) -> np.ndarray:
    """Single precision, not above."""
    return np.nextafter(x.astype(np.float32), np.float32(-np.inf))


def _up(x: np.ndarray) -> np.ndarray:
    return np.nextafter(x.astype(np.float32), np.float32(np.inf))


@dataclass
class Bounds:
    """Of a number of vectors: entry, upper bound and its round by part; lower bounds and their rounds by part and group."""

    code: np.ndarray
    own: np.ndarray
    own_at: np.ndarray
    low: np.ndarray
    low_at: np.ndarray

    FIELDS = (("code", np.uint8), ("own", np.float32), ("own_at", np.uint16), ("low", np.float32), ("low_at", np.uint16))

    @staticmethod
    def none(n: int, parts: int, groups: int) -> Bounds:
        """Bounds that say nothing."""
        shapes = ((n, parts),) * 3 + ((n, parts, groups),) * 2
        made = [np.zeros(s, kind) for s, (_, kind) in zip(shapes, Bounds.FIELDS, strict=True)]
        made[1][:] = np.inf
        made[3][:] = -np.inf
        return Bounds(*made)

    @staticmethod
    def unpack(columns: list[pa.Array], parts: int, groups: int) -> Bounds:
        n = len(columns[0])
        shapes = ((n, parts),) * 3 + ((n, parts, groups),) * 2
        raw = (b"".join(c.to_pylist()) for c in columns)
        return Bounds(*[np.frombuffer(x, k).reshape(s).copy() for x, s, (_, k) in zip(raw, shapes, Bounds.FIELDS, strict=True)])

    def pack(self) -> list[pa.Array]:
        return [packed(getattr(self, name)) for name, _ in Bounds.FIELDS]


def packed(values: np.ndarray) -> pa.Array:
    """A row of bytes for each first index."""
    flat = np.ascontiguousarray(values).reshape(len(values), -1).view(np.uint8)
    offsets = np.arange(len(values) + 1, dtype=np.int32) * flat.shape[1]
    return pa.Array.from_buffers(pa.binary(), len(values), [None, pa.py_buffer(offsets), pa.py_buffer(flat.tobytes())])


class Assigner:
    """Nearest entries under the last of a history of codebooks, each an array (part, entry, component)."""

    def __init__(self, history: list[np.ndarray], group: int) -> None:
        self.now = history[-1].astype(np.float64)
        self.round = len(history) - 1
        parts, entries, _ = self.now.shape
        self.group, self.groups = group, -(-entries // group)
        #: Net displacement since each round, by part and entry.
        self.moved = np.stack([np.sqrt(((self.now - was) ** 2).sum(-1)) for was in history])
        # the two largest displacements of each group, for the largest among the entries that are not a part's own
        padded = np.full((*self.moved.shape[:2], self.groups * group), -1.0)
        padded[..., :entries] = self.moved
        self.by_group = padded.reshape(*self.moved.shape[:2], self.groups, group)
        self.norms = (self.now**2).sum(-1)
        self.entries = entries

    def _doubtful(self, b: Bounds, own: np.ndarray) -> np.ndarray:
        """Whether another entry may be as near as a part's own, by the bounds moved to this round."""
        at = np.arange(b.code.shape[1])
        rise = self.by_group.max(-1)[b.low_at, at[:, None], np.arange(self.groups)]
        # a part's own entry does not count in its own group
        rows, cols = np.indices(b.code.shape)
        mine = b.code // self.group
        stamp = b.low_at[rows, cols, mine]
        others = self.by_group[stamp, cols, mine].copy()
        np.put_along_axis(others, (b.code % self.group).astype(np.int64)[..., None], -1.0, -1)
        rise[rows, cols, mine] = np.maximum(others.max(-1), 0.0)
        lower = (b.low.astype(np.float64) - rise) * (1 - 1e-12) - 1e-9
        return (own[..., None] >= lower).any(-1)

    def distances(self, x: np.ndarray, code: np.ndarray) -> np.ndarray:
        """Squared distances of parts to their entries, exactly."""
        return ((x - self.now[np.arange(x.shape[1]), code]) ** 2).sum(-1)

    def assign(self, x: np.ndarray, b: Bounds) -> np.ndarray:
        """Bring `b` to this round for the vectors `x` (vector, part, component); gives which parts were compared with all entries."""
        cols = np.arange(x.shape[1])
        upper = b.own + self.moved[b.own_at, cols, b.code] * (1 + 1e-12) + 1e-9
        crossed = self._doubtful(b, upper)
        # first the distance to the own entry anew, then all of them where the bounds still cross
        rows, parts = np.nonzero(crossed)
        fresh = ((x[rows, parts] - self.now[parts, b.code[rows, parts]]) ** 2).sum(-1)
        b.own[rows, parts], b.own_at[rows, parts] = _up(np.sqrt(fresh)), self.round
        upper = b.own + self.moved[b.own_at, cols, b.code] * (1 + 1e-12) + 1e-9
        scan = crossed & self._doubtful(b, upper)
        for p in cols:
            found = np.flatnonzero(scan[:, p])
            if len(found):
                self._compare(x[found, p], b, found, p)
        return scan

    def _compare(self, x: np.ndarray, b: Bounds, rows: np.ndarray, p: int) -> None:
        """Exact distances of one part of some vectors to all entries, and fresh bounds from them."""
        square = (x**2).sum(-1)[:, None] - 2 * (x @ self.now[p].T) + self.norms[p]
        code = square.argmin(-1)  # the first of equal ones
        each = np.arange(len(rows))
        own = square[each, code]
        square[each, code] = np.inf
        padded = np.full((len(rows), self.groups * self.group), np.inf)
        padded[:, : self.entries] = square
        low = np.sqrt(padded.reshape(len(rows), self.groups, self.group).min(-1))
        b.code[rows, p], b.own[rows, p], b.own_at[rows, p] = code, _up(np.sqrt(own)), self.round
        b.low[rows, p], b.low_at[rows, p] = np.where(np.isinf(low), np.float32(np.inf), _down(low)), self.round


def _whole(column: pa.Array, parts: int) -> np.ndarray:
    """(vector, part, component) in doubles from rows of 32-bit numbers."""
    flat = np.frombuffer(b"".join(column.to_pylist()), np.int32)
    return flat.reshape(len(column), parts, -1).astype(np.float64)


def usable(df: DataFrame, vector: str = "embedding") -> DataFrame:
    """Rows whose vector is there and holds finite numbers alone."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) != float("inf"))
    return df.filter(F.col(vector).isNotNull() & F.forall(vector, finite))


def whole_vectors(df: DataFrame, config: CodeConfig = CodeConfig(), key: str = "vec_id", vector: str = "embedding", carry: tuple[str, ...] = ()) -> DataFrame:
    """(key, *carry, whole): each usable vector's components times `scale`, floored, as 32-bit numbers in a row of bytes.

    They are held within 2**20. The most frequent length that the parts divide (the longer of equally
    frequent ones) is the width; vectors of another length have no code and go, as empty ones do.
    """
    given = usable(df, vector)
    size = F.size(vector)
    widths = given.filter((size > 0) & (size % config.parts == 0)).groupBy(size.alias("n")).count()
    most = widths.orderBy(F.desc("count"), F.desc("n")).first()
    width = most["n"] if most else 0
    named = given.filter(size == width).select(key, *carry, F.col(vector).cast("array<double>"))
    fields = [named.schema[c] for c in (key, *carry)]
    (own,) = private(named.drop(vector), "whole")

    def floor(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(batch.num_columns - 1).flatten().to_numpy(zero_copy_only=False).reshape(-1, max(width, 1))
            whole = np.clip(np.floor(values * config.scale), -LARGEST, LARGEST).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], packed(whole)], [*[f.name for f in fields], own])

    return named.mapInArrow(floor, T.StructType([*fields, T.StructField(own, T.BinaryType())]))


def first_codebook(vectors: DataFrame, config: CodeConfig, key: str, whole: str) -> np.ndarray:
    """The parts of the vectors with the smallest keys (null last; equal keys by their bytes), at most `entries` of them."""
    rows = vectors.orderBy(F.asc_nulls_last(key), whole).limit(config.entries).select(whole).collect()
    parts = [np.frombuffer(r[0], np.int32).reshape(config.parts, -1).astype(np.int64) for r in rows]
    return np.stack(parts, 1) if parts else np.zeros((config.parts, 0, 0), np.int64)


def next_codebook(assigned: DataFrame, last: np.ndarray, whole: str, code: str) -> np.ndarray:
    """Each entry replaced by the floored mean of its parts; unused ones stay.

    Tasks add up what they hold, so a hot entry costs a row a task; `parts * entries` rows reach the driver.
    """
    parts, entries, width = last.shape
    names = [f"s{i}" for i in range(width)]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((parts * entries, width), np.int64), np.zeros(parts * entries, np.int64)
        base = np.arange(parts) * entries
        for batch in batches:
            x = _whole(batch.column(0), parts).astype(np.int64)
            at = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint8).reshape(-1, parts) + base
            np.add.at(sums, at, x)
            counts += np.bincount(at.ravel(), minlength=parts * entries)
        used = np.flatnonzero(counts)
        columns = [used.astype(np.int32), counts[used], *sums[used].T]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["at", "n", *names])

    schema = ", ".join(["at int", "n bigint", *[f"{s} bigint" for s in names]])
    local = assigned.select(whole, code).mapInArrow(add, schema)
    rows = local.groupBy("at").agg(F.sum("n").alias("n"), *[F.sum(s).alias(s) for s in names]).collect()
    made = last.copy()
    for r in rows:
        made[divmod(r["at"], entries)] = [r[s] // r["n"] for s in names]
    return made


@dataclass(frozen=True)
class Compressed:
    """`codes` (key, *carry, code, error, compared) and the codebooks of all rounds, the last of which the codes are of."""

    codes: DataFrame
    history: list[np.ndarray]

    def digest(self) -> str:
        """SHA-256 of the final codebooks' components in decimal by part, entry and position, with commas between."""
        return hashlib.sha256(",".join(map(str, self.history[-1].ravel().tolist())).encode()).hexdigest()


def compress(df: DataFrame, config: CodeConfig = CodeConfig(), key: str = "vec_id", vector: str = "embedding", carry: tuple[str, ...] = ()) -> Compressed:
    """Fit the codebooks on all usable vectors and encode them.

    `code` has two hex digits for each part, `error` is the squared distance of the whole vector to what the code
    says, `compared` counts the parts whose bounds made the last assignment compare all entries. Vectors that are null,
    hold a null or a number that is not finite, are empty or of another length than the most frequent one are left
    out. Rows that repeat a key are rows like any other. Fewer vectors than entries make smaller codebooks; of an
    empty table they are empty, and so are the codes. `carry` names columns that stay as they are; it must not
    name `code`, `error` or `compared`.
    """
    wholes = whole_vectors(df, config, key, vector, carry)
    whole = wholes.columns[-1]
    table = materialize(wholes)
    history = [first_codebook(table, config, key, whole)]
    kept = [table.schema[c] for c in (key, *carry)]
    names = private(table, *[name for name, _ in Bounds.FIELDS])
    binary = [T.StructField(n, T.BinaryType()) for n in (whole, *names)]

    def assigned(known: DataFrame, books: list[np.ndarray]) -> DataFrame:
        fresh = len(books) == 1

        def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            near = Assigner(books, config.group)
            for large in batches:
                for at in range(0, large.num_rows, SLICE):
                    batch = large.slice(at, SLICE)
                    x = _whole(batch.column(len(kept)), config.parts)
                    b = Bounds.none(len(x), config.parts, near.groups) if fresh else Bounds.unpack(batch.columns[len(kept) + 1 :], config.parts, near.groups)
                    near.assign(x, b)
                    yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept) + 1], *b.pack()], [*[f.name for f in kept], whole, *names])

        return known.mapInArrow(assign, T.StructType([*kept, *binary]))

    if history[0].size:
        for _ in range(config.rounds):
            done = materialize(assigned(table, list(history)))
            release(table)
            table = done
            history.append(next_codebook(table, history[-1], whole, names[0]))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        near = Assigner(history, config.group)
        for large in batches:
            for at in range(0, large.num_rows, SLICE):
                batch = large.slice(at, SLICE)
                x = _whole(batch.column(len(kept)), config.parts)
                b = Bounds.none(len(x), config.parts, near.groups) if len(history) == 1 else Bounds.unpack(batch.columns[len(kept) + 1 :], config.parts, near.groups)
                compared = near.assign(x, b).sum(-1)
                made = [
                    pa.array([row.tobytes().hex() for row in b.code], pa.string()),
                    pa.array(near.distances(x, b.code).sum(-1).astype(np.int64), pa.int64()),
                    pa.array(compared, pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], *made], [*[f.name for f in kept], "code", "error", "compared"])

    added = T.StructType.fromDDL("code string, error bigint, compared bigint")
    return Compressed(table.mapInArrow(encode, T.StructType([*kept, *added])), history)


def decoded(codes: DataFrame, codebook: np.ndarray, scale: int = 256, code: str = "code", vector: str = "decoded") -> DataFrame:
    """`codes` with the vector that each code stands for; a column of that name is replaced, a null code gives null."""
    parts, _, _ = codebook.shape
    values = codebook / scale

    @F.pandas_udf("array<double>")
    def look_up(given):
        at = np.arange(parts)
        return given.map(lambda c: None if c is None else values[at, np.frombuffer(bytes.fromhex(c), np.uint8)].ravel())

    return codes.withColumn(vector, look_up(F.col(code)))
