"""MinHash near-duplicates with sequential Bayesian verification.

Texts with equal shingle sets are one node. Nodes that share a band of their signature are candidates:
first each with a head of its bucket, the node with the smallest set, then with another, the one with the
most links so far. Candidates are compared a batch of signature places at a time and dropped as soon as the posterior
probability of reaching the threshold is below `miss`; survivors are checked on their full shingle sets.
What those rounds leave are nodes that are apart from their bucket's head while the bucket has several components. The members of
such a head come together as rows, in blocks of bounded size; there each node apart is held, on full sets, against members
whose component is still another, and only links that unite two components leave the block, never pairs.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import bounded_batches, materialize


@dataclass(frozen=True)
class NearConfig:
    """A pair is linked if 100 * intersection >= `percent` * union of its sets of `words`-word shingles.

    With `bands` bands of `rows` places, a pair at 0.8 shares none with probability (1 - 0.8 ** rows) ** bands,
    5e-8 by default; `miss` bounds the posterior at which a candidate is dropped after each `batch` places.
    A block of a bucket's members has about `block` shingles.
    """

    words: int = 5
    percent: int = 80
    bands: int = 32
    rows: int = 4
    batch: int = 16
    miss: float = 1e-7
    block: int = 1 << 20

    @property
    def places(self) -> int:
        return self.bands * self.rows


_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def _mix(x: np.ndarray) -> np.ndarray:
    """A published 64-bit finalizer."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class _Powers:
    """Powers of an odd base and of its inverse modulo 2 ** 64, grown as needed."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, _U)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            n = max(n, 1 << 20)
            inverse = _U(pow(int(_BASE), -1, 1 << 64))
            made = []
            for base in (_BASE, inverse):
                steps = np.full(n, base, _U)
                steps[0] = 1
                made.append(np.multiply.accumulate(steps))
            self.up, self.down = made
        return self.up[:n], self.down[:n]


_powers = _Powers()


def word_hashes(raw: bytes) -> np.ndarray:
    """64-bit hashes of the words of lower-cased UTF-8 text, in order."""
    if not raw:
        return np.zeros(0, _U)
    c = np.frombuffer(raw, np.uint8)
    inside = np.concatenate(([False], ~_SPACE[c], [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    up, down = _powers.upto(len(c) + 1)
    sums = np.concatenate((np.zeros(1, _U), np.cumsum((c.astype(_U) + _U(1)) * up[: len(c)])))
    return _mix((sums[ends] - sums[starts]) * down[starts] ^ (ends - starts).astype(_U))


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """The sorted distinct 64-bit hashes of a text's shingles; with fewer words the whole sequence is one."""
    h = word_hashes((text or "").encode().lower())
    if not len(h):
        return h
    n = min(words, len(h))
    out = np.full(len(h) - n + 1, _U(n))
    for i in range(n):
        out = _mix(out * _BASE + h[i : len(h) - n + 1 + i])
    return np.unique(out)


def _factors(places: int) -> tuple[np.ndarray, np.ndarray]:
    drawn = np.random.Generator(np.random.PCG64(20240229))
    return drawn.integers(0, 1 << 63, places, _U) * _U(2) + _U(1), drawn.integers(0, 1 << 63, places, _U)


def signatures(sets: list[np.ndarray], places: int) -> np.ndarray:
    """MinHash values of non-empty sets, one row a set."""
    out = np.empty((len(sets), places), np.uint32)
    a, b = _factors(places)
    first = 0
    while first < len(sets):
        # blocks that stay in the processor's cache
        last, held = first, 0
        while last < len(sets) and (last == first or held + len(sets[last]) <= 32_768):
            held += len(sets[last])
            last += 1
        joined = np.concatenate(sets[first:last])
        offsets = np.cumsum([0, *[len(s) for s in sets[first : last - 1]]])
        for k in range(places):
            out[first:last, k] = np.minimum.reduceat(joined * a[k] + b[k], offsets) >> _U(32)
        first = last
    return out


def _slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def sketched(docs: DataFrame, config: NearConfig, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, set_key, bands, sketch) of every row; the last three are null without shingles."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            sets = [shingle_set(t.as_py(), config.words) for t in batch.column(1)]
            full = [i for i, s in enumerate(sets) if len(s)]
            keys, bands, marks = ([None] * len(sets) for _ in range(3))
            if full:
                made = signatures([sets[i] for i in full], config.places)
                folded = made.reshape(len(full), config.bands, config.rows).astype(_U)
                band = np.zeros((len(full), config.bands), _U)
                for r in range(config.rows):
                    band = _mix(band * _BASE + folded[:, :, r] + _U(1))
                low = (made & 0xFF).astype(np.uint8)
                for row, i in enumerate(full):
                    keys[i] = hashlib.blake2b(sets[i].tobytes(), digest_size=16).digest()
                    bands[i], marks[i] = band[row].tobytes(), low[row].tobytes()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(s) for s in sets], pa.int64()), *[pa.array(x, pa.binary()) for x in (keys, bands, marks)]],
                ["doc_id", "n_shingles", "set_key", "bands", "sketch"],
            )

    schema = "doc_id bigint, n_shingles bigint, set_key binary, bands binary, sketch binary"
    return docs.select(F.col(key).cast("bigint"), text).mapInArrow(sketch, schema)


def least_matches(config: NearConfig) -> list[tuple[int, int]]:
    """(places compared, matches needed to go on) for each batch.

    Under a uniform prior, P(match rate >= t | m of n) is P(Binomial(n + 1, t) <= m). Places are kept as a
    byte, so unlike values agree once in 256.
    """
    t = config.percent / 100
    t += (1 - t) / 256
    found = []
    for n in range(config.batch, config.places + 1, config.batch):
        total, m = 0.0, 0
        while m <= n:
            total += math.comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
            if total >= config.miss:
                break
            m += 1
        found.append((n, m))
    return found


def _bayes(pairs: DataFrame, config: NearConfig) -> DataFrame:
    """The candidates (a, b, sketch_a, sketch_b) that no batch rules out."""
    steps = least_matches(config)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (
                np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, config.places)
                for c in ("sketch_a", "sketch_b")
            )
            live, matches, done = np.arange(batch.num_rows), np.zeros(batch.num_rows, np.int64), 0
            for n, least in steps:
                matches[live] += (x[live, done:n] == y[live, done:n]).sum(1)
                live, done = live[matches[live] >= least], n
            yield batch.select(["a", "b"]).take(pa.array(live))

    return pairs.mapInArrow(compare, "a bigint, b bigint")


def _sets(wanted: DataFrame, docs: DataFrame, config: NearConfig) -> DataFrame:
    """(id, shingles): the full sets of the documents whose ids are wanted, as sorted 64-bit hashes."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            made = [shingle_set(t.as_py(), config.words).tobytes() for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.binary())], ["id", "shingles"])

    # the same plan at every size: both sides by id
    found = docs.join(wanted.hint("merge"), "doc_id", "left_semi").select("doc_id", "text").distinct()
    return materialize(found.mapInArrow(sets, "id bigint, shingles binary"))


def _beside(pairs: DataFrame, full: DataFrame) -> DataFrame:
    """Pairs (a, b, ...) with the sets x of a and y of b."""
    first = full.select(F.col("id").alias("a"), F.col("shingles").alias("x"))
    second = full.select(F.col("id").alias("b"), F.col("shingles").alias("y"))
    return pairs.join(second.hint("merge"), "b").join(first.hint("merge"), "a")


def _common(x: np.ndarray, y: np.ndarray) -> int:
    both = np.sort(np.concatenate((x, y)), kind="stable")
    return int((both[1:] == both[:-1]).sum())


def _confirmed(pairs: DataFrame, full: DataFrame, config: NearConfig) -> DataFrame:
    """The pairs whose full shingle sets meet the threshold."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            kept = []
            for i, (x, y) in enumerate(zip(batch.column("x"), batch.column("y"), strict=True)):
                x, y = (np.frombuffer(s.as_buffer(), _U) for s in (x, y))
                common = _common(x, y)
                if common and 100 * common >= config.percent * (len(x) + len(y) - common):
                    kept.append(i)
            yield batch.select(["a", "b"]).take(pa.array(kept, pa.int64()))

    joined = _beside(pairs, full).select("a", "b", "x", "y")
    return joined.mapInArrow(check, "a bigint, b bigint")


class _Overlaps:
    """How many shingles each set of a block has in common with the others.

    Shingles of one set alone are left out. One that more than a 64th of the sets have is a bit of every
    set's row, so the rows take no more room than the sets; any other has a short list of the sets that have it.
    """

    def __init__(self, sets: list[np.ndarray]) -> None:
        self.members = len(sets)
        owner = np.repeat(np.arange(self.members), [len(s) for s in sets])
        _, code, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        often = 64 * counts > self.members
        heavy, light = (counts > 1) & often, (counts > 1) & ~often
        self.words = -(-int(heavy.sum()) // 64)
        self.rows = np.zeros((self.members, self.words), _U)
        place = np.cumsum(heavy) - 1
        at = heavy[code]
        bit = place[code[at]]
        np.bitwise_or.at(self.rows, (owner[at], bit >> 6), _U(1) << (bit & 63).astype(_U))
        at = light[code]
        place = np.cumsum(light) - 1
        self.owner, self.code = owner[at], place[code[at]]
        # the members that have each light code, and the light codes of each member
        by_code = np.argsort(self.code, kind="stable")
        self.having = self.owner[by_code]
        self.ends = np.cumsum(counts[light])
        self.starts = self.ends - counts[light]
        self.own = np.searchsorted(self.owner, np.arange(self.members + 1))

    def of(self, i: int, low: int, high: int) -> np.ndarray:
        """What set i has in common with each of the sets from `low` to before `high`."""
        found = np.bitwise_count(self.rows[low:high] & self.rows[i]).sum(1, dtype=np.int64)
        codes = self.code[self.own[i] : self.own[i + 1]]
        if len(codes):
            lists = [self.having[self.starts[c] : self.ends[c]] for c in codes]
            found += np.bincount(np.concatenate(lists), minlength=self.members)[low:high]
        return found


def spanning_links(sets: list[np.ndarray], component: np.ndarray, apart: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Links between members of a block that unite all components which links of its nodes apart connect.

    Each node apart is held against the members of like size whose component is still another than its own;
    a component that it has a link with is united with its own at once. So there are fewer links than members.
    """
    order = np.argsort([len(s) for s in sets], kind="stable")
    sizes = np.array([len(sets[i]) for i in order], np.int64)
    label = np.unique(component[order], return_inverse=True)[1]
    overlaps = _Overlaps([sets[i] for i in order])
    links = []
    for i in np.flatnonzero(apart[order]):
        low = np.searchsorted(100 * sizes, percent * sizes[i])
        high = np.searchsorted(percent * sizes, 100 * sizes[i], side="right")
        if (label[low:high] == label[i]).all():
            continue
        common = overlaps.of(i, low, high)
        linked = 100 * common >= percent * (sizes[low:high] + sizes[i] - common)
        linked &= label[low:high] != label[i]
        for j in low + np.flatnonzero(linked):
            if label[j] != label[i]:
                links.append((int(order[i]), int(order[j])))
                label[label == label[j]] = label[i]
    return links


def _spanning(active: DataFrame, full: DataFrame, config: NearConfig) -> DataFrame:
    """Links (a, b) between members of one head, `active` (head, b, apart, component, all_parts, apart_parts).

    The members of a head are dealt over `all_parts` parts, its nodes apart over `apart_parts` as well; each part of
    nodes apart meets each part of all members in a cell of its own. Rows are as many as members where both
    are one, and no pair of members is ever a row.
    """

    def cells(table: pa.Table) -> pa.Table:
        rows = table.select(["b", "component", "probe", "apart"]).to_pydict()
        sets = [np.frombuffer(x.as_buffer(), _U) for x in table.column("shingles").combine_chunks()]
        found = spanning_links(sets, np.array(rows["component"], np.int64), np.array(rows["probe"], bool), config.percent)
        pairs = [(rows["b"][i], rows["b"][j]) for i, j in found]
        return pa.table({"a": pa.array([x for x, _ in pairs], pa.int64()), "b": pa.array([y for _, y in pairs], pa.int64())})

    own_all = F.pmod(F.xxhash64("b"), F.col("all_parts"))
    own_apart = F.pmod(F.xxhash64("b", F.lit(1)), F.col("apart_parts"))
    dealt = active.withColumn("own_all", own_all).withColumn("own_apart", F.when(F.col("apart"), own_apart))
    members = dealt.select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("apart_parts") - 1)).alias("of_apart"))
    # a node apart is a probe in its own part's cells, and one of all members in the cells of the other parts
    here = members.select("head", F.col("own_all").alias("of_all"), "of_apart", "b", "component", "apart", F.expr("apart and of_apart = own_apart").alias("probe"))
    away = dealt.filter("apart and all_parts > 1").select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("all_parts") - 1)).alias("of_all"))
    away = away.filter("of_all <> own_all").select("head", "of_all", F.col("own_apart").alias("of_apart"), "b", "component", "apart", F.lit(True).alias("probe"))
    placed = here.unionByName(away).join(full.withColumnRenamed("id", "b").hint("merge"), "b")
    return placed.groupBy("head", "of_all", "of_apart").applyInArrow(cells, "a bigint, b bigint")


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable over edges (a, b), for the nodes that have edges.

    Each round hooks every component to its smallest neighbour and follows the hooks to their ends, so
    the number of components with edges at least halves. Minima are combined map-side; nothing is
    collected but whether a round had edges.
    """
    nodes = edges.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    labels = materialize(nodes.withColumn("component", F.col("node")))
    left = materialize(edges.select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi")).filter("lo < hi").distinct())
    while not left.isEmpty():
        hooks = materialize(left.groupBy(F.col("hi").alias("node")).agg(F.min("lo").alias("to")))
        while True:
            ends = hooks.select(F.col("node").alias("to"), F.col("to").alias("further"))
            moved = materialize(hooks.join(ends, "to", "left"))
            hooks = moved.select("node", F.coalesce("further", "to").alias("to"))
            if moved.filter("further is not null").isEmpty():
                break
        hooks = hooks.select(F.col("node").alias("was"), "to")

        def hooked(df: DataFrame, name: str, hooks: DataFrame = hooks) -> DataFrame:
            return df.join(hooks, df[name] == hooks["was"], "left").withColumn(name, F.coalesce("to", name)).drop("was", "to")

        labels = materialize(hooked(labels, "component"))
        left = hooked(hooked(left, "lo"), "hi")
        left = materialize(left.select(F.least("lo", "hi").alias("lo"), F.greatest("lo", "hi").alias("hi")).filter("lo < hi").distinct())
    return labels


def near_duplicates(docs: DataFrame, config: NearConfig = NearConfig(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of `docs`.

    Words are lower-cased in A-Z and parted by ASCII white space. Texts without words (null, empty) link with
    nothing. Rows that repeat an id are one node with the links of all of them; a row without an id
    links with nothing, has a null component and is kept. Other columns are not read. Equal sets are
    joined by their 128-bit digest, never as pairs.
    """
    bounded_batches(docs.sparkSession)
    docs = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    rows = materialize(sketched(docs, config))
    known = rows.filter("n_shingles > 0 and doc_id is not null")
    nodes = known.groupBy("set_key").agg(F.min("doc_id").alias("node"))
    # the sets of one node id are few (rows that repeat the id); equal rows fall together
    reps = (
        known.join(nodes, "set_key")
        .filter("doc_id = node")
        .select("node", "n_shingles", "bands", "sketch")
    )
    reps = materialize(reps)
    banded = reps.select(
        "node",
        "n_shingles",
        F.explode(
            F.array(*[F.xxhash64(F.lit(i), F.substring("bands", 8 * i + 1, 8)) for i in range(config.bands)])
        ).alias("band"),
    )
    counts = banded.groupBy("band").agg(F.count("*").alias("_n")).filter("_n > 1").select("band")
    shared = materialize(banded.select("band", "node", "n_shingles").join(counts.hint("merge"), "band", "left_semi"))
    sketches = reps.select("node", "sketch")

    def headed(rows: DataFrame, *order: Column) -> DataFrame:
        """(a, b, n): the nodes of each bucket with its head, the first in `order`."""
        first = rows.groupBy("band").agg(F.min(F.struct(*order, "n_shingles", "node")).alias("_first"))
        led = rows.join(first.select("band", F.col("_first.node").alias("a")).hint("merge"), "band").filter("node <> a")
        return materialize(led.select("a", F.col("node").alias("b"), F.col("n_shingles").alias("n")).distinct())

    def likely(pairs: DataFrame) -> DataFrame:
        first, second = sketches.toDF("a", "sketch_a").hint("merge"), sketches.toDF("b", "sketch_b").hint("merge")
        given = pairs.join(first, "a").join(second, "b")
        return materialize(_bayes(given.select("a", "b", "sketch_a", "sketch_b"), config).distinct())

    def ids(pairs: DataFrame) -> DataFrame:
        return pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()

    # an id with several texts ties their nodes together
    several = known.select("doc_id", "set_key").distinct().groupBy("doc_id").count().filter("count > 1")
    tied = known.join(several, "doc_id", "left_semi").join(nodes, "set_key").filter("doc_id <> node")
    tied = tied.select(F.col("node").alias("a"), F.col("doc_id").alias("b"))
    smallest = headed(shared)
    pairs = likely(smallest.select("a", "b"))
    full = _sets(ids(pairs), docs, config)
    links = materialize(_confirmed(pairs, full, config).unionByName(tied).distinct())
    # now the node with the most links heads a bucket, where there is any
    degree = links.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count("*").alias("_links"))
    ranked = shared.join(degree, "node", "left").withColumn("_rank", -F.coalesce("_links", F.lit(0)))
    members = headed(ranked, F.col("_rank"))
    tested = smallest.select(F.col("b").alias("a"), F.col("a").alias("b")).unionByName(smallest.select("a", "b"))
    pairs = likely(members.select("a", "b").join(tested, ["a", "b"], "left_anti"))
    links = materialize(links.unionByName(_confirmed(pairs, _sets(ids(pairs), docs, config), config)).distinct())
    # members of heads that have both a node apart and another component beside it
    found = components(links)
    either = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    placed = members.join(found.withColumnRenamed("node", "b"), "b", "left").join(
        either.withColumn("linked", F.lit(True)), ["a", "b"], "left"
    )
    placed = placed.select(
        "a", "b", "n", F.coalesce("component", "b").alias("component"), F.col("linked").isNull().alias("apart")
    )
    placed = materialize(placed)
    parts = lambda of: F.ceil(F.sum(of) / config.block).cast("bigint")
    mixed = placed.groupBy("a").agg(
        F.min("component").alias("_low"), F.max("component").alias("_high"), F.max("apart").alias("_some"),
        parts("n").alias("all_parts"), parts(F.when(F.col("apart"), F.col("n"))).alias("apart_parts"),
    ).filter("_some and _low <> _high").drop("_low", "_high", "_some")
    active = placed.join(mixed, "a").withColumnRenamed("a", "head")
    active = materialize(active.select("head", "b", "apart", "component", "all_parts", "apart_parts").distinct())
    full = _sets(active.select(F.col("b").alias("doc_id")).distinct(), docs, config)
    rest = materialize(_spanning(active, full, config).distinct())
    both = components(materialize(links.unionByName(rest)))
    place = nodes.join(both, "node", "left").select("set_key", F.coalesce("component", "node").alias("component_id"))
    return (
        rows.join(place, "set_key", "left")
        .select(
            "doc_id",
            "n_shingles",
            F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"),
        )
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )
