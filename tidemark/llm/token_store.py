"""Token ids in raw binary shards, with a minimal perfect hash index from document keys to their place.

A store is a folder on the cluster's shared file system:

* `shard-N.bin`: the ids of documents in ascending key order, unsigned little-endian, nothing else.
* `index-P.mph`: for the keys whose hash falls to P, a minimal perfect hash (levels of bits in which each
  key that stands alone at its place is found by the rank of its bit) and, at that number, the
  key's stored fingerprint, shard, offset and length. A look-up reads a bounded number of places,
  and a key that was never stored is told by its fingerprint.

Files are written under a name of the attempt and renamed, so a task that is run again, or twice at
once, leaves one whole file.
"""

from __future__ import annotations

import io
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.encoding import byte_level_units, encoder
from tidemark.llm.shared_files import opened, put
from tidemark.session import materialize

#: Documents of a shard and keys of an index file, about; bits per key of a level; ids of one read.
SHARD_ROWS, INDEX_KEYS, SPARE_BITS, READ_IDS = 20_000, 100_000, 2.0, 1 << 20
#: Rows encoded and sent on at once.
SLICE = 256
MAGIC = b"TIDEMPH1"
_WORD = np.uint64


def mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit mix of 64-bit keys (a published finalizer) under a seed."""
    with np.errstate(over="ignore"):
        x = keys.astype(_WORD) + _WORD((0x9E3779B97F4A7C15 * (seed + 1)) & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> _WORD(30))) * _WORD(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> _WORD(27))) * _WORD(0x94D049BB133111EB)
        return x ^ (x >> _WORD(31))


def key_hash(doc_ids: np.ndarray, copies: np.ndarray) -> np.ndarray:
    """The 64-bit key of a document: its id, and its number among rows that repeat the id."""
    with np.errstate(over="ignore"):
        return mixed(doc_ids.astype(np.int64).view(_WORD) ^ mixed(copies.astype(_WORD), 7), 11)


@dataclass
class PerfectHash:
    """Distinct 64-bit keys to 0 .. n - 1."""

    levels: list[np.ndarray]  # packed bits
    sizes: list[int]

    @staticmethod
    def build(keys: np.ndarray) -> PerfectHash:
        left, levels, sizes = keys, [], []
        while len(left):
            if len(levels) == 64:
                raise ValueError("keys repeat")
            size = max(64, int(len(left) * SPARE_BITS) + 63 & ~63)
            place = (mixed(left, 100 + len(levels)) % _WORD(size)).astype(np.int64)
            alone = np.bincount(place, minlength=size) == 1
            levels.append(np.packbits(alone, bitorder="little"))
            sizes.append(size)
            left = left[~alone[place]]
        return PerfectHash(levels, sizes)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key; any number, or -1, for a key that was not built in."""
        found, live, base = np.full(len(keys), -1, np.int64), np.arange(len(keys)), 0
        for i, (packed, size) in enumerate(zip(self.levels, self.sizes, strict=True)):
            place = (mixed(keys[live], 100 + i) % _WORD(size)).astype(np.int64)
            hit = (packed[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1
            counts = np.bitwise_count(packed).astype(np.int64)
            before = np.cumsum(counts) - counts
            at = place[hit]
            inside = np.bitwise_count(packed[at >> 3] & ((1 << (at & 7)) - 1).astype(np.uint8))
            found[live[hit]] = base + before[at >> 3] + inside
            base += int(counts.sum())
            live = live[~hit]
        return found


#: What the index holds for each key, in the order of the perfect hash.
ENTRY = np.dtype([("fingerprint", "<u4"), ("shard", "<u4"), ("offset", "<u8"), ("length", "<u4")])


def fingerprints(keys: np.ndarray) -> np.ndarray:
    return (mixed(keys, 3) >> _WORD(32)).astype("<u4")


def pack_index(keys: np.ndarray, shard: np.ndarray, offset: np.ndarray, length: np.ndarray) -> bytes:
    made = PerfectHash.build(keys)
    entries = np.zeros(len(keys), ENTRY)
    at = made.find(keys)
    for name, values in (("fingerprint", fingerprints(keys)), ("shard", shard), ("offset", offset), ("length", length)):
        entries[name][at] = values
    out = io.BytesIO()
    out.write(MAGIC + np.array([len(made.levels), len(keys)], "<u8").tobytes() + np.array(made.sizes, "<u8").tobytes())
    for level in made.levels:
        out.write(level.tobytes())
    out.write(entries.tobytes())
    return out.getvalue()


class Index:
    """One index file in memory."""

    def __init__(self, raw: bytes) -> None:
        if raw[:8] != MAGIC:
            raise ValueError("not an index file")
        n_levels, n = np.frombuffer(raw, "<u8", 2, 8).tolist()
        sizes, at = np.frombuffer(raw, "<u8", n_levels, 24).tolist(), 24 + 8 * n_levels
        levels = []
        for size in sizes:
            levels.append(np.frombuffer(raw, np.uint8, size // 8, at))
            at += size // 8
        self.hash, self.entries = PerfectHash(levels, sizes), np.frombuffer(raw, ENTRY, n, at)

    def look_up(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entries of keys, and whether each key is there by its fingerprint."""
        at = self.hash.find(keys)
        if not len(self.entries):
            return np.zeros(len(keys), ENTRY), np.zeros(len(keys), bool)
        entries = self.entries[np.maximum(at, 0)]
        return entries, (at >= 0) & (entries["fingerprint"] == fingerprints(keys))


def encoded(docs: DataFrame, vocabulary: str, end_id: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, ids): each whole text's ids and the end id, as 16-bit integers; null is the empty text."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units, end = encoder(vocabulary, "<u2"), np.array([end_id], "<u2").tobytes()
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE):
                batch = whole.slice(at, SLICE)
                ids = [units.encode(byte_level_units(t.as_py() or "")) + end for t in batch.column(1)]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary())], ["doc_id", "ids"])

    return docs.select(F.col(key).cast("bigint"), text).mapInArrow(encode, "doc_id bigint, ids binary")


def write_store(ids: DataFrame, keys: DataFrame, root: str) -> DataFrame:
    """Write the store of (doc_id, ids) and return its manifest: doc_id, copy, shard, offset, length.

    `keys` is a frame of the same doc_ids that is cheap to read twice: it gives the shards' bounds, which
    are quantiles of the ids, so shards are even and each task streams one. Rows with a null id come
    first; rows that repeat an id are told apart by `copy`, in the order of their ids' bytes.
    """
    rows = keys.count()
    n = max(1, -(-rows // SHARD_ROWS))
    # one bound per shard, by a mergeable sketch
    bounds = keys.approxQuantile("doc_id", [i / n for i in range(1, n)], 1 / (8 * n)) if n > 1 else []
    table = sorted({int(b) for b in bounds})

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = np.array(table, np.int64)
        for batch in batches:
            ids = batch.column(0)
            shard = np.searchsorted(at, ids.fill_null(np.iinfo(np.int64).min).to_numpy(zero_copy_only=False), "right")
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(shard, pa.int32())], ["doc_id", "ids", "shard"])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # rows come in the order of (shard, doc_id); a partition may hold several shards
        files, base = opened(root)
        files.create_dir(base, recursive=True)
        now, stream, attempt, at, last, copy = None, None, "", 0, None, 0

        def close() -> None:
            if stream is not None:
                stream.close()
                files.move(attempt, f"{base}/shard-{now:08d}.bin")

        for batch in batches:
            copies, offsets, lengths = [], [], []
            for shard, doc_id, payload in zip(batch.column("shard").to_pylist(), batch.column("doc_id").to_pylist(), batch.column("ids"), strict=True):
                raw = payload.as_buffer()
                if shard != now:
                    close()
                    now, at, last = shard, 0, ()
                    attempt = f"{base}/.shard-{shard:08d}.{uuid.uuid4().hex}"
                    stream = files.open_output_stream(attempt, buffer_size=1 << 20)
                copy = copy + 1 if doc_id == last else 0
                last = doc_id
                stream.write(raw)
                copies.append(copy)
                offsets.append(at)
                lengths.append(raw.size // 2)
                at += raw.size // 2
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(copies, pa.int64()), batch.column("shard"), pa.array(offsets, pa.int64()), pa.array(lengths, pa.int64())],
                ["doc_id", "copy", "shard", "offset", "length"],
            )
        close()

    dealt = ids.mapInArrow(number, "doc_id bigint, ids binary, shard int").repartitionById(n, "shard")
    manifest = dealt.sortWithinPartitions("shard", F.asc_nulls_first("doc_id"), "ids").mapInArrow(
        write, "doc_id bigint, copy bigint, shard int, offset bigint, length bigint"
    )
    return materialize(manifest)


#: Where a null id is hashed from.
NULL_KEY = np.iinfo(np.int64).min


def _part_of(keys: np.ndarray, parts: int) -> np.ndarray:
    return (mixed(keys, 5) % _WORD(parts)).astype(np.int32)


def _keyed(df: DataFrame, parts: int) -> DataFrame:
    """`df` with `key` (the 64-bit hash, as a signed number) and `part`, its index file."""

    @F.pandas_udf("key bigint, part int")
    def keyed(doc_ids: pd.Series, copies: pd.Series) -> pd.DataFrame:
        keys = key_hash(doc_ids.to_numpy(np.int64), copies.to_numpy(np.int64))
        return pd.DataFrame({"key": keys.view(np.int64), "part": _part_of(keys, parts)})

    return df.withColumn("_k", keyed(F.coalesce("doc_id", F.lit(NULL_KEY)), "copy")).select(*df.columns, "_k.*")


def write_index(manifest: DataFrame, root: str) -> int:
    """Write the index files of a manifest; their number."""
    parts = max(1, -(-manifest.count() // INDEX_KEYS))

    def build(group: pd.DataFrame) -> pd.DataFrame:
        part = int(group["part"].iloc[0])
        raw = pack_index(
            group["key"].to_numpy(np.int64).view(_WORD),
            *(group[c].to_numpy() for c in ("shard", "offset", "length")),
        )
        put(root, f"index-{part:08d}.mph", lambda stream: stream.write(raw))
        return pd.DataFrame({"part": [part], "keys": [len(group)]})

    # a group is about INDEX_KEYS keys: hashing spreads them evenly and no key repeats
    _keyed(manifest, parts).groupBy("part").applyInPandas(build, "part int, keys bigint").agg(F.sum("keys")).collect()
    return parts


def look_up(keys: DataFrame, root: str, parts: int) -> DataFrame:
    """(doc_id, copy, shard, offset, length) of keys (doc_id, copy) through the index; keys that are not stored are left out."""

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        files, base = opened(root)
        now, index = None, None
        for batch in batches:
            for part, group in batch.groupby("part", sort=True):
                if part != now:
                    with files.open_input_file(f"{base}/index-{part:08d}.mph") as file:
                        now, index = part, Index(file.read())
                entries, there = index.look_up(group["key"].to_numpy(np.int64).view(_WORD))
                yield group.loc[there, ["doc_id", "copy"]].assign(
                    shard=entries["shard"][there].astype(np.int32),
                    offset=entries["offset"][there].astype(np.int64),
                    length=entries["length"][there].astype(np.int64),
                )

    dealt = _keyed(keys.select("doc_id", "copy"), parts).repartition("part").sortWithinPartitions("part")
    return dealt.mapInPandas(find, "doc_id bigint, copy bigint, shard int, offset bigint, length bigint")


def read_digests(places: DataFrame, root: str) -> DataFrame:
    """`places` with n_tokens and ids_crc32 of what the shard files hold there.

    Places are dealt by shard and read in order, a bounded stretch at a time, so a shard is read once.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = opened(root)
        now, file, have, held = None, None, (0, 0), np.zeros(0, "<u2")
        for batch in batches:
            n_tokens, sums = [], []
            rows = (batch.column(c).to_pylist() for c in ("shard", "offset", "length"))
            for shard, offset, length in zip(*rows, strict=True):
                if shard != now:
                    if file is not None:
                        file.close()
                    now, file, have = shard, files.open_input_file(f"{base}/shard-{shard:08d}.bin"), (0, 0)
                if not (have[0] <= offset and offset + length <= have[1]):
                    held = np.frombuffer(file.read_at(2 * max(length, READ_IDS), 2 * offset), "<u2")
                    have = (offset, offset + len(held))
                ids = held[offset - have[0] : offset - have[0] + length]
                n_tokens.append(len(ids))
                sums.append(zlib.crc32(ids.astype("<u4").tobytes()))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(n_tokens, pa.int64()), pa.array(sums, pa.int64())],
                [*batch.schema.names, "n_tokens", "ids_crc32"],
            )
        if file is not None:
            file.close()

    dealt = places.repartition("shard").sortWithinPartitions("shard", "offset")
    schema = "doc_id bigint, copy bigint, shard int, offset bigint, length bigint, n_tokens bigint, ids_crc32 bigint"
    return dealt.select("doc_id", "copy", "shard", "offset", "length").mapInArrow(read, schema)


def with_starts(read: DataFrame, manifest: DataFrame) -> DataFrame:
    """`read` with `start`: the ids of all documents before it, from the shards' lengths and its offset."""
    sizes = manifest.groupBy("shard").agg(F.sum("length").alias("size"))
    # one row per shard of SHARD_ROWS documents
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("shard", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("_start"))
    return read.join(starts, "shard").withColumn("start", F.col("_start") + F.col("offset")).drop("_start")
