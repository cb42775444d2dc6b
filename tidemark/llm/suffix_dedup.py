"""Byte-exact repeats across documents, by difference-cover suffix sorting of what can repeat at all.

1. Texts are packed into units of some 100 kB, each a row, stored once, and no text is shuffled. Of equal texts, told
   by digest, the first document's takes part in what follows; each unit gets back which of its documents are later ones.
2. Every window of `length` bytes is owned by an anchor, its smallest gram of `GRAM` bytes (winnowing), so equal windows
   have equal anchors. Anchors are counted over all units; windows of an anchor that only one document
   has cannot repeat and are discarded.
3. The windows of each other anchor occurrence form a snippet. Snippets meet by anchor; of equal ones the first
   document's stays. A block of them is suffix-sorted by the difference cover of 3 (triples, recursion on names,
   merge), and neighbours with `length` equal bytes share the smallest document.
4. Each unit gets back which of its windows an earlier document has, and cuts the bytes they cover.

An anchor that very many units have is dealt over several blocks by its snippets, so equal ones still meet; the classes
of the different ones are then joined by digest.
Units read what comes back to them from files in the shared folder.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.shared_files import get, put
from tidemark.llm.suffix_array import equal_prefixes
from tidemark.session import bounded_batches, materialize, materialize_long_rows, scratch_dir

_U = np.uint64
#: Bytes of an anchor.
GRAM = 24


@dataclass(frozen=True)
class RepeatConfig:
    """`length`: bytes that must be equal. The others bound what a task holds: bytes of a unit and of the stretch of it
    worked on at once, anchors of a bucket, snippet bytes sorted at once, and the units after which an anchor is split."""

    length: int = 50
    unit_bytes: int = 400_000
    stretch_bytes: int = 500_000
    bucket_units: int = 40
    block_units: int = 10
    sort_bytes: int = 600_000
    split_units: int = 128


#: Stands for a null id, before all others.
NULL_ID = -(1 << 63)
#: The mask of all windows of a snippet.
EVERY = -1
#: Units of a row group.
UNITS_AT_ONCE = 8


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = (a * _U(0x9E3779B97F4A7C15)) ^ (b + _U(0x94D049BB133111EB))
    x = (x ^ (x >> _U(29))) * _U(0xBF58476D1CE4E5B9)
    return x ^ (x >> _U(32))


def gram_hashes(c: np.ndarray) -> np.ndarray:
    """64-bit hashes of all grams of `GRAM` bytes, put together from powers of two."""
    have, size, out, done = _mix(c.astype(_U), np.zeros(len(c), _U)), 1, None, 0
    left = GRAM
    while left:
        if left & 1:
            if out is None:
                out, done = have, size
            else:
                n = len(have) - done
                out, done = _mix(out[:n], have[done:]), done + size
        left >>= 1
        if left:
            have, size = _mix(have[:-size], have[size:]), size * 2
    return out


_LOWER, _UPPER = _U(0xFFFFFFFF), _U(0xFFFFFFFF00000000)


@dataclass
class Owned:
    """Runs of windows with one owner: first and last window, the owner's place and hash, in the order of the text."""

    first: np.ndarray
    last: np.ndarray
    place: np.ndarray
    anchor: np.ndarray


def owned_windows(c: np.ndarray, ends: np.ndarray, length: int) -> Owned:
    """Of all windows inside texts that end at `ends` in the bytes `c`."""
    starts = np.concatenate(([0], ends[:-1]))
    none = np.zeros(0, np.int64)
    if len(c) < length:
        return Owned(none, none, none, none.astype(_U))
    h = gram_hashes(c)
    width = length - GRAM + 1
    # half of the hash, then the place from the right: of equal hashes the last is least, so that the choice
    # depends on the window's bytes alone
    value, span = (h & _UPPER) | (_LOWER - np.arange(len(h), dtype=_U)), 1
    while span < width:
        step = min(span, width - span)
        value, span = np.minimum(value[step:], value[:-step]), span + step
    inside = np.zeros(len(c) + 1, np.int32)
    long = ends - starts >= length
    np.add.at(inside, starts[long], 1)
    np.add.at(inside, ends[long] - length + 1, -1)
    valid = np.flatnonzero(np.cumsum(inside[: len(value)]) > 0)
    if not len(valid):
        return Owned(none, none, none, none.astype(_U))
    owner = (_LOWER - (value[valid] & _LOWER)).astype(np.int64)
    new = np.concatenate(([True], (np.diff(owner) != 0) | (np.diff(valid) != 1)))
    heads = np.flatnonzero(new)
    tails = np.concatenate((heads[1:], [len(valid)])) - 1
    # owners are least hashes, so most of them are small: mixed once more, they fall into buckets of like size
    return Owned(valid[heads], valid[tails], owner[heads], _mix(h[owner[heads]], np.zeros(1, _U)))


def _stretches(text: bytes, ends: np.ndarray, size: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Whole documents of a unit, about `size` bytes at once: first and last document, bytes, their ends in these."""
    low = 0
    while low < len(ends):
        base = int(ends[low - 1]) if low else 0
        high = max(low + 1, int(np.searchsorted(ends, base + size, "right")))
        yield low, high, np.frombuffer(text, np.uint8, int(ends[high - 1]) - base, base), ends[low:high] - base
        low = high


def _packed(docs: DataFrame, config: RepeatConfig) -> DataFrame:
    """(unit, ids, ends, digests, text): texts one after the other, their ids (null: NULL_ID) and ends as 64-bit numbers,
    their digests of 16 bytes."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, ids, texts, held = TaskContext.get().partitionId() << 32, [], [], 0

        def made() -> pa.RecordBatch:
            ends = np.cumsum([len(t) for t in texts])
            digests = b"".join(hashlib.md5(t).digest() for t in texts)
            columns = [[number], [np.array(ids, np.int64).tobytes()], [ends.astype(np.int64).tobytes()], [digests], [b"".join(texts)]]
            kinds = [pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.binary()]
            names = ["unit", "ids", "ends", "digests", "text"]
            return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(columns, kinds, strict=True)], names)

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                raw = (text.as_py() or "").encode()
                if texts and held + len(raw) > config.unit_bytes:
                    yield made()
                    number, ids, texts, held = number + 1, [], [], 0
                ids.append(NULL_ID if doc_id is None else doc_id)
                texts.append(raw)
                held += len(raw)
        if texts:
            yield made()

    return docs.select("doc_id", "text").mapInArrow(pack, "unit bigint, ids binary, ends binary, digests binary, text binary")


def _find_late(units: DataFrame, root: str) -> None:
    """Leave a file for each unit that has any: the places of documents whose whole text one with a smaller id has."""

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            ids = np.frombuffer(row["ids"], np.int64)
            columns = [
                pa.array(np.full(len(ids), row["unit"]), pa.int64()),
                pa.array(np.arange(len(ids)), pa.int32()),
                pa.array(ids, pa.int64()),
                pa.array([row["digests"][16 * i : 16 * i + 16] for i in range(len(ids))], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["unit", "place", "doc", "same"])

    def keep(group: pa.Table) -> pa.Table:
        unit = group["unit"][0].as_py()
        raw = np.sort(group["place"].to_numpy()).astype(np.int32).tobytes()
        put(root, f"late-{unit}", lambda stream: stream.write(raw))
        return pa.table({"unit": pa.array([unit], pa.int64())})

    docs = units.select("unit", "ids", "digests").mapInArrow(digests, "unit bigint, place int, doc bigint, same binary")
    twins = docs.groupBy("same").agg(F.min("doc").alias("first"), F.max("doc").alias("last")).filter("first <> last")
    # the same plan at every size
    late = docs.join(twins.hint("merge"), "same").filter("doc > first").select("unit", "place")
    late.groupBy("unit").applyInArrow(keep, "unit bigint").agg(F.count("*")).collect()


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Units one at a time: a batch may hold many."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def _late(row: dict, root: str) -> np.ndarray:
    """Whether each document of a unit repeats the whole text of one with a smaller id."""
    late = np.zeros(len(row["ids"]) // 8, bool)
    late[np.frombuffer(get(root, f"late-{row['unit']}") or b"", np.int32)] = True
    return late


def _firsts(row: dict, late: np.ndarray) -> dict:
    """A unit without its documents that repeat a whole text."""
    if not late.any():
        return row
    ids, ends, text = _unit(row)
    starts = np.concatenate(([0], ends[:-1]))
    kept = np.flatnonzero(~late)
    texts = b"".join([text[a:b] for a, b in zip(starts[kept].tolist(), ends[kept].tolist(), strict=True)])
    return row | {"ids": ids[kept].tobytes(), "ends": np.cumsum((ends - starts)[kept]).astype(np.int64).tobytes(), "text": texts}


def _first_rows(batches: Iterator[pa.RecordBatch], root: str) -> Iterator[dict]:
    """Units without their later documents of a text; those that have no others are left out."""
    for row in _rows(batches):
        row = _firsts(row, _late(row, root))
        if row["ids"]:
            yield row


def _unit(row: dict) -> tuple[np.ndarray, np.ndarray, bytes]:
    return np.frombuffer(row["ids"], np.int64), np.frombuffer(row["ends"], np.int64), row["text"]


def _unit_runs(row: dict, config: RepeatConfig) -> list[tuple[int, int, np.ndarray, np.ndarray, Owned]]:
    """Stretch by stretch: first and last document, bytes, the documents' ends in them, and the runs of windows."""
    _, ends, text = _unit(row)
    return [(*x, owned_windows(x[2], x[3], config.length)) for x in _stretches(text, ends, config.stretch_bytes)]


def _distinct_anchors(stretches: list) -> np.ndarray:
    return np.unique(np.concatenate([x[4].anchor for x in stretches]))


def _unit_anchors(row: dict, config: RepeatConfig) -> tuple[np.ndarray, np.ndarray]:
    """A unit's distinct anchors in order, and whether several of its documents have each."""
    ids, _, _ = _unit(row)
    stretches = _unit_runs(row, config)
    anchors = np.concatenate([x[4].anchor for x in stretches])
    docs = np.concatenate([ids[low:high][np.searchsorted(own, runs.first, "right")] for low, high, _, own, runs in stretches])
    order = np.argsort(anchors, kind="stable")
    anchors, docs = anchors[order], docs[order]
    if not len(anchors):
        return anchors, np.zeros(0, bool)
    heads = np.flatnonzero(np.concatenate(([True], anchors[1:] != anchors[:-1])))
    return anchors[heads], np.minimum.reduceat(docs, heads) != np.maximum.reduceat(docs, heads)


def _count_anchors(units: DataFrame, n_units: int, root: str, config: RepeatConfig) -> None:
    """Leave a file for each unit: one byte per distinct anchor, 0 where one document alone has it, else 1 and the
    binary logarithm of the blocks it is dealt over."""
    buckets = -(-n_units // config.bucket_units)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _first_rows(batches, root):
            anchors, several = _unit_anchors(row, config)
            # anchors are in order, so what a bucket sends back can be put together by place
            bucket = ((anchors >> _U(32)) * _U(buckets) >> _U(32)).astype(np.int64)
            heads = np.searchsorted(bucket, np.arange(buckets + 1))
            some = np.flatnonzero(np.diff(heads))
            low = (anchors & _U(0xFFFFFFFF)).astype(np.uint32)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(some, pa.int64()),
                    pa.array([row["unit"]] * len(some), pa.int64()),
                    pa.array([low[heads[b] : heads[b + 1]].tobytes() for b in some], pa.binary()),
                    pa.array([np.packbits(several[heads[b] : heads[b + 1]]).tobytes() for b in some], pa.binary()),
                ],
                ["bucket", "unit", "low", "several"],
            )

    def count(group: pa.Table) -> pa.Table:
        # every unit gives an anchor once, so a bucket holds its share of the units' distinct anchors
        lows = [np.frombuffer(x, np.uint32) for x in group["low"].to_pylist()]
        several = [np.unpackbits(np.frombuffer(s, np.uint8), count=len(x)) for s, x in zip(group["several"].to_pylist(), lows, strict=True)]
        values, place, held = np.unique(np.concatenate(lows), return_inverse=True, return_counts=True)
        repeated = held > 1
        repeated[place[np.concatenate(several) > 0]] = True
        blocks = np.ceil(np.log2(np.maximum(held / config.split_units, 1))).astype(np.uint8)
        codes = np.where(repeated, blocks + 1, 0).astype(np.uint8)[place]
        cuts = np.cumsum([len(x) for x in lows])[:-1]
        sent = [x.tobytes() for x in np.split(codes, cuts)]
        return pa.table({"bucket": group["bucket"], "unit": group["unit"], "codes": pa.array(sent, pa.binary())})

    def keep(group: pa.Table) -> pa.Table:
        group = group.sort_by("bucket")
        unit = group["unit"][0].as_py()
        raw = b"".join(group["codes"].to_pylist())
        put(root, f"codes-{unit}", lambda stream: stream.write(raw))
        return pa.table({"unit": pa.array([unit], pa.int64())})

    dealt = units.select("unit", "ids", "ends", "text").mapInArrow(deal, "bucket bigint, unit bigint, low binary, several binary")
    counted = dealt.groupBy("bucket").applyInArrow(count, "bucket bigint, unit bigint, codes binary")
    counted.groupBy("unit").applyInArrow(keep, "unit bigint").agg(F.count("*")).collect()


@dataclass(slots=True)
class _Run:
    """A snippet of a unit: the document, where its first window starts in its stretch, and its bytes."""

    slot: int
    doc: int
    first: int
    windows: int
    anchor: int
    code: int
    bytes: bytes


def _repeated_runs(row: dict, root: str, config: RepeatConfig) -> list[tuple[int, int, np.ndarray, np.ndarray, list[_Run]]]:
    """Stretch by stretch, the runs of windows whose anchor is repeated; slots number them through the unit."""
    ids, _, _ = _unit(row)
    stretches = _unit_runs(row, config)
    anchors = _distinct_anchors(stretches)
    codes = np.frombuffer(get(root, f"codes-{row['unit']}") or b"", np.uint8)
    slot, out = 0, []
    for low, high, c, own, runs in stretches:
        code = codes[np.searchsorted(anchors, runs.anchor)] if len(runs.anchor) else np.zeros(0, np.uint8)
        some = np.flatnonzero(code)
        raw, length = c.tobytes(), config.length
        doc = ids[low:high][np.searchsorted(own, runs.first[some], "right")]
        first, last, place = runs.first[some], runs.last[some], runs.place[some]
        rows = zip(doc.tolist(), first.tolist(), last.tolist(), (place - first).tolist(), runs.anchor[some].view(np.int64).tolist(), code[some].tolist(), strict=True)
        # the owner's place in the snippet is part of what must be equal; so is the number of windows
        found = [
            _Run(slot + k, d, a, b - a + 1, anchor, x, _PLACES[p] + raw[a : b + length])
            for k, (d, a, b, p, anchor, x) in enumerate(rows)
        ]
        slot += len(found)
        out.append((low, high, c, own, found))
    return out


_PLACES = [bytes([i]) for i in range(256)]


def _heads(stretches: list) -> dict[tuple[int, bytes], _Run]:
    """For each different snippet of a unit, its run in the smallest document."""
    heads: dict[tuple[int, bytes], _Run] = {}
    for *_, runs in stretches:
        for run in runs:
            held = heads.setdefault((run.anchor, run.bytes), run)
            if run.doc < held.doc:
                heads[run.anchor, run.bytes] = run
    return heads


def _sorted_classes(snippets: list[bytes], length: int) -> list[np.ndarray]:
    """For each snippet a number per window, equal for windows of equal bytes, by one suffix array of them all."""
    sizes = [len(s) for s in snippets]
    text = np.zeros(sum(sizes) + len(snippets), np.int64)
    starts, at = [], 0
    for s, n in zip(snippets, sizes, strict=True):
        text[at : at + n] = np.frombuffer(s, np.uint8)
        text[at : at + n] += 2
        text[at + n] = 1
        starts.append(np.arange(at, at + n - length + 1))
        at += n + 1
    classes = equal_prefixes(text, np.concatenate(starts), length)
    return np.split(classes, np.cumsum([len(s) for s in starts])[:-1])


def _matched(units: DataFrame, n_units: int, root: str, config: RepeatConfig) -> DataFrame:
    """(unit, slot, mask): for the heads of a unit's snippets, windows that an earlier document has; the masks of a slot add up."""
    blocks = max(1, n_units // config.block_units)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _first_rows(batches, root):
            heads = list(_heads(_repeated_runs(row, root, config)).values())
            for at in range(0, len(heads), 4096):
                part = heads[at : at + 4096]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([(h.anchor >> 8) % blocks for h in part], pa.int64()),
                        # a split anchor's snippet goes to one of its blocks, the same from all units
                        pa.array([zlib.crc32(h.bytes) % (1 << (h.code - 1)) if h.code > 1 else 0 for h in part], pa.int64()),
                        pa.array([h.anchor for h in part], pa.int64()),
                        pa.array([h.code > 1 for h in part], pa.bool_()),
                        pa.array([row["unit"]] * len(part), pa.int64()),
                        pa.array([h.slot for h in part], pa.int32()),
                        pa.array([h.doc for h in part], pa.int64()),
                        pa.array([h.bytes for h in part], pa.binary()),
                    ],
                    ["block", "deal", "anchor", "split", "unit", "slot", "doc", "snippet"],
                )

    names = ["unit", "slot", "doc", "mask", "bit", "digest"]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]

    def compare(group: pa.Table) -> pa.Table:
        out: list[list] = [[] for _ in names]

        def say(*values) -> None:
            for column, value in zip(out, values, strict=True):
                column.append(value)

        def settle(anchors: list[list[tuple]]) -> None:
            """Sort the first documents' snippets of some anchors at once, and say what is matched."""
            rows = [row for anchor in anchors for row in anchor]
            bodies = [r[0][1:] for r in rows]
            classes = _sorted_classes(bodies, config.length)
            counts = np.array([len(c) for c in classes])
            docs = np.array([r[1] for r in rows])
            flat = np.concatenate(classes)
            least = np.full(int(flat.max()) + 1, np.iinfo(np.int64).max)
            np.minimum.at(least, flat, np.repeat(docs, counts))
            hit = least[flat] < np.repeat(docs, counts)
            at = 0
            for (snippet, doc, unit, slot, split), n in zip(rows, counts.tolist(), strict=True):
                bits = hit[at : at + n]
                mask = int(sum(1 << i for i in np.flatnonzero(bits).tolist()))
                if mask:
                    say(unit, slot, doc, mask, None, None)
                if split:
                    for i in np.flatnonzero(~bits).tolist():
                        body = snippet[1 + i : 1 + i + config.length]
                        say(unit, slot, doc, 0, i, hashlib.blake2b(body, digest_size=16).digest())
                at += n

        group = group.sort_by("anchor")
        pending, size, now = [], 0, None
        firsts: dict = {}

        def close() -> None:
            nonlocal pending, size, firsts
            rows = list(firsts.values())
            if len(rows) > 1 or rows and rows[0][4]:
                pending.append(rows)
                size += sum(len(r[0]) for r in rows)
            if size >= config.sort_bytes:
                settle(pending)
                pending, size = [], 0
            firsts = {}

        columns = (group[c].to_pylist() for c in ("anchor", "split", "unit", "slot", "doc", "snippet"))
        for anchor, split, unit, slot, doc, snippet in zip(*columns, strict=True):
            if anchor != now:
                close()
                now = anchor
            held = firsts.get(snippet)
            row = (snippet, doc, unit, slot, split)
            if held is None:
                firsts[snippet] = row
            elif held[1] < doc:
                say(unit, slot, doc, EVERY, None, None)
            elif held[1] > doc:
                firsts[snippet] = row
                say(held[2], held[3], held[1], EVERY, None, None)
            else:  # the same id in two units: both are first
                firsts[snippet, len(firsts)] = row
        close()
        if pending:
            settle(pending)
        return pa.table([pa.array(x, k) for x, k in zip(out, kinds, strict=True)], names)

    sent = units.select("unit", "ids", "ends", "text").mapInArrow(
        send, "block bigint, deal bigint, anchor bigint, split boolean, unit bigint, slot int, doc bigint, snippet binary"
    )
    found = materialize(
        sent.groupBy("block", "deal").applyInArrow(compare, "unit bigint, slot int, doc bigint, mask bigint, bit int, digest binary")
    )
    whole = found.filter("digest is null").select("unit", "slot", "mask")
    classes = found.filter("digest is not null")
    # a block says a class once, for its first document, so a class has as many rows as its anchor has blocks
    first = F.min("doc").over(Window.partitionBy("digest"))
    late = classes.withColumn("first", first).filter("first < doc").selectExpr("unit", "slot", "shiftleft(1L, bit) as mask")
    return whole.unionByName(late)


def _keep_masks(masks: DataFrame, root: str) -> None:
    """Leave a file of slots and masks for each unit that has any."""

    def keep(group: pa.Table) -> pa.Table:
        unit = group["unit"][0].as_py()
        slot, mask = group["slot"].to_numpy().astype(np.int64), group["mask"].to_numpy().astype(np.int64)
        order = np.argsort(slot, kind="stable")
        slot, mask = slot[order], mask[order]
        heads = np.flatnonzero(np.concatenate(([True], slot[1:] != slot[:-1])))
        raw = slot[heads].tobytes() + np.bitwise_or.reduceat(mask, heads).tobytes()
        put(root, f"masks-{unit}", lambda stream: stream.write(raw))
        return pa.table({"unit": pa.array([unit], pa.int64())})

    masks.groupBy("unit").applyInArrow(keep, "unit bigint").agg(F.count("*")).collect()


def _cut(units: DataFrame, root: str, config: RepeatConfig) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept) of the documents in units; whole repeats of `length` bytes go."""
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            late = _late(row, root)
            ids, ends, text = _unit(row)
            twins: list[list] = [[] for _ in names]
            for i in np.flatnonzero(late).tolist():
                body = text[int(ends[i - 1]) if i else 0 : int(ends[i])]
                left = b"" if len(body) >= config.length else body
                gone = len(body) - len(left)
                values = (int(ids[i]), len(body), gone, int(gone > 0), hashlib.sha256(left).hexdigest(), left)
                for column, value in zip(twins, values, strict=True):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(twins, kinds, strict=True)], names)
            row = _firsts(row, late)
            if not row["ids"]:
                continue
            ids = np.frombuffer(row["ids"], np.int64)
            raw = get(root, f"masks-{row['unit']}") or b""
            table = np.frombuffer(raw, np.int64).reshape(2, -1)
            masks = dict(zip(table[0].tolist(), table[1].tolist(), strict=True))
            stretches = _repeated_runs(row, root, config)
            heads = _heads(stretches)
            for low, _, c, ends, runs in stretches:
                covered = np.zeros(len(c) + 1, np.int32)
                for run in runs:
                    head = heads[run.anchor, run.bytes]
                    mask = (EVERY if head.doc < run.doc else masks.get(head.slot, 0)) & (1 << run.windows) - 1
                    at = 0
                    while mask >> at:
                        if mask >> at & 1:
                            n = ((~(mask >> at)) & (mask >> at) + 1).bit_length() - 1
                            covered[run.first + at] += 1
                            covered[run.first + at + n - 1 + config.length] -= 1
                            at += n
                        else:
                            at += 1
                gone = np.cumsum(covered[:-1]) > 0
                out: list[list] = [[] for _ in names]
                start = 0
                for d, end in enumerate(ends.tolist()):
                    mine = gone[start:end]
                    left = c[start:end][~mine].tobytes()
                    spans = int((np.diff(np.concatenate(([0], mine.view(np.int8)))) == 1).sum())
                    doc_id = int(ids[low + d])
                    values = (None if doc_id == NULL_ID else doc_id, end - start, int(mine.sum()), spans, hashlib.sha256(left).hexdigest(), left)
                    for column, value in zip(out, values, strict=True):
                        column.append(value)
                    start = end
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(out, kinds, strict=True)], names)

    schema = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary"
    return units.select("unit", "ids", "ends", "text").mapInArrow(cut, schema)


def without_repeats(docs: DataFrame, config: RepeatConfig = RepeatConfig(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept) of every row: its UTF-8 bytes without those covered by a
    string of `length` bytes that also starts in a document with a smaller id. `kept` holds the bytes left.

    Strings are judged on the texts as given. Null texts are empty; a null id comes before all others. Rows that
    share an id do not cover each other. Texts that equal one with a smaller id are whole repeats and take no part
    in the sorting.
    """
    spark = docs.sparkSession
    if config.length < GRAM or config.length - GRAM > 60:
        raise ValueError(f"length must be from {GRAM} to {GRAM + 60}")
    given = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    bounded_batches(spark)
    units = materialize_long_rows(_packed(given, config), UNITS_AT_ONCE)
    root = f"{scratch_dir(spark)}/repeats-{uuid.uuid4().hex}"
    n_units = units.count()
    if n_units:
        _find_late(units, root)
        _count_anchors(units, n_units, root, config)
        _keep_masks(_matched(units, n_units, root, config), root)
    return _cut(units, root, config)
