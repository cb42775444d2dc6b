"""Fill-in-the-middle examples by rotating blocks of a text in place.

A text is cut at two ends of lines. Sentinels are inserted at the cuts of a bytearray, which leaves the blocks
`<P>`prefix, `<M>`middle, `<S>`suffix in the text's own order; neighbouring blocks are then exchanged by rotation:
each is reversed, then both together. The same rotations the other way and the removal of the sentinels
give the text back exactly. Nothing leaves its row, so there is no shuffle.
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

#: Bytes exchanged at once by a reversal; rows handed on at once.
BLOCK, SLICE = 1 << 16, 256
PLAIN, PSM, SPM = "plain", "psm", "spm"


@dataclass(frozen=True)
class FimConfig:
    """`share` percent of the texts are transformed, `spm` percent of those with the suffix first."""

    seed: int = 7
    share: int = 100
    spm: int = 50
    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"

    def __post_init__(self) -> None:
        marks = (self.prefix, self.suffix, self.middle)
        # then no sentinel can appear across the border of a text and a sentinel, and each is found where it was put
        if not all(marks) or len(set(marks)) < 3 or any(m[0] in x[1:] for m in marks for x in marks):
            raise ValueError("sentinels must differ, and their first characters stand nowhere else in them")


def reverse(buffer: bytearray, start: int, end: int) -> None:
    """Reverse the bytes from `start` to `end` in place, a block from either side at a time."""
    while end - start > 1:
        n = min(BLOCK, (end - start) // 2)
        head = buffer[start : start + n]
        buffer[start : start + n] = buffer[end - n : end][::-1]
        buffer[end - n : end] = head[::-1]
        start, end = start + n, end - n


def rotate(buffer: bytearray, start: int, middle: int, end: int) -> None:
    """Exchange the neighbouring blocks [start, middle) and [middle, end) in place by three reversals."""
    reverse(buffer, start, middle)
    reverse(buffer, middle, end)
    reverse(buffer, start, end)


@dataclass(frozen=True)
class Example:
    """What became of one text: its number of lines, the form, the output and the lengths in code points."""

    lines: int
    form: str
    output: bytes
    prefix_chars: int | None = None
    middle_chars: int | None = None


def draws(key: str, seed: int) -> list[int]:
    """Four numbers of 32 bits that the key and the seed decide."""
    digits = hashlib.sha256(f"{seed}:{key}".encode()).hexdigest()
    return [int(digits[i : i + 8], 16) for i in range(0, 32, 8)]


def transformed(text: bytes, key: str, config: FimConfig) -> Example:
    """One text (UTF-8) in the form that its key draws. Lines keep their line feed; the last may have none."""
    buffer = bytearray(text)
    ends = np.flatnonzero(np.frombuffer(text, np.uint8) == ord("\n")) + 1
    if len(text) and (not len(ends) or ends[-1] < len(text)):
        ends = np.append(ends, len(text))
    n, (h1, h2, h3, h4) = len(ends), draws(key, config.seed)
    prefix, suffix, middle = (x.encode() for x in (config.prefix, config.suffix, config.middle))
    if not n or h3 % 100 >= config.share or any(mark in buffer for mark in (prefix, suffix, middle)):
        return Example(n, PLAIN, text)
    first, second = (int(ends[k - 1]) if k else 0 for k in sorted((h1 % (n + 1), h2 % (n + 1))))
    lengths = len(text[:first].decode()), len(text[first:second].decode())
    # from the last to the first, so that the cuts before stay where they are
    buffer[second:second] = suffix
    buffer[first:first] = middle
    buffer[0:0] = prefix
    at_middle, at_suffix = first + len(prefix), second + len(prefix) + len(middle)
    rotate(buffer, at_middle, at_suffix, len(buffer))
    if h4 % 100 >= config.spm:
        return Example(n, PSM, bytes(buffer), *lengths)
    rotate(buffer, 0, at_middle, at_middle + len(buffer) - at_suffix)
    return Example(n, SPM, bytes(buffer), *lengths)


def restored_text(output: bytes, form: str, config: FimConfig) -> bytes:
    """The text that `transformed` made this output from, by the inverse rotations."""
    if form == PLAIN:
        return output
    buffer = bytearray(output)
    prefix, suffix, middle = (x.encode() for x in (config.prefix, config.suffix, config.middle))
    if form == SPM:
        rotate(buffer, 0, buffer.index(prefix), buffer.index(middle))
    rotate(buffer, buffer.index(suffix), buffer.index(middle), len(buffer))
    for mark in (suffix, middle, prefix):
        at = buffer.index(mark)
        del buffer[at : at + len(mark)]
    return bytes(buffer)


_KINDS = {"n_lines": T.LongType(), "form": T.StringType(), "output": T.StringType(), "prefix_chars": T.LongType(), "middle_chars": T.LongType()}
ADDED = T.StructType([T.StructField(name, kind) for name, kind in _KINDS.items()])


def fill_in_middle(docs: DataFrame, config: FimConfig = FimConfig(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """`docs` with `n_lines`, `form` (plain, psm or spm), `output`, `prefix_chars` and `middle_chars` (null where plain).

    Columns of those names are replaced, all others stay as they are. A null text is the empty one, and an
    empty text or one that holds a sentinel stays plain. A null key draws like the empty string; rows that
    repeat a key draw alike, each over its own lines. An empty table stays empty.
    """
    names = {f.name for f in ADDED}
    rest = [c for c in docs.columns if c.lower() not in names]
    own = private(docs.select(*rest), "key", "text")
    given = docs.select(*rest, F.col(key).cast("string").alias(own[0]), F.col(text).alias(own[1]))
    schema = T.StructType([*docs.select(*rest).schema, *ADDED])

    def transform(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE):
                batch = whole.slice(at, SLICE)
                keys, texts = batch.columns[-2:]
                made = [transformed((t.as_py() or "").encode(), k.as_py() or "", config) for k, t in zip(keys, texts, strict=True)]
                columns = [
                    pa.array([x.lines for x in made], pa.int64()),
                    pa.array([x.form for x in made], pa.string()),
                    pa.array([x.output for x in made], pa.binary()).cast(pa.string()),
                    pa.array([x.prefix_chars for x in made], pa.int64()),
                    pa.array([x.middle_chars for x in made], pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays([*batch.columns[:-2], *columns], [*rest, *[f.name for f in ADDED]])

    return given.mapInArrow(transform, schema)


def restored(examples: DataFrame, config: FimConfig = FimConfig(), output: str = "output", form: str = "form", text: str = "restored") -> DataFrame:
    """`examples` with the exact text behind each output; a column of that name is replaced.

    Only the output and its form are read. A row without either gives null; an empty table stays empty.
    """
    rest = [c for c in examples.columns if c.lower() != text.lower()]
    own = private(examples.select(*rest), "output", "form")
    given = examples.select(*rest, F.col(output).alias(own[0]), F.col(form).alias(own[1]))
    schema = T.StructType([*examples.select(*rest).schema, T.StructField(text, T.StringType())])

    def restore(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE):
                batch = whole.slice(at, SLICE)
                pairs = zip(*(c.to_pylist() for c in batch.columns[-2:]), strict=True)
                texts = [None if x is None or f is None else restored_text(x.encode(), f, config) for x, f in pairs]
                made = pa.array(texts, pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays([*batch.columns[:-2], made], [*rest, text])

    return given.mapInArrow(restore, schema)
