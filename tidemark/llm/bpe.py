"""BPE encoding and decoding of texts of any length, by concatenation of encoded halves.

Short texts are encoded where they lie. A long text is cut into stretches that are rows of their own,
so tasks share its work; neighbours are then joined pairwise in a tree. A cut at white space needs
nothing. A cut inside a run of letters without white space is mended by encoding a window around the
join anew, wider and wider, until its first and last tokens are those the two sides have there: every
pair of neighbouring tokens then occurs in some encoding, and a sequence whose neighbours all do is
the encoding of the whole.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache, cached_property

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer, models

from tidemark.llm.encoding import encoder, word_units
from tidemark.session import bounded_batches

#: Characters of a stretch, and tokens taken from each side into the first window.
STRETCH, WINDOW = 16_384, 4
WORD_END = "</w>"

#: A place inside a run of letters that no contraction, composition or change of case reaches across.
_INSIDE = regex.compile(r"(?V1)[\p{L}--[İᄀ-ᇿꥠ-꥿ힰ-퟿]]{4}(?=[\p{L}--[İᄀ-ᇿꥠ-꥿ힰ-퟿]])")


@dataclass
class Stretch:
    """Token ids of a stretch; the first `head` belong to a piece that may begin before it, the last
    `tail` to one that may go on after it. `whole`: one piece is all there is."""

    ids: list[int]
    head: int = 0
    tail: int = 0

    @property
    def whole(self) -> bool:
        return bool(self.ids) and self.head == self.tail == len(self.ids)


class Joiner:
    """Encodes stretches with open ends and joins them."""

    def __init__(self, vocabulary: str) -> None:
        self.vocabulary = vocabulary
        self.units = encoder(vocabulary, "<u4")
        self.tokenizer = self.units.tokenizer
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.names = token_names(vocabulary)

    @cached_property
    def pieces(self) -> tuple[Tokenizer, Tokenizer]:
        """For pieces without and with a word end. Made once a cut runs through one, since they are large."""
        with open(public_tokenizers.path(self.vocabulary)) as file:
            model = json.load(file)["model"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        return (
            Tokenizer(models.BPE(vocab=model["vocab"], merges=merges)),
            Tokenizer(models.BPE(vocab=model["vocab"], merges=merges, end_of_word_suffix=WORD_END)),
        )

    def cuts(self, text: str, size: int) -> list[tuple[int, bool]]:
        """Places to cut, and whether a piece runs across; each at the first good place after `size` characters."""
        found, last = [], 0
        while last + 2 * size <= len(text):
            at = last + size
            spaces = [i for c in " \n" if 0 <= (i := text.find(c, at, at + size // 2))]
            if spaces:
                last, inside = min(spaces), False
            else:
                for match in _INSIDE.finditer(text, at):
                    near = match.end()
                    if not any(0 <= text.find(s, max(0, near - len(s) + 1), near + len(s) - 1) for s in self.special):
                        last, inside = near, True
                        break
                else:
                    return found
            found.append((last, inside))
        return found

    def piece(self, name: str) -> list[int]:
        """The ids of a piece given in the vocabulary's characters, with or without its word end."""
        opened, closed = self.pieces
        if name.endswith(WORD_END):
            return closed.encode(name.removesuffix(WORD_END), add_special_tokens=False).ids
        return opened.encode(name, add_special_tokens=False).ids

    def stretch(self, text: str, open_left: bool, open_right: bool) -> Stretch:
        units = word_units(text)
        if not units or not (open_left or open_right):
            return Stretch(np.frombuffer(self.units.encode(units), "<u4").tolist())
        ids, head, tail = [], 0, 0
        for k, unit in enumerate(units):
            first, last = k == 0 and open_left, k == len(units) - 1 and open_right
            if not (first or last):
                ids += np.frombuffer(self.units.encode([unit]), "<u4").tolist()
                continue
            code = self.tokenizer.encode(unit, add_special_tokens=False)
            own, pieces = code.ids, code.word_ids
            if last:
                n = next((i for i, p in enumerate(reversed(pieces)) if p != pieces[-1]), len(own))
                name = "".join(self.names[i] for i in own[len(own) - n :]).removesuffix(WORD_END)
                grown = self.piece(name)
                own, tail = own[: len(own) - n] + grown, len(grown)
                if first and n == len(pieces):
                    head = len(grown)
            if first and not head:
                head = next((i for i, p in enumerate(pieces) if p != pieces[0]), len(own))
            ids += own
        return Stretch(ids, head, tail)

    def join(self, a: Stretch, b: Stretch, across: bool) -> Stretch:
        """The encoding of two neighbouring stretches; `across`: a piece runs over the cut."""
        if not across:
            return Stretch(a.ids + b.ids, a.head, b.tail)
        k = WINDOW
        while True:
            left, right = min(k, a.tail), min(k, b.head)
            own, other = a.ids[len(a.ids) - left :], b.ids[:right]
            new = self.piece("".join(self.names[i] for i in own + other))
            if (left == a.tail or new[0] == own[0]) and (right == b.head or new[-1] == other[-1]):
                break
            k *= 2
        ids = a.ids[: len(a.ids) - left] + new + b.ids[right:]
        run = len(new) + a.tail - left + b.head - right
        head = run if a.whole else a.head
        tail = run if b.whole else b.tail
        return Stretch(ids, head, tail)

    def tree(self, parts: list[Stretch], across: list[bool]) -> Stretch:
        """All stretches of a text, joined half with half; across[i]: between parts i and i + 1."""
        if len(parts) == 1:
            return parts[0]
        half = len(parts) // 2
        return self.join(self.tree(parts[:half], across[: half - 1]), self.tree(parts[half:], across[half:]), across[half - 1])


@cache
def joiner(vocabulary: str) -> Joiner:
    return Joiner(vocabulary)


def encode_whole(text: str, vocabulary: str, size: int = STRETCH) -> list[int]:
    """One text by cutting and joining, in this process: what the rows of a long text go through."""
    j = joiner(vocabulary)
    cuts = j.cuts(text, size)
    ends = [0, *[c for c, _ in cuts], len(text)]
    open_ = [False, *[x for _, x in cuts], False]
    parts = [j.stretch(text[a:b], open_[i], open_[i + 1]) for i, (a, b) in enumerate(zip(ends, ends[1:], strict=False))]
    return j.tree(parts, open_[1:-1]).ids


@cache
def token_names(vocabulary: str) -> list[str]:
    tokenizer = encoder(vocabulary, "<u4").tokenizer
    return [tokenizer.id_to_token(i) or "" for i in range(tokenizer.get_vocab_size(with_added_tokens=True))]


def decode_ids(ids: bytes, vocabulary: str) -> str:
    """The text that ids stand for: without a decoder, the token strings joined by spaces; special tokens stay."""
    names = token_names(vocabulary)
    return " ".join([names[i] for i in np.frombuffer(ids, "<u4").tolist()])


def decoded(ids: Column, vocabulary: str) -> Column:
    """`decode_ids` of a column of ids; null for null."""

    @F.pandas_udf("string")
    def decode(codes: pd.Series) -> pd.Series:
        return codes.map(lambda c: None if c is None else decode_ids(c, vocabulary))

    return decode(ids)


#: Rows sent on at once, so that a batch of long texts is never held with all it becomes.
SLICE = 128


def encode_documents(
    docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text", size: int = STRETCH
) -> DataFrame:
    """(key, ids, decoded): the ids of each row's whole text as little-endian unsigned 32-bit integers, and the
    text they decode to.

    Null and empty texts have no ids and decode to the empty text. Texts under twice `size` characters are encoded in place, without a
    shuffle; longer ones are cut, their stretches dealt out, and brought together again by row, so
    rows that repeat a key or a text stay rows of their own. Other columns are not carried.
    """
    bounded_batches(docs.sparkSession)
    kind = dict(docs.dtypes)[key]
    given = docs.select(F.col(key).alias("k"), F.coalesce(F.col(text), F.lit("")).alias("t"))

    def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = encoder(vocabulary, "<u4")
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE):
                batch = whole.slice(at, SLICE)
                ids = [units.encode(word_units(t.as_py())) for t in batch.column("t")]
                texts = [decode_ids(i, vocabulary) for i in ids]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("k"), pa.array(ids, pa.binary()), pa.array(texts, pa.string())], ["k", "ids", "decoded"]
                )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        j = joiner(vocabulary)
        for batch in batches:
            for k, row, t in zip(batch.column("k"), batch.column("row").to_pylist(), batch.column("t"), strict=True):
                whole = t.as_py()
                cuts = j.cuts(whole, size)
                ends = [0, *[c for c, _ in cuts], len(whole)]
                open_ = [False, *[x for _, x in cuts], False]
                n = len(ends) - 1
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([k.as_py()] * n, batch.schema.field("k").type),
                        pa.array([row] * n),
                        pa.array(range(n), pa.int32()),
                        pa.array(open_[:-1]),
                        pa.array(open_[1:]),
                        pa.array([whole[a:b] for a, b in zip(ends, ends[1:], strict=False)]),
                    ],
                    ["k", "row", "part", "open_left", "open_right", "t"],
                )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        j = joiner(vocabulary)
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE):
                batch = whole.slice(at, SLICE)
                columns = (batch.column(c).to_pylist() for c in ("t", "open_left", "open_right"))
                made = [j.stretch(*x) for x in zip(*columns, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        *[batch.column(c) for c in ("k", "row", "part", "open_left")],
                        pa.array([np.array(s.ids, "<u4").tobytes() for s in made], pa.binary()),
                        pa.array([s.head for s in made], pa.int32()),
                        pa.array([s.tail for s in made], pa.int32()),
                    ],
                    ["k", "row", "part", "open_left", "ids", "head", "tail"],
                )

    def joined(group: pa.Table) -> pa.Table:
        j = joiner(vocabulary)
        group = group.sort_by("part")
        parts = [
            Stretch(np.frombuffer(i, "<u4").tolist(), h, t)
            for i, h, t in zip(*(group[c].to_pylist() for c in ("ids", "head", "tail")), strict=True)
        ]
        ids = np.array(j.tree(parts, group["open_left"].to_pylist()[1:]).ids, "<u4").tobytes()
        return pa.table({"k": group["k"].slice(0, 1), "ids": pa.array([ids], pa.binary()), "decoded": pa.array([decode_ids(ids, vocabulary)])})

    long = F.length("t") >= 2 * size
    made = f"k {kind}, ids binary, decoded string"
    here = given.filter(~long).mapInArrow(short, made)
    # the row's own number only has to hold its stretches together within this one pass
    parts = (
        given.filter(long)
        .withColumn("row", F.concat_ws(".", F.xxhash64("t"), F.monotonically_increasing_id()))
        .mapInArrow(cut, f"k {kind}, row string, part int, open_left boolean, open_right boolean, t string")
        .repartition("row", "part")
        .mapInArrow(encode, f"k {kind}, row string, part int, open_left boolean, ids binary, head int, tail int")
    )
    # a group is the stretches of one text, which was one row before
    whole = parts.groupBy("row").applyInArrow(joined, made)
    return here.unionByName(whole).withColumnRenamed("k", key)
