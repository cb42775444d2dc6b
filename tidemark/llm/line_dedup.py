"""Line-level deduplication by winnowing over line hashes.

A window is the shortest run of lines, from a given line on, that has `words` words; its fingerprint is
the smallest line hash in it (the last of equal ones). Equal windows choose the same fingerprint, so a
run that repeats with at least `words` words from a line's start on shares one for certain. Fingerprints found in
one place only are passed by; at the others, equal windows are joined by position, each later one to the
first, and windows that lie on or next to each other are one run.

Windows that begin at a line reach back to the beginning of a repeated run, but not to its end: its last lines may
have too few words to begin one. So the shortest runs that END at a line are windows too. A line of a
repeated run either begins a window inside the run or lies in the window that ends where the run ends, so
together they are each maximal run, whichever earlier place it repeats, without a walk along diagonals.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.names import private
from tidemark.session import bounded_batches, materialize

#: The least words of a repeated run.
RUN_WORDS = 8
_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def windows(text: str, words: int) -> Iterator[tuple[int, int, int, bytes]]:
    """(first line, number of lines, fingerprint, 128-bit digest) of every window of a text: the shortest runs
    that begin at a line, and those that end at one, where they begin no window of the same lines.

    Only lines with words begin a window; lines without any are passed over inside one. The digest is of the
    lines with words, joined; the fingerprint is the least of their 64-bit hashes.
    """
    lines = text.split("\n")
    sizes = [len(_WORD.findall(x)) for x in lines]
    full = [i for i, n in enumerate(sizes) if n]
    hashes = {i: xxhash.xxh3_64_intdigest(lines[i].encode()) for i in full}

    def window(members: list[int]) -> tuple[int, int, int, bytes]:
        joined = "\n".join([lines[i] for i in members]).encode()
        return members[0], members[-1] - members[0] + 1, min(hashes[i] for i in members), xxhash.xxh3_128_digest(joined)

    last, held = 0, 0
    for at, start in enumerate(full):
        while last < len(full) and held < words:
            held += sizes[full[last]]
            last += 1
        if held < words:
            break
        yield window(full[at:last])
        held -= sizes[start]
    first, held = 0, 0
    for at, end in enumerate(full):
        held += sizes[end]
        while held - sizes[full[first]] >= words:
            held -= sizes[full[first]]
            first += 1
        # otherwise it is the window that its first line begins
        if held - sizes[end] >= words:
            yield window(full[first : at + 1])


def row_key(text: str = "text") -> Column:
    """What tells apart rows that repeat an id: rows equal in both are one document."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def repeated_windows(
    docs: DataFrame, words: int = RUN_WORDS, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, row, line, lines, first_id, first_row, first_line): windows that occur earlier, and where first.

    The order of positions is (doc_id, row, line), null ids first; `row` is a hash of the text. Rows equal in
    id and text are one document. Only hashes and positions are shuffled, and all minima are combined
    before they are, so a line that is everywhere is no hot key.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "row", "line", "lines", "mark", "digest"]
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.binary()]
        for batch in batches:
            out = [[] for _ in names]
            for doc_id, row, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                for line, n, mark, digest in windows(t.as_py() or "", words):
                    for column, value in zip(out, (doc_id, row, line, n, mark - (1 << 63), digest), strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(out, kinds, strict=True)], names)

    bounded_batches(docs.sparkSession)
    given = docs.select(F.col(key).cast("bigint"), row_key(text).alias("row"), F.col(text))
    found = materialize(given.mapInArrow(cut, "doc_id bigint, row bigint, line int, lines int, mark bigint, digest binary"))
    place = F.struct(F.coalesce("doc_id", F.lit(-(1 << 63))).alias("id"), "row", "line")
    # two places of a fingerprint suffice; numbers instead of a struct keep the aggregate hashed
    spot = F.xxhash64(place)
    marks = found.groupBy("mark").agg(F.min(spot).alias("_a"), F.max(spot).alias("_b")).filter("_a <> _b").select("mark")
    likely = materialize(found.join(marks, "mark", "left_semi"))
    firsts = likely.groupBy("digest").agg(F.min(place).alias("first"), F.max(place).alias("_last")).filter("first <> _last")
    later = likely.join(firsts.select("digest", "first"), "digest").filter(place != F.col("first"))
    return later.select(
        "doc_id", "row", "line", "lines",
        F.when(F.col("first.id") != -(1 << 63), F.col("first.id")).alias("first_id"),
        F.col("first.row").alias("first_row"),
        F.col("first.line").alias("first_line"),
    ).distinct()


def repeated_runs(matches: DataFrame) -> DataFrame:
    """(doc_id, row, line, lines): the maximal later runs, from windows that lie on or next to each other."""
    order = Window.partitionBy("doc_id", "row").orderBy("line")
    ends = matches.withColumn("end", F.col("line") + F.col("lines"))
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    begins = ends.withColumn("_new", (F.coalesce(F.col("line") > reach, F.lit(True))).cast("int"))
    numbered = begins.withColumn("_run", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    runs = numbered.groupBy("doc_id", "row", "_run").agg(F.min("line").alias("line"), F.max("end").alias("end"))
    return runs.select("doc_id", "row", "line", (F.col("end") - F.col("line")).alias("lines"))


def without_repeats(
    docs: DataFrame, words: int = RUN_WORDS, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """`docs` without the lines of runs that repeat an earlier run of at least `words` words, with two columns
    more: `removed_lines` and `removed_runs`; columns of those names are replaced.

    The first occurrence in the order of (id, line) stays, within a document too. Runs reach to their true
    ends. Blank lines inside a window go with it. Texts without words (null, empty) stay as they are; a text of which nothing is left
    becomes empty; every row stays a row, and all other columns stay as they are.
    """
    runs = repeated_runs(repeated_windows(docs, words, key, text))
    plain = docs.drop("removed_lines", "removed_runs")
    own, row, found, cut = private(plain, "_key", "_row", "_id", "_cuts")
    cuts = runs.groupBy(F.col("doc_id").alias(found), F.col("row").alias(row)).agg(
        F.collect_list(F.struct("line", "lines")).alias(cut)
    )
    given = plain.withColumn(own, row_key(text))
    joined = given.join(
        cuts, given[key].cast("bigint").eqNullSafe(cuts[found]) & (given[own] == cuts[row]), "left"
    )
    kept = F.filter(
        F.split(F.col(text), "\n"),
        lambda x, i: ~F.exists(cut, lambda c: (i >= c["line"]) & (i < c["line"] + c["lines"])),
    )
    removed = F.aggregate(cut, F.lit(0), lambda s, c: s + c["lines"])
    return joined.select(
        *[F.when(F.col(cut).isNull(), F.col(text)).otherwise(F.array_join(kept, "\n")).alias(text) if c == text else joined[c] for c in plain.columns],
        F.coalesce(removed, F.lit(0)).alias("removed_lines"),
        F.when(F.col(cut).isNull(), 0).otherwise(F.size(cut)).alias("removed_runs"),
    )
