"""Mixing sources to target weights by repeating documents.

Sizes are added up per source, targets follow from the weights, and a source's rate is its target over its
size. Each document is emitted floor(rate) times, and once more where a number that its key and the seed
decide falls below the rate's fraction. Only sums per source are shuffled; documents are scanned twice and stay
where they are, so a source that holds a third of all rows is no hot key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.names import private
from tidemark.session import materialize

#: Hex digits of a hash that a draw is made of: 52 bits, which a double holds exactly.
DIGITS = 13
#: A source's target is at most so many times its size.
MOST_REPEATS = 3


def word_count(text: Column) -> Column:
    """Runs of characters other than space, tab and the line breaks of ASCII; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def cycled_weights(sizes: DataFrame, weights: tuple[int, ...], source: str = "source", weight: str = "weight") -> DataFrame:
    """`sizes` (a row per source) with the weights dealt in turn, in the order of code points, the null source last.

    A single window over the list of sources, not over their rows.
    """
    place = (F.row_number().over(Window.orderBy(F.asc_nulls_last(source))) - 1) % len(weights)
    return sizes.withColumn(weight, F.get(F.array(*[F.lit(w).cast("bigint") for w in weights]), place.cast("int")))


def source_targets(sizes: DataFrame, most: int = MOST_REPEATS, total: int | None = None) -> DataFrame:
    """`sizes` (source, source_size, weight; a row per source) with `target`: shares of `total` (all sizes, where
    none is given) by weight.

    A target stops at `most` times its source's size, and the excess is shared anew by weight among the others,
    until none is above; what no source can take is not given out. Each round is one sum over the sources, of which two
    numbers reach the driver; there are at most as many rounds as sources, a few as a rule. A missing or
    negative weight is 0, and so is then the target. `sizes` is read once a round: pass a stored table.
    """
    given = sizes.withColumn("weight", F.greatest(F.coalesce("weight", F.lit(0)), F.lit(0)).cast("bigint"))
    limit, exact = F.col("source_size") * most, "decimal(19,0)"
    all_sizes, all_weights = given.agg(F.sum("source_size"), F.sum("weight")).first()
    total = (all_sizes or 0) if total is None else total
    rest, shares, stops = total, all_weights or 0, F.lit(False)
    while shares:
        # in whole numbers: limit / weight <= rest / shares
        reached = limit.cast(exact) * F.lit(shares).cast(exact) <= F.col("weight").cast(exact) * F.lit(rest).cast(exact)
        stops = (F.col("weight") > 0) & reached
        full, held = given.filter(stops).agg(F.sum(limit), F.sum("weight")).first()
        left = total - (full or 0), all_weights - (held or 0)
        if left[1] >= shares:  # no more of them stop than did
            break
        rest, shares = left
    level = F.col("weight").cast("double") * float(rest) / float(shares) if shares else F.lit(0.0)
    return given.withColumn("target", F.when(stops, limit.cast("double")).otherwise(level))


def _drawn(seed: int, key: Column) -> Column:
    """A number in [0, 1) that the seed and the key decide."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    return F.conv(F.substring(F.sha2(text, 256), 1, DIGITS), 16, 10).cast("bigint") / F.lit(float(1 << 4 * DIGITS))


def with_copies(docs: DataFrame, targets: DataFrame, seed: int = 13, key: str = "doc_id", source: str = "source") -> DataFrame:
    """`docs` with `source_size` and `target` of the source, and `copies`: how often the mix takes the document.

    floor(target / source_size) times, and once more by a draw that comes out below the fraction. Rows that repeat a key
    draw alike, rows without one like the empty string; reruns agree. Documents without a source are one source, and
    those of a source that `targets` does not name are not taken. Columns of those names are replaced. `targets`
    has a row per source; it is joined without a hint, so Spark goes by its size and splits hot sources.
    """
    added = ["source_size", "target", "copies"]
    given = docs.select(*[c for c in docs.columns if c.lower() not in added])
    (own,) = private(given, "source_of")
    known = targets.select(F.col(source).alias(own), "source_size", "target")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    more = (_drawn(seed, F.col(key)) < rate - F.floor(rate)).cast("int")
    copies = F.coalesce(F.floor(rate).cast("int") + more, F.lit(0))
    return given.join(known, given[source].eqNullSafe(F.col(own)), "left").withColumn("copies", copies).drop(own)


def emitted(docs: DataFrame, copies: str = "copies", copy: str = "copy") -> DataFrame:
    """The mix itself: each row of `docs` as often as `copies` says, numbered from 0 in `copy` (replaced if there)."""
    rest = [c for c in docs.columns if c.lower() not in (copies.lower(), copy.lower())]
    numbers = F.sequence(F.lit(1), F.col(copies))
    return docs.filter(F.col(copies) > 0).select(*rest, F.explode(numbers).alias(copy)).withColumn(copy, F.col(copy) - 1)


def mix_plan(
    docs: DataFrame,
    weights: tuple[int, ...],
    most: int = MOST_REPEATS,
    seed: int = 13,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    size: str = "size",
) -> DataFrame:
    """`docs` with `size` (words of the text), `source_size`, `target` and `copies`; give it to `emitted` for the mix.

    All sizes together are shared by `weights`, which the sources take in turn (`cycled_weights`). Null and empty texts
    have size 0 and are taken as often as any other of their source; a source of size 0 has target 0 and is not
    taken. Columns of those names are replaced. An empty table stays empty.
    """
    sized = docs.withColumn(size, word_count(F.col(text)))
    totals = sized.groupBy(F.col(source).alias("source")).agg(F.sum(size).alias("source_size"))
    sources = materialize(cycled_weights(totals, weights))
    targets = materialize(source_targets(sources, most).withColumnRenamed("source", source))
    return with_copies(sized, targets, seed, key, source)
