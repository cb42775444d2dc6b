"""Row frames over a daily panel.

A panel holds one row per (key, date), so a window partitioned by the key never holds
more rows than the calendar has sessions, whatever share of the raw data the key has.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tidemark.functions.columns import col, ratio


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Hash `df` by `keys` into the session's full number of shuffle partitions.

    A chain of windows over the same keys then runs on this one exchange. A panel is small
    in bytes but a rolling window costs its length per row, so letting the planner pack
    partitions by size would leave most cores idle.
    """
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(partitions, *keys)


@dataclass(frozen=True)
class Trailing:
    """The last `rows` rows of each key, null until `floor` of them carry a value.

    `skip` moves the frame back, so the last `skip` rows are left out; a negative `skip`
    of `-rows` looks at the next `rows` rows instead.
    """

    rows: int
    floor: int | None = None
    key: str | tuple[str, ...] = "symbol"
    order: str = "date"
    skip: int = 0

    @property
    def keys(self) -> list[str]:
        return [self.key] if isinstance(self.key, str) else list(self.key)

    def window(self) -> WindowSpec:
        return (
            Window.partitionBy(*self.keys)
            .orderBy(self.order)
            .rowsBetween(-(self.rows - 1) - self.skip, -self.skip)
        )

    def _guard(self, counted: Column, value: Column) -> Column:
        floor = self.rows if self.floor is None else self.floor
        return F.when(F.count(counted).over(self.window()) >= F.lit(floor), value)

    def count(self, x: str | Column) -> Column:
        return F.count(col(x)).over(self.window())

    def mean(self, x: str | Column) -> Column:
        return self._guard(col(x), F.avg(col(x)).over(self.window()))

    def sum(self, x: str | Column) -> Column:
        return self._guard(col(x), F.sum(col(x)).over(self.window()))

    def std(self, x: str | Column) -> Column:
        return self._guard(col(x), F.stddev_samp(col(x)).over(self.window()))

    def var(self, x: str | Column) -> Column:
        return self._guard(col(x), F.var_samp(col(x)).over(self.window()))

    def cov(self, x: str | Column, y: str | Column) -> Column:
        both = col(x) * col(y)
        return self._guard(both, F.covar_samp(col(x), col(y)).over(self.window()))

    def beta(self, y: str | Column, x: str | Column) -> Column:
        """Slope of `y` on `x` over the frame."""
        return ratio(self.cov(y, x), self.var(x))


#: Frames of up to so many rows are added up row by row: two sorts more would cost as much.
SHORT = 64


@dataclass(frozen=True)
class Stat:
    """A statistic of `x`, or of `x` and `y`, over a trailing frame: one of the methods of `Trailing`."""

    kind: str
    x: str
    y: str | None = None

    def plain(self, trail: Trailing) -> Column:
        return getattr(trail, self.kind)(*(c for c in (self.x, self.y) if c is not None))


@dataclass(frozen=True)
class _Moment:
    """Count, means and sum of products of deviations of the rows where both `x` and `y` are there."""

    x: str
    y: str

    def pieces(self, over: WindowSpec) -> dict[str, Column]:
        x, y = col(self.x), col(self.y)
        if self.x == self.y:
            n = F.count(x).over(over)
            mean = F.avg(x).over(over)
            return {"n": n, "x": mean, "y": mean, "c": F.var_pop(x).over(over) * n}
        both = x.isNotNull() & y.isNotNull()
        n = F.count(F.when(both, x)).over(over)
        return {
            "n": n,
            "x": F.avg(F.when(both, x)).over(over),
            "y": F.avg(F.when(both, y)).over(over),
            "c": F.covar_pop(x, y).over(over) * n,
        }

    @staticmethod
    def merged(a: dict[str, Column], b: dict[str, Column]) -> tuple[Column, Column, Column]:
        """Count, mean of x and sum of products of two sets of rows together; both parts stay centred on their own means."""
        none = F.lit(0).cast("bigint")
        n_a, n_b = F.coalesce(a["n"], none), F.coalesce(b["n"], none)
        n, zero = n_a + n_b, F.lit(0.0)
        apart = (b["x"] - a["x"]) * (b["y"] - a["y"]) * (n_a * n_b) / n
        products = F.when(n_a == 0, b["c"]).when(n_b == 0, a["c"]).otherwise(a["c"] + b["c"] + apart)
        mean = F.when(n_a == 0, b["x"]).when(n_b == 0, a["x"]).otherwise(a["x"] + (b["x"] - a["x"]) * n_b / n)
        return n, mean, F.coalesce(products, zero)


def rolled(df: DataFrame, trail: Trailing, **stats: Stat) -> DataFrame:
    """`df` with a column for each statistic over the trailing frame, at a cost per row that does not grow with its length.

    Each key's rows are cut into blocks as long as the frame. A frame then is the end of one block and the
    beginning of the next, so a running aggregate forwards and one backwards through each block, merged, are its
    moments. Nothing outside the frame enters them: no digits are lost to a long history, and a huge or
    unfinite value counts as long as it is in the frame. `skip` is as in `Trailing`; frames ahead of the row
    must be full ones. Short frames are added up row by row. Names that begin with `_roll` are taken.
    """
    if trail.rows <= SHORT:
        return df.select("*", *[s.plain(trail).alias(name) for name, s in stats.items()])
    floor = trail.rows if trail.floor is None else trail.floor
    if trail.skip < 0 and (trail.skip != -trail.rows or floor != trail.rows):
        raise ValueError("frames ahead of a row must be full ones")
    moments = {}
    for s in stats.values():
        pairs = [(s.x, s.y), (s.y, s.y)] if s.kind == "beta" else [(s.x, s.y or s.x)]
        for x, y in pairs:
            moments.setdefault((x, y), _Moment(x, y))
    numbers = {pair: i for i, pair in enumerate(moments)}
    block = Window.partitionBy(*trail.keys, "_roll_block")
    ahead = block.orderBy("_roll_at").rowsBetween(Window.unboundedPreceding, 0)
    back = block.orderBy(F.desc("_roll_at")).rowsBetween(Window.unboundedPreceding, 0)
    along = Window.partitionBy(*trail.keys).orderBy("_roll_block", "_roll_at")
    at = F.row_number().over(Window.partitionBy(*trail.keys).orderBy(trail.order)) - 1
    numbered = df.select("*", at.alias("_roll_at")).withColumn("_roll_block", F.floor(F.col("_roll_at") / trail.rows))
    name = lambda side, pair, part: f"_roll_{side}{numbers[pair]}{part}"
    pieces = lambda side, over: [c.alias(name(side, p, k)) for p, m in moments.items() for k, c in m.pieces(over).items()]
    tails = numbered.select("*", *pieces("t", back))
    both = tails.select("*", *pieces("h", ahead))
    # the block before gives what the frame has of it, unless the frame is the whole block
    inside = F.col("_roll_at") % trail.rows < trail.rows - 1
    before = both.withColumns(
        {name("t", p, k): F.when(inside, F.lag(name("t", p, k), trail.rows - 1).over(along)) for p in moments for k in "nxyc"}
    )
    whole = {p: m.merged(*({k: F.col(name(side, p, k)) for k in "nxyc"} for side in "th")) for p, m in moments.items()}

    def value(s: Stat) -> Column:
        n, mean, products = whole[s.x, s.y or s.x]
        spread_of = lambda p: F.when(whole[p][0] >= floor, ratio(whole[p][2], whole[p][0] - 1))
        if s.kind == "count":
            return n
        if s.kind in ("mean", "sum"):
            return F.when(n >= floor, mean if s.kind == "mean" else mean * n)
        if s.kind == "beta":
            return ratio(spread_of((s.x, s.y)), spread_of((s.y, s.y)))
        moved = spread_of((s.x, s.y or s.x))
        return F.sqrt(moved) if s.kind == "std" else moved

    made = before.select(*[col(c) for c in df.columns], "_roll_at", "_roll_block", *[value(s).alias(n) for n, s in stats.items()])
    if trail.skip:
        made = made.withColumns({n: F.lag(n, trail.skip).over(along) for n in stats})
    return made.drop("_roll_at", "_roll_block")


def leading(rows: int, key: str | tuple[str, ...] = "symbol", order: str = "date") -> Trailing:
    """The next `rows` rows, the current one excluded; null until all of them exist."""
    return Trailing(rows, key=key, order=order, skip=-rows)


def previous(x: str | Column, key: str = "symbol", order: str = "date") -> Column:
    return F.lag(col(x)).over(Window.partitionBy(key).orderBy(order))


def log_change(x: str | Column, key: str = "symbol", order: str = "date") -> Column:
    """ln(x) minus its previous value within the key."""
    return F.ln(col(x)) - F.lag(F.ln(col(x))).over(Window.partitionBy(key).orderBy(order))
