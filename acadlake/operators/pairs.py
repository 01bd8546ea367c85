"""Rows that are pairs of two sides, kept as the sides.

A product of two sides (subjects times committee members) has as many rows as the square of its input's growth.  Checks
that read one column at a time, or ask which keys repeat, are answered from the sides; the rows are made, by a streaming
join, only where they are the result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SPREAD = 32
BLOCK_ROWS = 1000           # right rows in a block, at most


def _semi(df: DataFrame, values: DataFrame, column: str, how: str = "left_semi") -> DataFrame:
    """Rows of ``df`` whose ``column`` is (``left_anti``: is not) among the one column of ``values``; NULL is a value."""
    values = values.toDF("__value")
    return df.join(values, df[column].eqNullSafe(values["__value"]), how)


@dataclass(frozen=True)
class Pairs:
    """Rows (a, b): one for each row (a, __left) of ``left`` and row (b, __right) of ``right`` whose sets of links (arrays
    without NULL, sorted, each link once) share a link, and the rows of ``more``.  Both a and b may repeat; b is never NULL.
    """

    left: DataFrame
    right: DataFrame
    more: DataFrame

    @property
    def a(self) -> str:
        return self.left.columns[0]

    @property
    def b(self) -> str:
        return self.right.columns[0]

    @property
    def columns(self) -> list[str]:
        return [self.a, self.b]

    def _given(self, left: DataFrame | None = None, right: DataFrame | None = None) -> DataFrame:
        """The rows of two sides, without those of ``more``.

        They are as many as the sides' products, so they are neither shuffled nor held, nor compared one by one: the right
        rows of a set of links are put into blocks, a left row is joined with blocks, and each block it meets becomes rows.
        Rows with several common links come from the smallest of them."""
        left, right = self.left if left is None else left, self.right if right is None else right
        # a link's left rows are dealt over SPREAD keys, each of which meets all of its blocks; the number of
        # partitions is given, since their size says nothing about the rows that come out
        n = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        left = left.select(self.a, "__left", F.explode("__left").alias("__link"),
                           F.pmod(F.xxhash64(self.a), F.lit(SPREAD)).cast("int").alias("__sal"))
        place = F.row_number().over(Window.partitionBy("__right").orderBy(self.b))
        blocks = right.withColumn("__block", F.floor((place - 1) / BLOCK_ROWS)).groupBy("__right", "__block").agg(
            F.collect_list(self.b).alias("__ends"))
        blocks = blocks.select("__right", "__ends", F.explode("__right").alias("__link"))
        blocks = blocks.withColumn("__sal", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))))
        both = left.repartition(n, "__link", "__sal").join(blocks.repartition(n, "__link", "__sal"), ["__link", "__sal"])
        return both.where(_smallest_link()).select(self.a, F.explode("__ends").alias(self.b))

    def given(self) -> DataFrame:
        """The rows that the two sides give, without those of ``more``."""
        return self._given()

    def volume(self, size: Column) -> tuple[int, int]:
        """The number of rows, and the sum of ``size`` (a number of b) over the right rows of each distinct set of the left."""
        sets = self.left.groupBy("__left").agg(F.count(F.lit(1)).alias("__rows")).withColumn("__link", F.explode("__left"))
        ends = (self.right.groupBy("__right").agg(F.count(F.lit(1)).alias("__ends"), F.sum(size).alias("__size"))
                .withColumn("__link", F.explode("__right")))
        given = sets.join(ends, "__link").where(_smallest_link()).select((F.col("__rows") * F.col("__ends")).alias("n"), "__size")
        more = self.more.agg(F.count(F.lit(1)).alias("n"), F.lit(0).cast("bigint").alias("__size"))
        n, held = given.unionByName(more).agg(F.sum("n"), F.sum("__size")).first()
        return int(n), int(held)

    def rows(self) -> DataFrame:
        return self._given().unionByName(self.more.select(*self.columns))

    def select(self, *columns: str) -> DataFrame | Pairs:
        """Both columns in their order are the pairs themselves."""
        return self if list(columns) == self.columns else self.rows().select(*columns)

    def where(self, condition: Column) -> Pairs:
        """Rows that meet a condition on a."""
        return Pairs(self.left.where(condition), self.right, self.more.where(condition))

    def of(self, values: DataFrame, how: str = "left_semi") -> Pairs:
        """Rows whose a is (``left_anti``: is not) among ``values``."""
        return Pairs(_semi(self.left, values, self.a, how), self.right, _semi(self.more, values, self.a, how))

    def rows_where(self, conditions: list[tuple[str, Column]]) -> DataFrame:
        """All rows that meet one of the conditions, each on the one column named (rows of ``more`` come whatever they
        meet)."""
        left, right = self._any(self.a, conditions), self._any(self.b, conditions)
        rest = self._given(self.left.where(~left), self.right.where(right))
        return self._given(self.left.where(left)).unionByName(rest).unionByName(self.more.select(*self.columns))

    @staticmethod
    def _any(column: str, conditions: list[tuple[str, Column]]) -> Column:
        out = F.lit(False)
        for name, condition in conditions:
            if name == column:
                out = out | F.coalesce(condition, F.lit(False))
        return out

    def tally(self, conditions: list[tuple[str, Column]]) -> DataFrame:
        """One row: the number of rows ``n``, and in r0, r1, ... how many meet each condition on the column named.

        Rows with equal sets of links have equally many partners, so each side is counted by set, and the counts of two sets
        that share a link are multiplied."""
        def counts(df: DataFrame, side: str, column: str) -> DataFrame:
            met = [F.count_if(c if name == column else F.lit(True)).alias(f"{side}{i}") for i, (name, c) in enumerate(conditions)]
            return df.groupBy(side).agg(F.count(F.lit(1)).alias(f"{side}n"), *met).withColumn("__link", F.explode(side))

        both = counts(self.left, "__left", self.a).join(counts(self.right, "__right", self.b), "__link").where(_smallest_link())
        names = ["n", *[f"r{i}" for i in range(len(conditions))]]
        given = both.select(*[(F.col("__left" + n.strip("r")) * F.col("__right" + n.strip("r"))).alias(n) for n in names])
        more = self.more.agg(F.count(F.lit(1)).alias("n"), *[F.count_if(c).alias(f"r{i}") for i, (_, c) in enumerate(conditions)])
        return given.unionByName(more).agg(*[F.sum(n).cast("bigint").alias(n) for n in names])

    def held(self, rows: DataFrame) -> DataFrame:
        """The rows (a, b) of ``rows`` that the two sides give."""
        left, right = self.left.toDF("__a", "__left"), self.right.toDF("__b", "__right")
        rows = rows.join(left, rows[self.a].eqNullSafe(left["__a"])).join(right, rows[self.b] == right["__b"])
        return rows.where(F.arrays_overlap("__left", "__right")).select(*self.columns)

    def split(self) -> tuple[Pairs, DataFrame]:
        """All rows in two parts without a common key: pairs whose keys occur once, and rows whose keys may repeat.

        A key repeats only where its a or its b repeats in its side, or ``more`` holds it too."""
        a, b = self.a, self.b
        twice_a = self.left.groupBy(a).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1").select(a)
        twice_a = twice_a.unionByName(self.held(self.more).select(a)).distinct()
        twice_b = self.right.groupBy(b).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1").select(b)
        left, right = _semi(self.left, twice_a, a, "left_anti"), _semi(self.right, twice_b, b, "left_anti")
        again = self._given(_semi(self.left, twice_a, a)).unionByName(self._given(left, _semi(self.right, twice_b, b)))
        return Pairs(left, right, self.more.limit(0)), again.unionByName(self.more.select(a, b))

    def absent(self, load: Pairs) -> DataFrame:
        """The distinct rows that ``load`` does not have (a NULL is in no load); both have the same right side.

        An a that the load lacks goes with all its rows.  A left row that the load has too stays with all of them.  Only
        the others, and rows of ``more``, are looked up one by one."""
        a, b = self.a, self.b
        loaded = load.left.select(a).unionByName(load.more.select(a)).where(F.col(a).isNotNull()).distinct()
        once, again = self.of(loaded, "left_anti").split()
        kept = self.of(loaded)
        same = load.left.select(F.col(a).alias("__a"), F.col("__left").alias("__same"))
        changed = kept.left.join(same, (F.col(a) == F.col("__a")) & (F.col("__left") == F.col("__same")), "left_anti")
        rest = self._given(changed).unionByName(kept.more.select(a, b)).distinct()
        found = load.held(rest).unionByName(load.more.select(a, b)).toDF("__a", "__b")
        rest = rest.join(found, (F.col(a) == F.col("__a")) & (F.col(b) == F.col("__b")), "left_anti")
        return once.rows().unionByName(again.distinct()).unionByName(rest)


def _smallest_link() -> Column:
    """Of the joined rows of two sets, the one of their smallest common link."""
    return (F.size("__right") == 1) | (F.col("__link") == F.array_min(F.array_intersect("__left", "__right")))
