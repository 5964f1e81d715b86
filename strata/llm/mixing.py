"""Mixing sources to target weights by Pareto order sampling (DataFrame functions only).

Targets: all words are shared out by the sources' weights; a source whose
share is above ``max_copies`` times its size stops there and the excess goes
to the others by weight. In closed form a source gets ``min(max_copies *
size, level * weight)``; the level follows from running sums over the sources
in the order of size / weight.

Copies: a source takes ``target / size`` copies of its words. A document's
expected copies are that ratio tilted by the document's length,
``e = ratio + tilt * (x - mean x)`` with ``x = size / (size + mean size)``, in
such a way that a source's expected words are its target and ``0 <= e <=
max_copies``. The whole copies ``floor(e)`` are certain. The rest is a sample
with inclusion probabilities ``p = e - floor(e)``: documents are ranked by
``(u / (1 - u)) / (p / (1 - p))``, random odds over inclusion odds, and taken
in that order until the words still owed are reached. The sample size is
fixed in words; it misses the target by less than a document.

The order is never sorted as a whole: ranks fall into ``CELLS`` cells per
source, cell sums give the cell where the words run out, and only documents
of that cell are put in order. The random number of a document is the MD5
of its id and the seed, so runs agree.

Edge cases: null and blank texts have size 0 and take no words; sources are
ordered by code point with null last, and each is a source of its own; rows
that repeat an id share a random number, and those of one id, source and size
are taken or left together; a source of size 0 has target 0; an empty table
gives an empty result; extra columns are ignored by ``mix`` and kept by
``resample``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import plain, staged

WEIGHTS = (5, 2, 1)
CELLS = 4096
TILT = 0.5
UNIT = 1_000_000  # x is kept in whole millionths, so sums do not depend on their order


def words(text_col: str = "text"):
    return F.coalesce(F.regexp_count(F.col(text_col), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def uniform(id_col: str, seed: int):
    """A number in (0, 1) from the first 52 bits of an MD5."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") + F.lit(0.5)) / F.lit(float(1 << 52))


def targets(sizes: DataFrame, weights=WEIGHTS, max_copies: int = 3) -> DataFrame:
    """``sizes`` (source, source_size, n) -> plus weight and target, one row per source."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(x) for x in weights]), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    rows = sizes.withColumn("weight", w.cast("long"))
    # in the order of size / weight (then name) the first sources are the ones that reach their limit
    by_ratio = Window.orderBy((F.col("source_size") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    whole = Window.partitionBy()
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    rows = (rows.withColumn("_total", F.sum("source_size").over(whole))
            .withColumn("_held", F.coalesce(F.sum(F.col("source_size") * max_copies).over(before), F.lit(0)))
            .withColumn("_open", F.sum("weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing)))
            .withColumn("_level", (F.col("_total") - F.col("_held")) / F.col("_open"))
            .withColumn("_free", F.col("source_size") * max_copies > F.col("_level") * F.col("weight")))
    level = F.min(F.when(F.col("_free"), F.struct("_held", "_level"))).over(whole)["_level"]
    rows = rows.withColumn("_at", level)
    share = F.col("_at") * F.col("weight")
    limit = (F.col("source_size") * max_copies).cast("double")
    target = F.when(F.col("_at").isNull() | (share > limit), limit).otherwise(share)
    return rows.withColumn("target", target).drop("_total", "_held", "_open", "_level", "_free", "_at")


class Mix:
    """The plan of a mix: a row per source, and the documents at the ends of the samples."""

    def __init__(self, docs: DataFrame, weights=WEIGHTS, max_copies: int = 3, seed: int = 9, id_col: str = "doc_id",
                 text_col: str = "text", source_col: str = "source"):
        self.seed, self.max_copies = seed, max_copies
        self.id_col, self.text_col, self.source_col = id_col, text_col, source_col
        self.sized = staged(docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), words(text_col).alias("size"),
                                        uniform(id_col, seed).alias("u")), "mix-sizes")
        sizes = self.sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n"))
        plan = targets(sizes, weights, max_copies)
        plan = staged(plan.select(
            "source", "source_size", "target",
            F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0).alias("ratio"),
            F.greatest(F.floor(F.col("source_size") / F.col("n")), F.lit(1)).alias("mean")), "mix-targets")
        center = _with(self.sized, plan).groupBy("source").agg(F.sum(F.col("size").cast("decimal(38,0)") * _x()).alias("sx"))
        plan = staged(_with(plan, center).withColumn("center", F.when(
            F.col("source_size") > 0, F.col("sx").cast("double") / F.col("source_size")).otherwise(0.0)).drop("sx"), "mix-plan")
        self.plan, self.edge = self._cut(plan)

    def _ranked(self, rows: DataFrame, plan: DataFrame) -> DataFrame:
        """``rows`` (id, source, size, u and others) plus expected, whole, rank and cell."""
        room = F.least(F.col("ratio"), F.lit(float(self.max_copies)) - F.col("ratio"))
        e = F.col("ratio") + room * TILT * (_x() - F.col("center")) / UNIT
        rows = _with(rows, plan).withColumn("expected", F.greatest(F.lit(0.0), F.least(F.lit(float(self.max_copies)), e)))
        rows = rows.withColumn("whole", F.floor("expected")).withColumn("p", F.col("expected") - F.col("whole"))
        # q = (u / (1 - u)) / (p / (1 - p)); q / (1 + q) has the same order and lies in 0..1
        u, p = F.col("u"), F.col("p")
        rows = rows.withColumn("rank", u * (1 - p) / (u * (1 - p) + p * (1 - u)))
        return rows.withColumn("cell", F.least(F.floor(F.col("rank") * CELLS), F.lit(CELLS - 1)))

    def _cut(self, plan: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Where each source's words run out: the cell, and which of its documents are still taken."""
        ranked = staged(self._ranked(self.sized, plan).select("id", "source", "size", "whole", "p", "rank", "cell"), "mix-ranked")
        cells = ranked.groupBy("source", "cell").agg(F.sum("size").alias("words"), F.sum(F.col("size") * F.col("whole")).alias("certain"))
        of_source = Window.partitionBy("source")
        upto = of_source.orderBy("cell").rowsBetween(Window.unboundedPreceding, 0)
        cells = (_with(cells, plan.select("source", "target")).withColumn("owed", F.col("target") - F.sum("certain").over(of_source))
                 .withColumn("upto", F.sum("words").over(upto)))
        end = cells.where(F.col("upto") >= F.col("owed")).groupBy("source").agg(
            F.min(F.struct("cell", (F.col("owed") - F.col("upto") + F.col("words")).alias("rest"))).alias("m"))
        plan = staged(_with(plan, end.select("source", F.col("m.cell").alias("cut_cell"), F.col("m.rest").alias("rest")), "left"), "mix-cut")
        last = _with(ranked, plan.select("source", "cut_cell", "rest")).where((F.col("cell") == F.col("cut_cell")) & (F.col("p") > 0))
        units = last.groupBy("source", "id", "size", "rank", "rest").agg(F.count(F.lit(1)).alias("n"))
        unit_words = F.col("size") * F.col("n")
        before = Window.partitionBy("source").orderBy("rank", "size", "id").rowsBetween(Window.unboundedPreceding, -1)
        units = units.withColumn("before", F.coalesce(F.sum(unit_words).over(before), F.lit(0)))
        # the document where the words run out is taken if that comes nearer to the target
        edge = units.where(F.col("before") + unit_words / 2 <= F.col("rest"))
        return plan, staged(edge.select("source", "id", "size"), "mix-edge")

    def decide(self, rows: DataFrame) -> DataFrame:
        """``rows`` (id, source, size, u and others) plus source_size, target, expected and copies; nothing else is shuffled
        as long as the plan and the documents at the ends are small."""
        rows = self._ranked(rows, self.plan)
        edge = self.edge.select(F.col("source").alias("_s"), F.col("id").alias("_i"), F.col("size").alias("_z"), F.lit(True).alias("_taken"))
        rows = rows.join(edge, rows["source"].eqNullSafe(edge["_s"]) & rows["id"].eqNullSafe(edge["_i"]) & (rows["size"] == edge["_z"]), "left")
        inside = F.col("cut_cell").isNull() | (F.col("cell") < F.col("cut_cell")) | F.col("_taken").isNotNull()
        return rows.withColumn("copies", F.col("whole") + (inside & (F.col("p") > 0)).cast("long"))


def _x():
    """A document's length against its source's mean, in whole millionths."""
    return F.floor(F.col("size") * UNIT / (F.col("size") + F.col("mean")))


def _with(rows: DataFrame, per_source: DataFrame, how: str = "inner") -> DataFrame:
    """Join a table of one row per source; where that is read from files, its size decides how."""
    right = per_source.withColumnRenamed("source", "_source")
    return rows.join(right, rows["source"].eqNullSafe(right["_source"]), how).drop("_source")


def mix(docs: DataFrame, weights=WEIGHTS, max_copies: int = 3, seed: int = 9, **columns) -> DataFrame:
    """(id, source, size, source_size, target, expected, copies, taken) for every row of ``docs``."""
    m = Mix(docs, weights, max_copies, seed, **columns)
    return m.decide(m.sized).select("id", "source", "size", "source_size", "target", "expected", "copies",
                                    (F.col("size") * F.col("copies")).alias("taken"))


def resample(docs: DataFrame, weights=WEIGHTS, max_copies: int = 3, seed: int = 9) -> DataFrame:
    """``docs`` with every row repeated as often as the mix takes it (0 to ``max_copies`` times); same columns."""
    known = plain(docs, "doc_id", "text", "source")
    m = Mix(known, weights, max_copies, seed)
    rows = known.select(F.col("doc_id").alias("id"), "source", words().alias("size"), uniform("doc_id", seed).alias("u"),
                       F.struct(*known.columns).alias("_row"))
    rows = m.decide(rows).where("copies > 0").select("_row", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int"))).alias("_copy"))
    return rows.select("_row.*").toDF(*docs.columns)
