"""Mixing sources to target weights by Pareto order sampling, in DataFrame operations only.

Each source gets a target number of words (water-filling of weights under a cap on repeats). A source's documents first
get their certain whole copies. The words still missing are drawn with unequal probabilities: a document's inclusion
probability is in proportion to its size, lambda = c * size, with c such that the expected words are those missing;
documents for which that would reach 1 are certain and split off first. The others are ranked by their random odds
u / (1 - u) over their inclusion odds lambda / (1 - lambda), and the least are selected. The size that is fixed is counted
in words, the unit of the targets: the ranking is followed until the drawn words come nearest to those missing, so a
source misses its target by half a document at most.

No source goes through one task. Rows that agree in (doc_id, source, size) are one unit with a count; c comes from sums by
distinct size (their number grows with the root of the words); and the end of a ranking is found from word counts by cell
of log odds, then by finer cells within the one where it ends, so that only documents of one fine cell are put in order.

Nulls: a null text has size zero, a null source is a source of its own, the last; a null doc_id is ranked by its empty
name. Documents of size zero take nothing. Ties of rank go to the null, then the smaller doc_id, then the smaller size; of
rows equal in all three any may be taken, which gives the same result. An empty table gives no rows. Texts may be of any
length; extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratavox.llm import common

#: Weights dealt to the sources in order, over and over; largest number of copies.
WEIGHTS, MOST = (5, 2, 1), 3
#: Cells for each doubling of the odds, finer cells in each of these, and rows made from one unit at once.
CELLS, FINER, CHUNK = 64, 4096, 1 << 16
SEED = "mix-1"
WORD = r"[^\x20\x09-\x0D]+"


def words(text):
    return F.regexp_count(F.coalesce(text.cast("string"), F.lit("")), F.lit(WORD)).cast("long")


def source_targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """(source, source_size, target) from (source, size): shares by weight of all sizes, none above ``most`` times its source.

    Sources whose cap over weight is least are capped first; the level at which the rest share is found from prefix sums.
    One row a source goes through one task here.
    """
    by = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.row_number().over(order) - 1) % len(weights) + 1).cast("long")
    by = by.withColumn("weight", weight).withColumn("cap", F.col("source_size") * most)
    everything = Window.partitionBy(F.lit(0))
    level = Window.partitionBy(F.lit(0)).orderBy("ratio", F.col("source").asc_nulls_last())
    before = level.rowsBetween(Window.unboundedPreceding, -1)
    onward = level.rowsBetween(0, Window.unboundedFollowing)
    by = by.withColumn("ratio", F.col("cap") / F.col("weight")).withColumns(
        {
            "share": (F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0))) / F.sum("weight").over(onward),
            "nth": F.row_number().over(level),
        }
    )
    by = by.withColumn("open", F.min(F.when(F.col("share") <= F.col("ratio"), F.col("nth"))).over(everything))
    by = by.withColumn("level", F.max(F.when(F.col("nth") == F.col("open"), F.col("share"))).over(everything))
    target = F.when(F.col("nth") < F.col("open"), F.col("cap").cast("double")).otherwise(F.col("level") * F.col("weight"))
    return by.select("source", "source_size", target.alias("target"))


def random_unit(doc_id, seed: str = SEED):
    """A number in (0, 1) that depends on the id and the seed only."""
    digest = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def inclusion(sizes: DataFrame, sources: DataFrame) -> DataFrame:
    """(source, c, over, draw) from (source, size, n): lambda is c * size for sizes up to ``over``, those above are certain.

    ``draw`` is what is missing besides whole copies and certain documents. Sources that miss nothing have no row.
    """
    rows = sizes.where("size > 0").join(sources, F.col("source").eqNullSafe(F.col("__source"))).where("missing > 0")
    largest = Window.partitionBy("source").orderBy(F.col("size").desc())
    above = F.coalesce(F.sum(F.col("size") * F.col("n")).over(largest.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    squares = F.sum((F.col("size") * F.col("size")).cast("decimal(38,0)") * F.col("n")).over(largest.rowsBetween(0, Window.unboundedFollowing))
    rows = rows.withColumn("draw", F.col("missing") - above).withColumn("squares", squares.cast("double"))
    rows = rows.where(F.col("draw") * F.col("size") < F.col("squares"))
    return rows.groupBy("source").agg(F.max_by(F.struct((F.col("draw") / F.col("squares")).alias("c"), F.col("size").alias("over"), "draw"), "size").alias("s")).select(F.col("source").alias("__source"), "s.c", "s.over", "s.draw")


def _end(rows: DataFrame, cell: str, base) -> DataFrame:
    """(source, cell, words before it) of the cell in which each source's ranking ends, from (source, words, draw)."""
    below = Window.partitionBy("source").orderBy(cell).rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy("source", cell).agg(F.sum("words").alias("words"), F.first("draw").alias("draw"), base.alias("base"))
    sums = sums.withColumn("before", F.col("base") + F.coalesce(F.sum("words").over(below), F.lit(0)))
    ends = sums.where((F.col("before") < F.col("draw")) & (F.col("before") + F.col("words") >= F.col("draw")))
    return ends.select(F.col("source").alias("__source"), F.col(cell).alias(f"end_{cell}"), F.col("before").alias(f"before_{cell}"))


def mix(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, seed: str = SEED, cells: int = CELLS, finer: int = FINER) -> DataFrame:
    """Adds source_size, target and taken to (doc_id, source, size)."""
    units = common.checkpointed(sized.groupBy("doc_id", "source", "size").agg(F.count("*").alias("n")))
    by = lambda left, right: left.join(right, F.col("source").eqNullSafe(F.col("__source")), "left").drop("__source")
    sources = source_targets(units.select("source", (F.col("size") * F.col("n")).alias("size")), weights, most).withColumnRenamed("source", "__source")
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    sources = sources.withColumn("whole", whole).withColumn("missing", F.col("target") - F.col("whole") * F.col("source_size"))
    sources = common.checkpointed(sources)
    odds = common.checkpointed(inclusion(units.groupBy("source", "size").agg(F.sum("n").alias("n")), sources))
    rows = by(by(units, sources), odds).withColumn("words", F.col("size") * F.col("n"))
    drawn = (F.col("size") > 0) & (F.col("size") <= F.col("over"))
    share, u = F.col("c") * F.col("size"), random_unit(F.col("doc_id"), seed)
    rows = rows.withColumn("q", F.when(drawn, (u / (1 - u)) * ((1 - share) / share)))
    place = F.log2("q") * cells
    rows = rows.withColumn("cell", F.floor(place)).withColumn("fine", F.floor((place - F.floor(place)) * finer))
    ends = common.checkpointed(_end(rows.where("q IS NOT NULL"), "cell", F.lit(0)))
    rows = by(rows, ends)
    last = F.col("q").isNotNull() & (F.col("cell") == F.col("end_cell"))
    ends = common.checkpointed(_end(rows.where(last), "fine", F.first("before_cell")))
    rows = by(rows, ends)
    edge = F.coalesce(last & (F.col("fine") == F.col("end_fine")), F.lit(False))
    before = Window.partitionBy("source").orderBy("q", F.col("doc_id").asc_nulls_first(), "size").rowsBetween(Window.unboundedPreceding, -1)
    put = rows.where(edge).withColumn("below", F.col("before_fine") + F.coalesce(F.sum("words").over(before), F.lit(0)))
    certain = F.col("size") > F.col("over")
    first = F.col("q").isNotNull() & (F.col("end_cell").isNull() | (F.col("cell") < F.col("end_cell")) | ((F.col("cell") == F.col("end_cell")) & (F.col("fine") < F.col("end_fine"))))
    # a unit away from the end is taken once more with all its rows, or with none
    rest = rows.where(~edge).withColumn("below", F.lit(None).cast("long")).withColumn("all", F.coalesce(certain | first, F.lit(False)))
    rows = rest.unionByName(put.withColumn("all", F.lit(False)))
    rows = rows.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / CHUNK))))
    many = rows.where(F.col("n") > CHUNK).repartition(common.partitions(sized.sparkSession), "chunk")
    rows = rows.where(F.col("n") <= CHUNK).unionByName(many)
    start = F.col("chunk") * CHUNK
    rows = rows.withColumn("nth", F.explode(F.sequence(start, F.least(start + CHUNK, F.col("n")) - 1)))
    more = F.col("all") | F.coalesce(F.col("below") + F.col("nth") * F.col("size") + F.col("size") / 2 <= F.col("draw"), F.lit(False))
    taken = F.col("size") * (F.col("whole") + F.when(more, 1).otherwise(0))
    return rows.select("doc_id", "source", "size", "source_size", "target", taken.cast("long").alias("taken"))


def sized_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(doc_id, source, size): texts are read for their words and not carried on."""
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(source_col).cast("string").alias("source"), words(F.col(text_col)).alias("size"))


def op7_mixing(spark, sf_dir: str) -> DataFrame:
    """What the mix takes of each of all ``documents``."""
    return mix(sized_documents(common.table(spark, sf_dir, "documents"))).drop("source")


OP7_SQL = rf"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::BIGINT AS size FROM documents
), by_source AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
), weighed AS (
  SELECT source, source_size, source_size * 3 AS cap,
         [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::BIGINT AS weight
  FROM by_source
), ratios AS (
  SELECT *, cap::DOUBLE / weight::DOUBLE AS ratio FROM weighed
), shares AS (
  SELECT *, row_number() OVER lv AS nth,
         ((sum(source_size) OVER ())::BIGINT - coalesce(sum(cap) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT)::DOUBLE
         / (sum(weight) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS share
  FROM ratios WINDOW lv AS (ORDER BY ratio, source NULLS LAST)
), opened AS (
  SELECT *, min(CASE WHEN share <= ratio THEN nth END) OVER () AS open FROM shares
), levelled AS (
  SELECT *, max(CASE WHEN nth = open THEN share END) OVER () AS level FROM opened
), targets AS (
  SELECT source, source_size, CASE WHEN nth < open THEN cap::DOUBLE ELSE level * weight::DOUBLE END AS target FROM levelled
), wanted AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size::DOUBLE) ELSE 0 END::BIGINT AS whole,
         target - ((CASE WHEN source_size > 0 THEN floor(target / source_size::DOUBLE) ELSE 0 END)::BIGINT * source_size)::DOUBLE AS missing
  FROM targets
), sizes AS (
  SELECT s.source, s.size, count(*) AS n, any_value(w.missing) AS missing
  FROM sized s JOIN wanted w ON s.source IS NOT DISTINCT FROM w.source WHERE s.size > 0 AND w.missing > 0 GROUP BY s.source, s.size
), summed AS (
  SELECT source, size,
         missing - coalesce(sum(size * n) OVER (PARTITION BY source ORDER BY size DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE AS draw,
         (sum(size * size * n) OVER (PARTITION BY source ORDER BY size DESC ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS squares
  FROM sizes
), odds AS (
  SELECT source, max(size) AS over, arg_max(draw / squares, size) AS c, arg_max(draw, size) AS draw FROM summed WHERE draw * size::DOUBLE < squares GROUP BY source
), included AS (
  SELECT d.doc_id, d.source, d.size, t.source_size, t.target, t.whole, o.draw, o.over, o.c * d.size::DOUBLE AS share,
         (('0x' || substr(md5('{SEED}:' || coalesce(d.doc_id::VARCHAR, '')), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0::DOUBLE AS u
  FROM sized d JOIN wanted t ON d.source IS NOT DISTINCT FROM t.source LEFT JOIN odds o ON d.source IS NOT DISTINCT FROM o.source
), ranked AS (
  SELECT *, CASE WHEN size > 0 AND size <= over THEN (u / (1 - u)) * ((1 - share) / share) END AS q FROM included
), placed AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY source, q IS NULL ORDER BY q, doc_id NULLS FIRST, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE AS below FROM ranked
)
SELECT doc_id, size, source_size, target,
       (size * (whole + CASE WHEN size > over THEN 1 WHEN q IS NOT NULL AND below + size::DOUBLE / 2 <= draw THEN 1 ELSE 0 END))::BIGINT AS taken FROM placed
"""

QUERIES = {"op7_mixing": op7_mixing}
ORACLES = {"op7_mixing": OP7_SQL}
