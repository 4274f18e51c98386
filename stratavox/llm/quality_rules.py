"""Quality rules whose thresholds come from the data: mergeable quantile sketches per language and source, then a joined filter.

DataFrame operations only. Word statistics are computed over whole texts. Documents that fail the two fixed base rules
are out. The other documents' ratios, as whole numbers of a fixed unit, are summarised per (lang, source) in a sketch: a
histogram of logarithmic buckets, each split into equal parts, with a relative error of 1 / ``PARTS``. Sketches are merged
by adding counts, so they are the same in any order of rows and in any rerun, and those of a language and of all documents
come from those of the groups. A ratio is an outlier where the sketch breaks off: from the 90th percentile on (and, for the
length of words, from the 10th down) values are passed as long as each lies near the one before, and the fence stands where
the next would be too far to reach. Near is within ``REACH`` scales, or within a doubling of a ratio of counts; the scale is
the spread between the quartiles or, if that is more, what a single count makes of a document of median size. So every fence
is a value of the data and of its own scale, and a tail that thins out evenly is kept, a separate cluster is not. A group's
fence is shrunk towards that of its language, and that towards the one of all, each as if ``PRIOR`` more documents had said
so: small groups hardly move it, large ones hardly notice, and there is no size at which the rule changes.

Nulls: a null text has no words and fails the base rules; null languages and sources are groups of their own. Repeated
rows are judged each; ties are equal ratios with equal verdicts. A verdict never depends on an id. An empty table gives no
rows, texts may be of any length, and columns of other names are not read.
"""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratavox.llm import common

WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
#: Base rules: fewest words, and most words in repeated windows, of a hundred.
MIN_WORDS, MOST_REPEATED = 50, 50
#: Parts of a doubling in a sketch, documents that a prior weighs, and scales that a gap may have.
PARTS, PRIOR, REACH = 64, 200, 6
#: Ratios judged: (count, of, units of one). Word length, which is no share of a text, has a lower fence too.
RATIOS = {
    "symbol_ratio": ("n_symbols", "word_chars", 10_000),
    "dup_line_ratio": ("n_dup_lines", "n_lines", 10_000),
    "repeat_ratio": ("n_repeat_words", "n_words", 10_000),
    "word_length": ("word_chars", "n_words", 100),
}
LENGTH = "word_length"
#: Sizes of a document whose medians say what a single count makes.
SIZES = {"symbol_ratio": "word_chars", "dup_line_ratio": "n_lines", "repeat_ratio": "n_words"}
QUANTILES = (10, 25, 50, 75, 90)
#: Repeated windows of a text beyond which they are found by sorting instead of by lookup.
LOOKUP = 64


def with_features(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words; the text column is dropped."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    keep = [c for c in docs.columns if c != text_col]
    bare = F.regexp_replace("__text", r"[\x20\x09-\x0D]+", "")
    lines = F.filter(F.split("__text", "\n"), lambda x: F.length(F.translate(x, " \t\n\x0b\x0c\r", "")) > 0)
    df = docs.withColumn("__text", text).select(*keep, "__text", F.regexp_extract_all("__text", F.lit(f"({WORD})"), F.lit(1)).alias("__words"), lines.alias("__lines"))
    n = F.size("__words")
    windows = F.sequence(F.lit(1), n - 2)
    key = lambda i: F.xxhash64(F.element_at("__words", i), F.element_at("__words", i + 1), F.element_at("__words", i + 2))
    df = df.select(
        *keep,
        n.cast("long").alias("n_words"),
        F.length(bare).cast("long").alias("word_chars"),
        (F.length("__text") - F.length(F.translate("__text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.size("__lines").cast("long").alias("n_lines"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        F.when(n >= 3, F.transform(windows, key)).otherwise(F.array().cast("array<bigint>")).alias("__keys"),
    )
    # arrays that a lambda looks into are columns of their own: an expression inside it would be evaluated for every element
    none = F.array().cast("array<bigint>")
    df = df.withColumn("__ordered", F.when(F.size(F.array_distinct("__keys")) < F.size("__keys"), F.sort_array("__keys")).otherwise(none))
    df = df.withColumn("__twice", F.array_distinct(F.filter("__ordered", lambda k, i: (i > 0) & (k == F.get("__ordered", i - 1)))))
    placed = F.transform("__keys", lambda k, i: F.struct(k.alias("k"), i.alias("i")))
    df = df.withColumn("__placed", F.when(F.size("__twice") == 0, F.array().cast("array<struct<k:bigint,i:int>>")).when(F.size("__twice") <= LOOKUP, placed).otherwise(F.sort_array(placed)))
    found = F.filter("__placed", lambda s: F.array_contains("__twice", s["k"]))
    beside = lambda s, j: (F.coalesce(F.get("__placed", j + 1)["k"] == s["k"], F.lit(False))) | ((j > 0) & (F.get("__placed", j - 1)["k"] == s["k"]))
    df = df.withColumn("__found", F.when(F.size("__twice") <= LOOKUP, found).otherwise(F.filter("__placed", beside)))
    df = df.withColumn("__starts", F.sort_array(F.transform("__found", lambda s: s["i"])))
    start = F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("n"))
    covered = F.aggregate("__starts", start, lambda a, x: F.struct(x.alias("last"), (a["n"] + F.least(F.lit(3), x - a["last"])).alias("n")), lambda a: a["n"])
    return df.withColumn("n_repeat_words", covered).drop("__keys", "__ordered", "__twice", "__placed", "__found", "__starts")


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def with_ratios(rows: DataFrame) -> DataFrame:
    """Adds each ratio in whole units, rounded down."""
    return rows.withColumns({name: F.expr(f"({count} * {unit}) div greatest({of}, 1)") for name, (count, of, unit) in RATIOS.items()})


def bucket(value: str) -> Column:
    """Lower edge of a value's bucket: values below 2 * PARTS stand for themselves, above a doubling has PARTS buckets."""
    shift = f"length(bin({value})) - {(2 * PARTS).bit_length() - 1}"
    return F.expr(f"CASE WHEN {value} < {2 * PARTS} THEN {value} ELSE shiftleft(shiftright({value}, {shift}), {shift}) END")


def sketches(rows: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """(lang, source, ratio, edge, n): one sketch for each group and ratio, and for each group and size."""
    values = F.explode(F.array(*(F.struct(F.lit(name).alias("ratio"), F.col(name).alias("value")) for name in (*RATIOS, *SIZES.values())))).alias("v")
    one = rows.select(F.col(lang).alias("lang"), F.col(source).alias("source"), values).select("lang", "source", "v.ratio", bucket("v.value").alias("edge"))
    return one.groupBy("lang", "source", "ratio", "edge").agg(F.count("*").alias("n"))


#: Levels of the sketches: a group (language and source), its language, all documents.
GROUP, LANG, ALL = 0, 1, 2


def fences(sketch: DataFrame) -> DataFrame:
    """(level, lang, source, ratio, n, low, high) of the sketches of all groups, languages and of all documents."""
    none = F.lit(None).cast("string")
    levels = F.explode(F.array(*(F.struct(F.lit(k).alias("level"), a.alias("lang"), b.alias("source")) for k, a, b in ((GROUP, F.col("lang"), F.col("source")), (LANG, F.col("lang"), none), (ALL, none, none))))).alias("l")
    at = ["level", "lang", "source"]
    merged = sketch.select(levels, "ratio", "edge", "n").groupBy("l.level", "l.lang", "l.source", "ratio", "edge").agg(F.sum("n").alias("n"))
    one = Window.partitionBy(*at, "ratio")
    along = one.orderBy("edge")
    merged = merged.withColumns({"upto": F.sum("n").over(along), "all": F.sum("n").over(one), "next": F.lead("edge").over(along), "prev": F.lag("edge").over(along)})
    merged = merged.withColumns({f"q{p}": F.min(F.when(F.col("upto") * 100 >= F.col("all") * p, F.col("edge"))).over(one) for p in QUANTILES})
    # the median sizes come to the ratios' rows as their own
    medians = merged.where(F.col("ratio").isin(*SIZES.values())).groupBy(*at).agg(*(F.max(F.when(F.col("ratio") == c, F.col("q50"))).alias(f"m_{c}") for c in SIZES.values()))
    medians = medians.select(*(F.col(c).alias(f"m_{c}") for c in at), *(f"m_{c}" for c in SIZES.values()))
    rows = merged.where(F.col("ratio").isin(*RATIOS)).join(medians, functools.reduce(operator.and_, (F.col(c).eqNullSafe(F.col(f"m_{c}")) for c in at)))
    single = F.lit(1)
    for name, of in SIZES.items():
        single = F.when(F.col("ratio") == name, F.expr(f"{RATIOS[name][2]} div greatest(m_{of}, 1)")).otherwise(single)
    scale = REACH * F.greatest(F.col("q75") - F.col("q25"), single, F.lit(1))
    reach = F.when(F.col("ratio") == LENGTH, F.col("scale")).otherwise(F.greatest("scale", "edge"))
    rows = rows.withColumn("scale", scale).withColumn("reach", reach)
    top = (F.col("edge") >= F.col("q90")) & (F.col("next").isNull() | (F.col("next") - F.col("edge") > F.col("reach")))
    bottom = (F.col("ratio") == LENGTH) & (F.col("edge") <= F.col("q10")) & (F.col("prev").isNull() | (F.col("edge") - F.col("prev") > F.col("scale")))
    high, low = F.min(F.when(top, F.col("edge") + F.col("reach"))), F.max(F.when(bottom, F.col("edge") - F.col("scale")))
    return rows.groupBy(*at, "ratio").agg(F.sum("n").alias("n"), F.coalesce(low, F.lit(-1)).cast("double").alias("low"), high.cast("double").alias("high"))


def thresholds(rows: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """(lang, source, lo_<ratio>, hi_<ratio>) for every group in ``rows``, shrunk towards its language and all."""
    found = common.checkpointed(fences(sketches(rows, lang, source)))  # a row a level, group and ratio
    named = lambda level, tag: found.where(F.col("level") == level).select(*(F.col(c).alias(f"{tag}_{c}") for c in found.columns))
    of_lang, of_all = named(LANG, "l"), named(ALL, "a")
    joined = found.where(F.col("level") == GROUP).join(of_lang, F.col("lang").eqNullSafe(F.col("l_lang")) & (F.col("ratio") == F.col("l_ratio"))).join(F.broadcast(of_all), F.col("ratio") == F.col("a_ratio"))  # a row a ratio
    shrunk = lambda n, x, prior: (n * x + PRIOR * prior) / (n + PRIOR)
    fence = lambda c: shrunk(F.col("n").cast("double"), F.col(c), shrunk(F.col("l_n").cast("double"), F.col(f"l_{c}"), F.col(f"a_{c}")))
    settled = joined.select("lang", "source", "ratio", fence("low").alias("low"), fence("high").alias("high"))
    pick = lambda name, c: F.max(F.when(F.col("ratio") == name, F.col(c)))
    return settled.groupBy(F.col("lang").alias("__lang"), F.col("source").alias("__source")).agg(*(pick(r, c).alias(f"{t}_{r}") for r in RATIOS for c, t in (("low", "lo"), ("high", "hi"))))


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """Per row: doc_id, n_words, the four counts, base_failed, kept, the ratios in units and the fences they met.

    Features are stored once in between.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"), F.col(source_col).cast("string").alias("source"))
    rows = with_ratios(common.checkpointed(with_features(rows)).withColumn("base_failed", base_failed()))
    found = thresholds(rows.where(~F.col("base_failed")))
    joined = rows.join(found, F.col("lang").eqNullSafe(F.col("__lang")) & F.col("source").eqNullSafe(F.col("__source")), "left")
    inside = functools.reduce(operator.and_, (F.col(r).between(F.col(f"lo_{r}"), F.col(f"hi_{r}")) for r in RATIOS))
    return joined.withColumn("kept", ~F.col("base_failed") & F.coalesce(inside, F.lit(False))).drop("__lang", "__source")


def op8_quality_rules(spark, sf_dir: str) -> DataFrame:
    """Word statistics of all ``documents`` and the verdict of the adaptive rules."""
    out = judge(common.table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def _single_sql() -> str:
    return "CASE ratio " + " ".join(f"WHEN '{name}' THEN {RATIOS[name][2]} // greatest(m_{of}, 1)" for name, of in SIZES.items()) + " ELSE 1 END"


FENCES_SQL = f"""leveled AS (
  SELECT level, CASE WHEN level < 2 THEN lang END AS lang, CASE WHEN level < 1 THEN source END AS source, ratio, edge, count(*) AS n FROM sketch, (SELECT unnest([0, 1, 2]) AS level) GROUP BY ALL
), summed AS (
  SELECT *, sum(n) OVER (PARTITION BY level, lang, source, ratio ORDER BY edge) AS upto, sum(n) OVER (PARTITION BY level, lang, source, ratio) AS total FROM leveled
), ranked AS (
  SELECT level, lang, source, ratio, {", ".join(f"min(edge) FILTER (WHERE upto * 100 >= total * {p}) AS q{p}" for p in QUANTILES)}, list(edge ORDER BY edge) AS edges, sum(n)::DOUBLE AS n FROM summed GROUP BY ALL
), medians AS (
  SELECT level, lang, source, {", ".join(f"max(q50) FILTER (WHERE ratio = '{c}') AS m_{c}" for c in SIZES.values())} FROM ranked GROUP BY ALL
), scaled AS (
  SELECT r.*, {REACH} * greatest(q75 - q25, {_single_sql()}, 1) AS scale
  FROM ranked r JOIN medians m ON r.level = m.level AND r.lang IS NOT DISTINCT FROM m.lang AND r.source IS NOT DISTINCT FROM m.source WHERE ratio IN ({", ".join(f"'{r}'" for r in RATIOS)})
), stepped AS (
  SELECT *, unnest(edges) AS e, unnest(list_append(edges[2:], NULL)) AS after, unnest(list_prepend(NULL, edges[:-2])) AS before FROM scaled
), fenced AS (
  SELECT level, lang, source, ratio, n,
         min(e + CASE WHEN ratio = '{LENGTH}' THEN scale ELSE greatest(scale, e) END) FILTER (WHERE e >= q90 AND (after IS NULL OR after - e > CASE WHEN ratio = '{LENGTH}' THEN scale ELSE greatest(scale, e) END))::DOUBLE AS high,
         coalesce(max(e - scale) FILTER (WHERE ratio = '{LENGTH}' AND e <= q10 AND (before IS NULL OR e - before > scale)), -1)::DOUBLE AS low
  FROM stepped GROUP BY ALL
)"""


OP8_SQL = rf"""
WITH base AS (
  SELECT row_number() OVER () AS r, doc_id, lang, source, coalesce(text, '') AS text FROM documents
), split AS (
  SELECT *, regexp_extract_all(text, '{WORD}') AS words, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS lines FROM base
), words AS (
  SELECT r, i, w, lead(w, 1) OVER o AS w2, lead(w, 2) OVER o AS w3
  FROM (SELECT r, unnest(words) AS w, generate_subscripts(words, 1) AS i FROM split) WINDOW o AS (PARTITION BY r ORDER BY i)
), twice AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, w, w2, w3) AS n FROM words WHERE w3 IS NOT NULL) WHERE n > 1
), covered AS (
  SELECT r, count(DISTINCT i + k) AS n FROM twice, (SELECT unnest([0, 1, 2]) AS k) GROUP BY r
), chars AS (
  SELECT r, sum(length(w))::BIGINT AS n FROM words GROUP BY r
), counted AS (
  SELECT s.doc_id, s.lang, s.source, len(s.words)::BIGINT AS n_words, coalesce(c.n, 0)::BIGINT AS word_chars, length(regexp_replace(s.text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         len(s.lines)::BIGINT AS n_lines, (len(s.lines) - len(list_distinct(s.lines)))::BIGINT AS n_dup_lines, coalesce(v.n, 0)::BIGINT AS n_repeat_words
  FROM split s LEFT JOIN chars c ON s.r = c.r LEFT JOIN covered v ON s.r = v.r
), judged AS (
  SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words AS base_failed,
         {", ".join(f"({c} * {u}) // greatest({of}, 1) AS {r}" for r, (c, of, u) in RATIOS.items())}
  FROM counted
), sketch AS (
  SELECT lang, source, ratio, CASE WHEN v < {2 * PARTS} THEN v ELSE (v >> (length(bin(v)) - {(2 * PARTS).bit_length() - 1})) << (length(bin(v)) - {(2 * PARTS).bit_length() - 1}) END AS edge
  FROM (SELECT lang, source, unnest([{", ".join(f"'{r}'" for r in (*RATIOS, *SIZES.values()))}]) AS ratio, unnest([{", ".join((*RATIOS, *SIZES.values()))}]) AS v FROM judged WHERE NOT base_failed)
), {FENCES_SQL}, shrunk AS (
  SELECT o.lang, o.source, o.ratio, {", ".join(f"(o.n * o.{c} + {PRIOR}::DOUBLE * ((l.n * l.{c} + {PRIOR}::DOUBLE * a.{c}) / (l.n + {PRIOR}::DOUBLE))) / (o.n + {PRIOR}::DOUBLE) AS {c}" for c in ("low", "high"))}
  FROM fenced o JOIN fenced l ON l.level = 1 AND o.lang IS NOT DISTINCT FROM l.lang AND o.ratio = l.ratio JOIN fenced a ON a.level = 2 AND o.ratio = a.ratio WHERE o.level = 0
), wide AS (
  SELECT lang, source, {", ".join(f"max(low) FILTER (WHERE ratio = '{r}') AS lo_{r}, max(high) FILTER (WHERE ratio = '{r}') AS hi_{r}" for r in RATIOS)} FROM shrunk GROUP BY lang, source
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND coalesce({" AND ".join(f"{r}::DOUBLE BETWEEN lo_{r} AND hi_{r}" for r in RATIOS)}, false) AS kept
FROM judged j LEFT JOIN wide w ON j.lang IS NOT DISTINCT FROM w.lang AND j.source IS NOT DISTINCT FROM w.source
"""

QUERIES = {"op8_quality_rules": op8_quality_rules}
ORACLES = {"op8_quality_rules": OP8_SQL}
