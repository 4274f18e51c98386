"""Conversation structure repair: faults flagged by windows, then the cheapest edits to a legal order of roles, found by a fold.

DataFrame operations only. A conversation is legal when the initials of its roles read ``(s?(ua)+)?``. Edits of its turns, in
order: Keep (no cost), Rerole to user or assistant, Delete (required for blank and repeated turns), Insert an empty turn of
user or assistant anywhere; a truncated turn that stays costs extra. ``aggregate()`` goes over sorted turn structs and
carries, for each of four states (nothing yet, after a system turn, after a user turn, after an assistant turn), the cheapest
(cost, audit): the initials of the edits so far. ``least`` decides; of equal costs it takes the ASCII-least audit. Two audits
of equal cost over the same turns are never prefixes of each other, so that choice is right step by step.

No conversation is folded in one piece: turns are sorted over range partitions, and blocks of ``BLOCK`` of them are folded
from each of the four states. A block is then a table of 4 x 4 (cost, audit), and tables are multiplied by the same ``least``,
first within a partition and then over the partitions of a conversation. What grows with a conversation in one row is its
audit alone (and, in the query, the text whose hash is asked for). Repeated turns are found by a partial minimum, not in a
window of all turns that agree, and joined on the turn's place.

Nulls: in role and text they count as one space (so a null text is blank, and a null role can only be changed or deleted); a
null conversation is a conversation; null turns come first and count for no gap. Ties: turns with one number come in the
order of role and text, so repeated rows are adjacent and all but the first are duplicates. An empty role has no initial, fits
nowhere and makes a pair with a neighbour illegal. A conversation without turns has zeros and an empty audit. An empty table gives no
rows; texts may be of any length; extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratavox.llm import common

BLANKS = " \t\n\x0b\x0c\r"
INK = r"[^\x20\x09-\x0D]"
#: Costs of edits, and what a truncated turn that stays adds.
REROLE, DELETE, INSERT, CUT = 3, 4, 3, 3
FINE, BLANK, DUPLICATE, TRUNCATED = 0, 1, 2, 3
STATES = ("e", "s", "u", "a")
#: Turns of a block (a power of two: ``BITS`` of a turn's place), and bits of a place within a partition.
BITS, PARTITION_BITS = 8, 33
PATH = "struct<cost:bigint,audit:string>"
LEGAL = ("su", "ua", "au")


def damaged(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, turn, role, text) with faults put in by crc32 of ``conv_id:turn`` modulo 20, to test a repair on.

    0 drops a turn, 1 empties it, 2 takes its ``.!?``, 3 repeats it, 4 makes it the user's. Nulls of all columns count as one space here.
    """
    named = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(named(conv), F.lit(":"), named(turn))) % 20
    rows = turns.select(F.col(conv).alias("conv_id"), F.col(turn).cast("bigint").alias("turn"), named(role).alias("role"), named(text).alias("text"), fault.alias("fault"))
    text_now = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.explode(F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    out = rows.where(F.col("fault") != 0).select("conv_id", "turn", F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"), text_now.alias("text"), copies.alias("copy"))
    return out.drop("copy")


def placed(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(place, conv, turn, role, text, initial, fault): places grow in the order of (conv, turn, role, text), by one within a partition."""
    named = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    # rows equal in all else are told apart by where they were read, so that many of them spread over partitions
    rows = turns.select(F.col(conv).alias("conv"), F.col(turn).cast("bigint").alias("turn"), named(role).alias("role"), named(text).alias("text"), F.xxhash64(F.monotonically_increasing_id()).alias("salt"))
    order = [F.col("conv").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text"), F.col("salt")]
    rows = rows.repartitionByRange(common.partitions(turns.sparkSession), *order).sortWithinPartitions(*order)
    rows = common.checkpointed(rows.select(F.monotonically_increasing_id().alias("place"), "conv", "turn", "role", "text"))
    inked = F.col("text").rlike(INK)
    firsts = rows.where(inked).groupBy("conv", "role", F.sha2("text", 256)).agg(F.min("place").alias("first")).select("first")
    last = F.substring(F.rtrim(F.col("text"), F.lit(BLANKS)), -1, 1)
    fault = F.when(~inked, BLANK).when(F.col("first").isNull(), DUPLICATE).when(~last.isin(".", "!", "?"), TRUNCATED).otherwise(FINE)
    return rows.join(firsts, F.col("place") == F.col("first"), "left").select("place", "conv", "turn", "role", "text", F.substring("role", 1, 1).alias("initial"), fault.alias("fault"))


def _then(path: Column, cost: Column | int, edit: str | Column) -> Column:
    """The path after one more edit; null, which ``least`` passes over, where the path is not open."""
    return F.when(path.isNotNull(), F.struct((path["cost"] + cost).cast("bigint").alias("cost"), F.concat(path["audit"], F.lit(edit) if isinstance(edit, str) else edit).alias("audit")))


def _inserted(acc: Column) -> tuple[Column, Column]:
    """Paths to the states after user and after assistant once turns may have been inserted; more than two never pay."""
    u = F.least(acc["u"], *(_then(acc[s], INSERT, "I") for s in "esa"))
    return u, F.least(acc["a"], _then(u, INSERT, "I"))


def _step(acc: Column, turn: Column) -> Column:
    u, a = _inserted(acc)
    free, initial, extra = turn["fault"].isin(FINE, TRUNCATED), turn["initial"], F.when(turn["fault"] == TRUNCATED, CUT).otherwise(0)
    to_user = F.least(acc["e"], acc["s"], a)
    keep = lambda path, role: F.when(free & (initial == role), _then(path, extra, "K"))
    rerole = lambda path: F.when(free, _then(path, extra + REROLE, "R"))
    gone = lambda path: _then(path, DELETE, "D")
    return F.struct(
        gone(acc["e"]).alias("e"),
        F.least(gone(acc["s"]), keep(acc["e"], "s")).alias("s"),
        F.least(gone(u), keep(to_user, "u"), rerole(to_user)).alias("u"),
        F.least(gone(a), keep(u, "a"), rerole(u)).alias("a"),
    )


def _start(state: str) -> Column:
    here = F.struct(F.lit(0).cast("bigint").alias("cost"), F.lit("").alias("audit")).cast(PATH)
    return F.struct(*((here if s == state else F.lit(None).cast(PATH)).alias(s) for s in STATES))


def _closed() -> Column:
    """No path to any state."""
    return F.struct(*(F.lit(None).cast(PATH).alias(s) for s in STATES))


#: What a block says besides its paths, in the order of the struct's fields.
COUNTS = ("n", "blank", "duplicate", "truncated", "illegal", "turns")


def blocks(rows: DataFrame) -> DataFrame:
    """(conv, part, block): the counts and the path table of every run of ``BLOCK`` places of a conversation."""
    rows = rows.select("place", "conv", "turn", "initial", "fault", F.shiftright("place", BITS).alias("run"))
    order = Window.partitionBy("conv", "run").orderBy("place")
    before, turn_before = F.lag("initial").over(order), F.lag("turn").over(order)
    flagged = rows.withColumns(
        {
            "bad_pair": before.isNotNull() & ~F.concat(before, F.col("initial")).isin(*LEGAL),
            "new_turn": F.col("turn").isNotNull() & ~F.coalesce(turn_before == F.col("turn"), F.lit(False)),
        }
    )
    count = lambda c: F.count_if(c)
    found = flagged.groupBy("conv", "run").agg(
        F.min("place").alias("place"),
        F.count("*").alias("n"),
        *(count(F.col("fault") == f).alias(name) for name, f in (("blank", BLANK), ("duplicate", DUPLICATE), ("truncated", TRUNCATED))),
        count(F.col("bad_pair")).alias("illegal"),
        count(F.col("new_turn")).alias("turns"),
        F.min("turn").alias("least_turn"),
        F.max("turn").alias("most_turn"),
        F.sort_array(F.collect_list(F.struct("place", "initial", "fault"))).alias("seen"),
    )
    # a conversation that begins within a run begins with nothing; only where a run begins may it go on from another state
    goes_on = F.col("place") % (1 << BITS) == 0
    fold = {s: F.aggregate("seen", _start(s), _step) for s in STATES}
    paths = found.withColumns({f"p_{s}": f if s == "e" else F.when(goes_on, f).otherwise(_closed()) for s, f in fold.items()})
    ends = [F.get("seen", 0)["initial"].alias("first"), F.element_at("seen", -1)["initial"].alias("last")]
    pieces = F.array(F.struct("place", "n"))
    block = F.struct("place", *COUNTS, "least_turn", "most_turn", *ends, pieces.alias("pieces"), F.struct(*(F.col(f"p_{s}").alias(s) for s in STATES)).alias("paths"))
    return paths.select("conv", F.shiftright("place", PARTITION_BITS).alias("part"), block.alias("block"))


def _product(left: Column, right: Column) -> Column:
    """Paths through two neighbouring blocks: the least over the state between them."""
    between = lambda s, t: F.least(*(F.when(left[s][k].isNotNull() & right[k][t].isNotNull(), _then(left[s][k], right[k][t]["cost"], right[k][t]["audit"])) for k in STATES))
    return F.struct(*(F.struct(*(between(s, t).alias(t) for t in STATES)).alias(s) for s in STATES))


def _joined(a: Column, b: Column, one_piece: bool) -> Column:
    """Two neighbouring blocks as one."""
    meets = {"illegal": F.when(~F.concat(a["last"], b["first"]).isin(*LEGAL), 1).otherwise(0), "turns": F.when(a["most_turn"] == b["least_turn"], -1).otherwise(0)}
    counts = [(a[c] + b[c] + meets.get(c, F.lit(0))).cast("bigint").alias(c) for c in COUNTS]
    turns = [F.least(a["least_turn"], b["least_turn"]).alias("least_turn"), F.greatest(a["most_turn"], b["most_turn"]).alias("most_turn")]
    pieces = F.array(F.struct(a["place"].alias("place"), (a["n"] + b["n"]).alias("n"))) if one_piece else F.concat(a["pieces"], b["pieces"])
    return F.struct(a["place"].alias("place"), *counts, *turns, a["first"].alias("first"), b["last"].alias("last"), pieces.alias("pieces"), _product(a["paths"], b["paths"]).alias("paths"))


def _merged(found: DataFrame, keys: list[str], one_piece: bool) -> DataFrame:
    out = found.groupBy(*keys).agg(F.sort_array(F.collect_list("block")).alias("all"))
    fold = F.aggregate(F.slice("all", 2, F.greatest(F.size("all") - 1, F.lit(0))), F.get("all", 0), lambda a, b: _joined(a, b, one_piece))
    return out.select(*keys, F.when(F.size("all") <= 1, F.get("all", 0)).otherwise(fold).alias("block"))


def plan(rows: DataFrame, conversations: DataFrame | None = None) -> DataFrame:
    """(conv, pieces, cost, audit, gaps and the counts of faults) of every conversation in ``rows`` and in ``conversations`` (conv)."""
    parts = _merged(blocks(rows), ["conv", "part"], True).select("conv", "block")
    if conversations is not None:
        parts = parts.unionByName(conversations.select("conv").distinct(), allowMissingColumns=True)
    whole = _merged(parts, ["conv"], False)
    paths = F.col("block.paths.e")
    best = F.least(paths["e"], _inserted(paths)[1])
    counted = lambda c: F.coalesce(F.col(f"block.{c}"), F.lit(0)).cast("bigint")
    gaps = F.coalesce(F.col("block.most_turn") - F.col("block.least_turn") + 1 - F.col("block.turns"), F.lit(0)).cast("bigint")
    return whole.select(
        "conv", F.col("block.pieces").alias("pieces"), gaps.alias("gaps"), *(counted(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal")), F.coalesce(best["cost"], F.lit(0)).cast("bigint").alias("cost"), F.coalesce(best["audit"], F.lit("")).alias("audit")
    )


def edits(plans: DataFrame) -> DataFrame:
    """(conv, nth, edit, place, role): one row a turn of the repaired conversation; place is the turn it comes from, null if inserted."""
    letters = lambda gone: F.filter(F.split(F.translate("audit", gone, ""), ""), lambda x: x != "")
    at = lambda array, other: F.filter(F.transform(array, lambda x, i: F.when(x != other, i)), lambda i: i.isNotNull())
    df = plans.select("conv", "pieces", letters("I").alias("old"), letters("D").alias("new"))
    kept = F.arrays_zip(at("new", "I").alias("nth"), at("old", "D").alias("k"), F.filter("old", lambda x: x != "D").alias("edit"))
    kept = F.transform(kept, lambda z: F.struct(z["nth"].alias("nth"), z["k"].alias("k"), z["edit"].alias("edit")))
    added = F.filter(F.transform("new", lambda x, i: F.when(x == "I", F.struct(i.alias("nth"), F.lit(None).cast("int").alias("k"), F.lit("I").alias("edit")))), lambda z: z.isNotNull())
    df = df.select("conv", "pieces", F.size("new").alias("total"), F.explode(F.concat(kept, added)).alias("z")).select("conv", "pieces", "total", "z.*")
    # the k-th turn stands in the piece at which the counts so far pass k
    start = F.struct(F.lit(None).cast("bigint").alias("place"), F.col("k").cast("bigint").alias("left"))
    pick = lambda s, p: F.struct(F.when((s["left"] >= 0) & (s["left"] < p["n"]), p["place"] + s["left"]).otherwise(s["place"]).alias("place"), (s["left"] - p["n"]).alias("left"))
    place = F.aggregate("pieces", start, pick, lambda s: s["place"])
    role = F.when(F.col("nth") % 2 == F.col("total") % 2, "user").otherwise("assistant")
    return df.select("conv", "nth", "edit", place.alias("place"), role.alias("role"))


def repaired(rows: DataFrame, plans: DataFrame) -> DataFrame:
    """(conv, nth, edit, role, text): the turns of every repaired conversation, numbered from 0."""
    todo = edits(plans)
    own = rows.select("place", F.col("role").alias("__role"), "text")
    role = F.when(F.col("edit") == "K", F.col("__role")).otherwise(F.col("role"))
    stay = todo.where(F.col("edit") != "I").join(own, "place").select("conv", "nth", "edit", role.alias("role"), "text")
    return stay.unionByName(todo.where(F.col("edit") == "I").select("conv", "nth", "edit", "role", F.lit("").alias("text")))


def repair(turns: DataFrame, conversations: DataFrame | None = None, **columns: str) -> tuple[DataFrame, DataFrame]:
    """(plans, turns) of the cheapest repair; ``conversations`` (conv) names those to list even if no turn is left."""
    rows = placed(turns, **columns)
    plans = common.checkpointed(plan(rows, conversations))
    return plans, repaired(rows, plans)


def op12_turn_repair(spark, sf_dir: str) -> DataFrame:
    """All ``conversations``, damaged and repaired: faults, the cheapest edits and a hash of what comes out."""
    table = common.table(spark, sf_dir, "conversations")
    plans, turns = repair(damaged(table), table.select(F.col("conv_id").alias("conv")))
    said = plans.select("conv", F.struct(*(c for c in plans.columns if c not in ("conv", "pieces"))).alias("plan"))
    lines = turns.select("conv", F.struct("nth", F.concat("role", F.lit(":"), "text").alias("line")).alias("line"))
    both = said.unionByName(lines, allowMissingColumns=True).groupBy("conv").agg(F.max("plan").alias("plan"), F.sort_array(F.collect_list("line")).alias("lines"))
    text = F.array_join(F.transform("lines", lambda x: x["line"]), "\n")
    return both.select(F.col("conv").alias("conv_id"), "plan.*", F.sha2(text, 256).alias("repaired_sha256"))


_CRC = """list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(string_split({key}, ''), lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda crc, x: CASE WHEN x >= 0 THEN xor(crc, x) WHEN crc & 1 = 1 THEN xor(crc >> 1, 3988292384::BIGINT) ELSE crc >> 1 END)"""

OP12_SQL = rf"""
WITH RECURSIVE source AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key FROM conversations
), hashed AS (
  SELECT *, xor({_CRC.format(key="key")}, 4294967295::BIGINT) % 20 AS fault FROM source
), damaged AS (
  SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN fault = 1 THEN '' WHEN fault = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM hashed, (SELECT unnest([0, 1]) AS copy) WHERE fault <> 0 AND (copy = 0 OR fault = 3)
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS k FROM damaged
), flagged AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '{INK}') THEN 1 WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY k) > 1 THEN 2
                 WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 3 ELSE 0 END AS fault,
         lag(role) OVER (PARTITION BY conv_id ORDER BY k) AS before
  FROM numbered
), counted AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
         count(*) FILTER (WHERE fault = 1) AS blank, count(*) FILTER (WHERE fault = 2) AS duplicate, count(*) FILTER (WHERE fault = 3) AS truncated,
         count(*) FILTER (WHERE k > 1 AND left(before, 1) || left(role, 1) NOT IN ('su', 'ua', 'au')) AS illegal
  FROM flagged GROUP BY conv_id
), walk AS (
  -- a path is its cost in ten digits and its audit, so that least() takes the cheapest and then the ASCII-least; '~' is no path
  SELECT conv_id, 0::BIGINT AS k, '0000000000' AS e, '~' AS s, '~' AS u, '~' AS a FROM counted
  UNION ALL
  SELECT conv_id, k, pe, least(ps, CASE WHEN ok AND i = 's' THEN ke ELSE '~' END),
         least(pu, CASE WHEN ok AND i = 'u' THEN least(ke, ks, ka) ELSE '~' END, CASE WHEN ok THEN least(re, rs, ra) ELSE '~' END),
         least(pa, CASE WHEN ok AND i = 'a' THEN ku ELSE '~' END, CASE WHEN ok THEN ru ELSE '~' END)
  FROM (SELECT conv_id, k, ok, i,
               {", ".join(f"CASE WHEN {s} = '~' THEN '~' ELSE lpad((left({s}, 10)::BIGINT + {cost})::VARCHAR, 10, '0') || substr({s}, 11) || '{edit}' END AS {tag}{s}" for s in STATES for tag, cost, edit in (("p", DELETE, "D"), ("k", f"extra", "K"), ("r", f"{REROLE} + extra", "R")))}
        FROM (SELECT *, least(a0, CASE WHEN u = '~' THEN '~' ELSE lpad((left(u, 10)::BIGINT + {INSERT})::VARCHAR, 10, '0') || substr(u, 11) || 'I' END) AS a
              FROM (SELECT f.conv_id, f.k, f.fault IN (0, 3) AS ok, left(f.role, 1) AS i, CASE WHEN f.fault = 3 THEN {CUT} ELSE 0 END AS extra, w.e, w.s, w.a AS a0,
                           least(w.u, {", ".join(f"CASE WHEN w.{s} = '~' THEN '~' ELSE lpad((left(w.{s}, 10)::BIGINT + {INSERT})::VARCHAR, 10, '0') || substr(w.{s}, 11) || 'I' END" for s in "esa")}) AS u
                    FROM walk w JOIN flagged f ON w.conv_id IS NOT DISTINCT FROM f.conv_id AND f.k = w.k + 1)))
), ended AS (
  SELECT w.conv_id, least(e, a, {", ".join(f"CASE WHEN {s} = '~' THEN '~' ELSE lpad((left({s}, 10)::BIGINT + {n} * {INSERT})::VARCHAR, 10, '0') || substr({s}, 11) || '{'I' * n}' END" for s, n in (("e", 2), ("s", 2), ("u", 1)))}) AS path
  FROM walk w JOIN counted c ON w.conv_id IS NOT DISTINCT FROM c.conv_id AND w.k = c.n
), chosen AS (
  SELECT conv_id, left(path, 10)::BIGINT AS cost, substr(path, 11) AS audit FROM ended
), letters AS (
  SELECT conv_id, audit, i, substr(audit, i, 1) AS edit FROM (SELECT conv_id, audit, unnest(range(1, length(audit) + 1)) AS i FROM chosen)
), numbers AS (
  SELECT *, count(*) FILTER (WHERE edit <> 'I') OVER w AS k, count(*) FILTER (WHERE edit <> 'D') OVER w AS nth, count(*) FILTER (WHERE edit <> 'D') OVER (PARTITION BY conv_id) AS total
  FROM letters WINDOW w AS (PARTITION BY conv_id ORDER BY i)
), lines AS (
  SELECT n.conv_id, n.nth, CASE WHEN edit = 'K' THEN f.role WHEN (n.nth - 1) % 2 = total % 2 THEN 'user' ELSE 'assistant' END || ':' || CASE WHEN edit = 'I' THEN '' ELSE f.text END AS line
  FROM numbers n JOIN flagged f ON n.conv_id IS NOT DISTINCT FROM f.conv_id AND f.k = greatest(n.k, 1) WHERE edit <> 'D'
), hashes AS (
  SELECT conv_id, sha256(string_agg(line, chr(10) ORDER BY nth)) AS repaired_sha256 FROM lines GROUP BY conv_id
)
SELECT o.conv_id, {", ".join(f"coalesce(c.{x}, 0)::BIGINT AS {x}" for x in ("gaps", "blank", "duplicate", "truncated", "illegal"))}, coalesce(p.cost, 0)::BIGINT AS cost, coalesce(p.audit, '') AS audit,
       coalesce(h.repaired_sha256, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN counted c ON o.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN chosen p ON o.conv_id IS NOT DISTINCT FROM p.conv_id LEFT JOIN hashes h ON o.conv_id IS NOT DISTINCT FROM h.conv_id
"""

QUERIES = {"op12_turn_repair": op12_turn_repair}
ORACLES = {"op12_turn_repair": OP12_SQL}
