"""Quotation linking: messages that quote others become reply-ordered conversations.

1. Each message's lines are parsed into a quote level (the number of leading ``>``) and
   content.  A line's normal form is lower-cased with runs of white space made one blank;
   a maximal run of lines of one level is a passage, and its normal form joins its lines.
2. Own (level 0) lines and passages are hashed, and each hash keeps its earliest message
   per conversation and over all conversations: one row a hash, however often it is used.
3. Quoted lines and passages are joined to those originals: to an earlier turn of the same
   conversation first, else to an earlier (conversation, turn) elsewhere.  A message's
   parent is the original named by most of its outermost quotes; without one it answers
   the turn before it in its conversation.
4. A run of messages that answer the turn before them hangs on the run's first message.
   Only those first messages - they quote, or begin a thread - are followed further, by
   pointer doubling: parents always come earlier, so the rounds grow with the logarithm
   of the number of quotes on a path, and a round handles only what is not settled yet.

Rows sorted by (thread, depth, conversation, turn) are the conversations in reply order:
a message follows what it answers.  Their text has no quoted lines.

Defined results: null and empty texts have no lines and stay empty; a message without a
conversation or turn is a thread of its own, not linked; rows that repeat a (conversation,
turn) are one message with several texts (quotes of all of them vote) and come out row by
row; votes that tie go to the same conversation, then the later turn, then the smaller
conversation; an empty table gives no rows.  Other columns than the named ones are dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hopweave.llm.common import stage

_MARKS = r"^(?:[ \t]*>)+"


def parsed_lines(text: Column) -> Column:
    """array<struct<level, content>> of a text's lines."""
    return F.transform(F.split(F.coalesce(text, F.lit("")), r"\r?\n"), lambda x: F.struct(
        F.length(F.regexp_replace(F.regexp_extract(x, _MARKS, 0), "[ \t]", "")).cast("int").alias("level"),
        F.regexp_replace(x, _MARKS, "").alias("content")))


def normal(x: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(x, r"\s+", " ")))


def without_quotes(lines: Column) -> Column:
    """The unquoted lines, without the blank lines that quotes leave at the ends."""
    own = F.transform(F.filter(lines, lambda x: x["level"] == 0), lambda x: x["content"])
    return F.regexp_replace(F.array_join(own, "\n"), r"^\n+|\s+$", "")


def _units(lines: Column) -> Column:
    """array<struct<level, h>>: hashes of a message's lines and passages (empty ones left out)."""
    n = F.size(lines)
    line = F.transform(lines, lambda x: F.struct(x["level"].alias("level"), normal(x["content"]).alias("s")))
    # a passage starts where the level changes; its lines are those up to the next change
    starts = F.filter(F.sequence(F.lit(0), n - 1), lambda i: (i == 0) | (F.get(lines, i)["level"] != F.get(lines, i - 1)["level"]))
    ends = F.concat(F.slice(starts, 2, F.greatest(F.size(starts) - 1, F.lit(0))), F.array(n))
    passage = F.zip_with(starts, ends, lambda a, b: F.struct(
        F.get(lines, a)["level"].alias("level"),
        normal(F.array_join(F.transform(F.slice(lines, a + 1, b - a), lambda x: x["content"]), " ")).alias("s")))
    return F.transform(F.filter(F.array_distinct(F.concat(line, passage)), lambda x: x["s"] != ""),
                       lambda x: F.struct(x["level"].alias("level"), F.xxhash64(x["s"]).alias("h")))


def parents(messages: DataFrame) -> DataFrame:
    """(conv, turn, p_conv, p_turn, by) of every message with a parent.

    ``messages``: (conv, turn, lines), both keys given.
    """
    units = messages.select("conv", "turn", F.explode(_units(F.col("lines"))).alias("u")).select("conv", "turn", "u.level", "u.h")
    own = units.where("level = 0")
    here = own.groupBy("conv", "h").agg(F.min("turn").alias("here_turn"))
    anywhere = own.groupBy("h").agg(F.min(F.struct("conv", "turn")).alias("first"))
    # the outermost quotes: the smallest quoted level of the message
    quoted = units.where("level > 0")
    outer = quoted.groupBy("conv", "turn").agg(F.min("level").alias("outer"))
    quoted = quoted.join(outer, ["conv", "turn"]).where("level = outer").select("conv", "turn", "h")
    found = quoted.join(here, ["conv", "h"], "left").join(anywhere, "h", "left")
    earlier_here = F.col("here_turn") < F.col("turn")
    first = F.col("first")
    elsewhere = (first["conv"] < F.col("conv")) | ((first["conv"] == F.col("conv")) & (first["turn"] < F.col("turn")))
    target = F.when(earlier_here, F.struct(F.col("conv").alias("p_conv"), F.col("here_turn").alias("p_turn"))) \
        .when(elsewhere, F.struct(first["conv"].alias("p_conv"), first["turn"].alias("p_turn")))
    votes = found.withColumn("target", target).where("target is not null").groupBy("conv", "turn", "target").agg(F.count(F.lit(1)).alias("votes"))
    best = votes.groupBy("conv", "turn").agg(F.max(F.struct(
        "votes", (F.col("target.p_conv") == F.col("conv")).alias("same"), F.col("target.p_turn").alias("p_turn"), (-F.col("target.p_conv")).alias("minus"))).alias("b")) \
        .select("conv", "turn", (-F.col("b.minus")).alias("q_conv"), F.col("b.p_turn").alias("q_turn"))
    keys = messages.select("conv", "turn").distinct()
    before = keys.withColumn("last_turn", F.lag("turn").over(Window.partitionBy("conv").orderBy("turn")))
    return before.join(best, ["conv", "turn"], "left").select(
        "conv", "turn", F.when(F.col("q_conv").isNotNull(), F.col("q_conv")).when(F.col("last_turn").isNotNull(), F.col("conv")).alias("p_conv"),
        F.coalesce("q_turn", "last_turn").alias("p_turn"),
        F.when(F.col("q_conv").isNotNull(), "quote").when(F.col("last_turn").isNotNull(), "turn").alias("by"))


def threads(links: DataFrame) -> DataFrame:
    """(conv, turn, root, depth) of every message: its thread's first message, and the steps to it."""
    run = Window.partitionBy("conv").orderBy("turn")
    head = F.coalesce(F.col("by"), F.lit("")) != "turn"
    placed = links.withColumn("_n", F.row_number().over(run)) \
        .withColumn("_head", F.max(F.when(head, F.struct("turn", "_n"))).over(run.rowsBetween(Window.unboundedPreceding, 0)))
    placed = stage(placed.select("conv", "turn", "p_conv", "p_turn", "by", F.col("_head.turn").alias("head"), (F.col("_n") - F.col("_head._n")).alias("steps")), "runs")
    heads = placed.where(F.col("turn") == F.col("head"))
    key = lambda c, t: F.struct(F.col(c).alias("c"), F.col(t).alias("t"))
    settled = heads.where("p_conv is null").select(key("conv", "turn").alias("at"), key("conv", "turn").alias("up"), F.lit(0).cast("long").alias("depth"))
    above = placed.select(F.col("conv").alias("p_conv"), F.col("turn").alias("p_turn"), key("conv", "head").alias("up"), (F.col("steps") + 1).alias("depth"))
    active = stage(heads.where("p_conv is not null").join(above, ["p_conv", "p_turn"])
                   .select(key("conv", "turn").alias("at"), "up", F.col("depth").cast("long").alias("depth")), "thread-heads")
    while not active.isEmpty():
        # what a row points at either begins a thread, or points further
        far = settled.unionByName(active).select(F.col("at").alias("up"), F.col("up").alias("far"), F.col("depth").alias("more"))
        moved = stage(active.join(far, "up").select("at", F.when(F.col("more") == 0, F.col("up")).otherwise(F.col("far")).alias("up"),
                                                    (F.col("depth") + F.col("more")).alias("depth"), (F.col("more") == 0).alias("done")), "thread-heads")
        settled = settled.unionByName(moved.where("done").drop("done"))
        active = moved.where("not done").drop("done")
    roots = settled.select(F.col("at.c").alias("conv"), F.col("at.t").alias("head"), F.col("up").alias("root"), "depth")
    return placed.join(roots, ["conv", "head"]).select("conv", "turn", F.struct(F.col("root.c").alias("p_conv"), F.col("root.t").alias("p_turn")).alias("root"),
                                                       (F.col("depth") + F.col("steps")).alias("depth"))


def link_quotes(messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Every row with its parent, thread and depth, and its text without quotes."""
    rows = messages.select(F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).cast("long").alias("turn"), F.col(role_col).alias("role"),
                           F.coalesce(text_col, F.lit("")).alias("whole"), parsed_lines(F.col(text_col)).alias("lines"))
    keyed = rows.where("conv is not null and turn is not null")
    links = stage(parents(keyed), "reply-links")
    placed = links.join(threads(links), ["conv", "turn"])
    out = rows.join(placed, ["conv", "turn"], "left")
    return out.select(
        F.col("conv").alias("conv_id"), "turn", "role", F.col("p_conv").alias("parent_conv"), F.col("p_turn").alias("parent_turn"),
        F.col("by").alias("linked_by"), F.coalesce("root.p_conv", "conv").alias("thread_conv"), F.coalesce("root.p_turn", "turn").alias("thread_turn"),
        F.coalesce("depth", F.lit(0)).cast("long").alias("depth"),
        F.size(F.filter("lines", lambda x: x["level"] > 0)).cast("long").alias("n_quoted_lines"),
        F.array_max(F.transform("lines", lambda x: x["level"])).cast("long").alias("quote_levels"),
        F.when(F.exists("lines", lambda x: x["level"] > 0), without_quotes(F.col("lines"))).otherwise(F.col("whole")).alias("text"))


ORACLE = r"""
WITH RECURSIVE m AS (SELECT conv_id AS c, turn AS t, role, coalesce(text, '') AS whole, string_split_regex(coalesce(text, ''), '\r?\n') AS ls FROM conversations),
x AS (SELECT c, t, i, ls[i] AS l FROM (SELECT c, t, ls, unnest(range(1, len(ls) + 1)) AS i FROM m)),
y AS (SELECT c, t, i, length(regexp_replace(regexp_extract(l, '^(?:[ \t]*>)+'), '[ \t]', '', 'g')) AS lv, regexp_replace(l, '^(?:[ \t]*>)+', '') AS s FROM x),
z AS (SELECT *, i - row_number() OVER (PARTITION BY c, t, lv ORDER BY i) AS run FROM y),
raw AS (SELECT c, t, lv, s FROM y UNION ALL SELECT c, t, lv, string_agg(s, ' ' ORDER BY i) FROM z GROUP BY c, t, lv, run),
u AS (SELECT DISTINCT c, t, lv, lower(trim(regexp_replace(s, '\s+', ' ', 'g'))) AS s FROM raw WHERE trim(regexp_replace(s, '\s+', ' ', 'g')) <> ''),
here AS (SELECT c, s, min(t) AS ht FROM u WHERE lv = 0 GROUP BY c, s),
anyw AS (SELECT s, c AS ac, t AS a_t FROM u WHERE lv = 0 QUALIFY row_number() OVER (PARTITION BY s ORDER BY c, t) = 1),
q AS (SELECT c, t, s FROM u WHERE lv > 0 QUALIFY lv = min(lv) OVER (PARTITION BY c, t)),
f AS (SELECT q.c, q.t, CASE WHEN ht < q.t THEN q.c WHEN (ac, a_t) < (q.c, q.t) THEN ac END AS pc, CASE WHEN ht < q.t THEN ht WHEN (ac, a_t) < (q.c, q.t) THEN a_t END AS pt
  FROM q LEFT JOIN here ON here.c = q.c AND here.s = q.s LEFT JOIN anyw ON anyw.s = q.s),
b AS (SELECT c, t, pc, pt FROM (SELECT c, t, pc, pt, count(*) AS v FROM f WHERE pc IS NOT NULL GROUP BY ALL)
  QUALIFY row_number() OVER (PARTITION BY c, t ORDER BY v DESC, pc = c DESC, pt DESC, pc) = 1),
l AS (SELECT k.c, k.t, coalesce(b.pc, CASE WHEN k.lt IS NOT NULL THEN k.c END) AS pc, coalesce(b.pt, k.lt) AS pt,
  CASE WHEN b.pc IS NOT NULL THEN 'quote' WHEN k.lt IS NOT NULL THEN 'turn' END AS how
  FROM (SELECT c, t, lag(t) OVER (PARTITION BY c ORDER BY t) AS lt FROM m) k LEFT JOIN b ON b.c = k.c AND b.t = k.t),
r AS (SELECT c, t, c AS rc, t AS rt, 0 AS d FROM l WHERE pc IS NULL
  UNION ALL SELECT l.c, l.t, r.rc, r.rt, r.d + 1 FROM l JOIN r ON l.pc = r.c AND l.pt = r.t),
n AS (SELECT c, t, count(*) FILTER (lv > 0) AS nq, max(lv) AS top, string_agg(s, chr(10) ORDER BY i) FILTER (lv = 0) AS own FROM y GROUP BY c, t)
SELECT m.c AS conv_id, m.t AS turn, m.role, l.pc AS parent_conv, l.pt AS parent_turn, l.how AS linked_by, r.rc AS thread_conv, r.rt AS thread_turn,
  CAST(r.d AS BIGINT) AS depth, CAST(n.nq AS BIGINT) AS n_quoted_lines, CAST(n.top AS BIGINT) AS quote_levels,
  CASE WHEN n.nq = 0 THEN m.whole ELSE regexp_replace(coalesce(n.own, ''), '^\n+|\s+$', '', 'g') END AS text
FROM m JOIN l ON l.c = m.c AND l.t = m.t JOIN r ON r.c = m.c AND r.t = m.t JOIN n ON n.c = m.c AND n.t = m.t
"""
