"""Conversations rebuilt from quotations. DataFrame functions only.

A line's quote level is the number of ``>`` marks that it starts with. Every quoted line is
a passage: its text, lower-cased and with white space folded, is hashed and joined to the
earliest message of the conversation that says it as its own line. A message replies to the
message that most of its first-level passages come from (ties: the latest of them). Replies
hang below what they answer; messages that quote nothing known stand at the top in turn
order. ``reply_path`` (turns from the top message down, zero-padded; a negative turn as ``-`` and
its distance from the least long, so that it stands before all others in order) sorts a conversation into
reply order; ``text`` is what the message itself says, without quotes and their headings.

Passages are joined to one earliest original each, so a line that is often said or often
quoted makes no pairs beyond its quotations.

Defined results: a null text counts as empty; rows with a null ``conv_id`` or ``turn`` link to
nothing and keep their text; rows that repeat (conv_id, turn) are each kept, and are one
message to those that quote them; an empty table gives no rows.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import staged

MARKS = r"^[ \t]*(?:>[ \t]*)+"
HEADING = r"^(?:On .*|.*) (?:wrote|writes|said):[ \t]*$"
WIDTH = 20            # characters of a turn within a path: a sign and 19 digits


def _level(line: Column) -> Column:
    return F.length(F.regexp_replace(F.regexp_extract(line, MARKS, 0), "[^>]", ""))


def _folded(body: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(body), r"[ \t ]+", " "))


def parsed(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, role, lines, own, quoted): lines as structs (level, body)."""
    rows = messages.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                           F.col("role").cast("string").alias("role"),
                           F.split(F.coalesce(F.col("text").cast("string"), F.lit("")), r"\r?\n").alias("raw"))
    lines = F.transform("raw", lambda x: F.struct(_level(x).alias("level"), F.regexp_replace(x, MARKS, "").alias("body")))
    rows = rows.select("conv_id", "turn", "role", lines.alias("lines"))
    heading = lambda x, i: (
        x["body"].rlike(HEADING) & (F.coalesce(F.get("lines", i + 1)["level"], F.lit(0)) > x["level"]))
    own = F.filter("lines", lambda x, i: (x["level"] == 0) & ~heading(x, i))
    return (rows.withColumn("own", F.transform(own, lambda x: x["body"]))
            .withColumn("quoted", F.filter("lines", lambda x: (x["level"] > 0) & (_folded(x["body"]) != ""))))


def _parents(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, parent_turn, linked_lines) of messages that quote a known line."""
    keyed = rows.where("conv_id IS NOT NULL AND turn IS NOT NULL")
    hashed = lambda c: F.xxhash64(_folded(c))
    quotes = (keyed.select("conv_id", "turn", F.explode("quoted").alias("q"))
              .select("conv_id", "turn", F.col("q.level").alias("level"), hashed(F.col("q.body")).alias("hash")))
    said = (keyed.select("conv_id", "turn", F.explode("own").alias("body"))
            .where(_folded(F.col("body")) != "")
            .groupBy("conv_id", hashed(F.col("body")).alias("hash")).agg(F.min("turn").alias("origin")))
    met = quotes.join(said, ["conv_id", "hash"]).where("origin < turn")
    by_origin = (met.groupBy("conv_id", "turn", "origin")
                 .agg(F.count_if(F.col("level") == 1).alias("direct"), F.count("*").alias("all")))
    return (by_origin.groupBy("conv_id", "turn")
            .agg(F.max_by("origin", F.struct("direct", "all", "origin")).alias("parent_turn"),
                 F.sum("all").alias("linked_lines")))


def _padded(turn: Column) -> Column:
    below = F.concat(F.lit("-"), F.lpad((turn.cast("decimal(20,0)") + F.lit(Decimal(2 ** 63))).cast("string"), WIDTH - 1, "0"))
    return F.when(turn < 0, below).otherwise(F.lpad(turn.cast("string"), WIDTH, "0"))


def _paths(parents: DataFrame) -> DataFrame:
    """(conv_id, turn, path, depth) of replying messages, by doubling the known ancestry.

    A row knows its ``steps`` nearest ancestors, ``top`` being the farthest; rows whose top
    replies to something themselves take over what the top knows.
    """
    known = staged(parents.select("conv_id", "turn", F.col("parent_turn").alias("top"),
                                  F.concat(_padded(F.col("parent_turn")), F.lit("/"), _padded(F.col("turn"))).alias("path"),
                                  F.lit(1).alias("depth")))
    while True:
        above = known.select("conv_id", F.col("turn").alias("top"), F.col("top").alias("top_2"),
                             F.col("path").alias("path_2"), F.col("depth").alias("depth_2"))
        joined = known.join(above, ["conv_id", "top"], "left")
        grown = staged(joined.select(
            "conv_id", "turn", F.coalesce("top_2", "top").alias("top"),
            F.when(F.col("path_2").isNotNull(),
                   F.concat("path_2", F.substring("path", WIDTH + 1, 2 ** 31 - 1))).otherwise(F.col("path")).alias("path"),
            (F.col("depth") + F.coalesce("depth_2", F.lit(0))).alias("depth"),
            F.col("top_2").isNotNull().alias("grew")))
        known = grown.drop("grew")
        if grown.where("grew").isEmpty():
            return known


def threads(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, role, parent_turn, depth, reply_path, quoted_lines, linked_lines, text)."""
    rows = parsed(messages)
    parents = staged(_parents(rows))
    paths = _paths(parents).select("conv_id", "turn", "path", "depth")
    linked = parents.join(paths, ["conv_id", "turn"])
    out = rows.select("conv_id", "turn", "role", F.size("quoted").cast("long").alias("quoted_lines"),
                      F.regexp_replace(F.array_join("own", "\n"), r"^[ \t\n]+|[ \t\n]+$", "").alias("text"))
    return (out.join(linked, ["conv_id", "turn"], "left")
            .select("conv_id", "turn", "role", "parent_turn", F.coalesce("depth", F.lit(0)).alias("depth"),
                    F.coalesce("path", _padded(F.col("turn"))).alias("reply_path"), "quoted_lines",
                    F.coalesce("linked_lines", F.lit(0).cast("long")).alias("linked_lines"), "text"))


THREADS_SQL = r"""
    WITH RECURSIVE l AS (
        SELECT conv_id::BIGINT AS conv_id, turn::BIGINT AS turn, role, rid, generate_subscripts(raw, 1) AS i, unnest(raw) AS line
        FROM (SELECT *, row_number() OVER () AS rid, string_split_regex(coalesce(text, ''), '\r?\n') AS raw FROM conversations)),
    p AS (
        SELECT *, length(regexp_replace(regexp_extract(line, '^[ \t]*(?:>[ \t]*)+'), '[^>]', '', 'g')) AS level,
               regexp_replace(line, '^[ \t]*(?:>[ \t]*)+', '') AS body FROM l),
    f AS (
        SELECT *, trim(regexp_replace(lower(body), '[ \t\x{00a0}]+', ' ', 'g')) AS folded,
               level = 0 AND NOT (regexp_matches(body, '^(?:On .*|.*) (?:wrote|writes|said):[ \t]*$')
                   AND coalesce(lead(level) OVER (PARTITION BY rid ORDER BY i), 0) > level) AS own FROM p),
    said AS (
        SELECT conv_id, folded, min(turn) AS origin FROM f
        WHERE own AND folded <> '' AND conv_id IS NOT NULL AND turn IS NOT NULL GROUP BY ALL),
    met AS (
        SELECT f.conv_id, f.turn, s.origin, count(*) FILTER (level = 1) AS direct, count(*) AS n
        FROM f JOIN said s ON f.conv_id = s.conv_id AND f.folded = s.folded
        WHERE level > 0 AND f.folded <> '' AND origin < turn GROUP BY ALL),
    parents AS (
        SELECT conv_id, turn, arg_max(origin, (direct, n, origin)) AS parent_turn, sum(n)::BIGINT AS linked_lines
        FROM met GROUP BY ALL),
    paths AS (
        SELECT p.conv_id, p.turn, 1 AS depth, @parent_turn || '/' || @p.turn AS path
        FROM parents p WHERE NOT EXISTS (SELECT 1 FROM parents q WHERE q.conv_id = p.conv_id AND q.turn = p.parent_turn)
        UNION ALL
        SELECT p.conv_id, p.turn, t.depth + 1, t.path || '/' || @p.turn
        FROM parents p JOIN paths t ON p.conv_id = t.conv_id AND p.parent_turn = t.turn),
    m AS (
        SELECT rid, conv_id, turn, role, count(*) FILTER (level > 0 AND folded <> '') AS quoted_lines,
               regexp_replace(coalesce(string_agg(body, chr(10) ORDER BY i) FILTER (own), ''), '^[ \t\n]+|[ \t\n]+$', '', 'g') AS text
        FROM f GROUP BY ALL)
    SELECT m.conv_id, m.turn, m.role, q.parent_turn, coalesce(t.depth, 0)::INTEGER AS depth,
           coalesce(t.path, @m.turn) AS reply_path, m.quoted_lines,
           coalesce(q.linked_lines, 0) AS linked_lines, m.text
    FROM m LEFT JOIN parents q ON m.conv_id = q.conv_id AND m.turn = q.turn
           LEFT JOIN paths t ON m.conv_id = t.conv_id AND m.turn = t.turn"""
# @turn stands for a turn as a path holds it
for _turn in ("parent_turn", "p.turn", "m.turn"):
    THREADS_SQL = THREADS_SQL.replace(f"@{_turn}", f"""(CASE WHEN {_turn} < 0
        THEN '-' || lpad(({_turn}::HUGEINT + 9223372036854775808)::VARCHAR, 19, '0') ELSE lpad({_turn}::VARCHAR, 20, '0') END)""")
