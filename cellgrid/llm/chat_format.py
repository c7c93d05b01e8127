"""Chat formatting into training windows of a token budget.

Turn tokens are summed along each conversation.  The running sum cuts it into turn-aligned spans: spans are blocks
of half the content budget, a turn belongs to the block in which it starts, and a turn that is longer than half the
budget is a span by itself.  So a span never exceeds the content budget unless it is one single turn.  Each span becomes a
window: the system turn (if the conversation starts with one), then the last turns of the span before, as far as
``history`` tokens reach, then the span.  Only assistant turns of the span itself count for the loss; repeated turns are
masked.

Running sums are built in two steps, over runs of turns and over the sums of these runs, and a window gathers only its
own turns, so that no task has to hold a long conversation.

Template: ``<s>[INST]role[/INST]text</s>``.  In roles and texts every ``<``, ``[`` and backslash is followed by an added
backslash, so no control string can appear inside, and ``unescape`` restores the text exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUDGET = 1024
HISTORY = 128
RUN = 256
OPEN, MID, CLOSE = "<s>[INST]", "[/INST]", "</s>"
#: tokens: runs of letters or digits, and every other character that is no white space
_TOKEN = r"[A-Za-z0-9]+|[^A-Za-z0-9 \t\r\n]"
#: the template's own tokens, per turn
OVERHEAD = 4


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[\\])", r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[\\])\\", "$1")


def turn_tokens(text: Column) -> Column:
    return (F.regexp_count(text, F.lit(_TOKEN)) + OVERHEAD).cast("long")


def _ordered_turns(conversations: DataFrame, id_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    c = lambda n: F.col(f"`{n}`")
    return conversations.select(
        c(id_col).alias("conv_id"), c(turn_col).alias("turn"), F.coalesce(c(role_col), F.lit("")).alias("role"),
        F.coalesce(c(text_col), F.lit("")).alias("text")).withColumn("tokens", turn_tokens(F.col("text")))


def spans(turns: DataFrame, budget: int, history: int) -> DataFrame:
    """Adds ``start`` (tokens before the turn), ``span_start`` and ``span_end`` (token positions of the turn's span).

    Turns are ordered by turn (nulls first), then role, then text.
    """
    half = (budget - history) // 2
    order = ["turn", "role", "text"]
    # runs: turns whose number falls in the same RUN; equal numbers stay together
    run = F.coalesce(F.floor(F.col("turn") / RUN), F.lit(-(1 << 62))).cast("long")
    big = (F.col("tokens") > half).cast("long")
    w = Window.partitionBy("conv_id", "run").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = (turns.withColumns({"run": run, "big": big})
             .withColumns({"before": F.coalesce(F.sum("tokens").over(w), F.lit(0)),
                           "bigs": F.coalesce(F.sum("big").over(w), F.lit(0))}))
    v = Window.partitionBy("conv_id").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    sums = turns.withColumns({"run": run, "big": big}).groupBy("conv_id", "run").agg(F.sum("tokens").alias("t"), F.sum("big").alias("b"))
    offsets = sums.select(F.col("conv_id").alias("c"), F.col("run").alias("r"), F.coalesce(F.sum("t").over(v), F.lit(0)).alias("t0"),
                          F.coalesce(F.sum("b").over(v), F.lit(0)).alias("b0"))
    placed = (local.join(offsets, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("run") == F.col("r")))
              .withColumns({"start": F.col("before") + F.col("t0"), "bigs": F.col("bigs") + F.col("b0")}))
    block = F.floor(F.col("start") / half)
    one = Window.partitionBy("conv_id", "bigs", "big", "block")
    # a span holds at most `budget` tokens or one turn, so this window stays small
    return (placed.withColumn("block", F.when(F.col("big") == 1, F.lit(-1)).otherwise(block))
            .withColumns({"span_start": F.min("start").over(one), "span_end": F.max(F.col("start") + F.col("tokens")).over(one)})
            .select("conv_id", "turn", "role", "text", "tokens", "start", "span_start", "span_end"))


def format_windows(conversations: DataFrame, budget: int = BUDGET, history: int = HISTORY, id_col: str = "conv_id",
                   turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per window: conv_id, window_start, formatted, n_repeated, n_tokens, loss (array of (start, length) in
    characters of ``formatted``).

    ``n_repeated`` turns at the head (system turn and history) repeat earlier windows.  Null roles and texts are empty, a
    null conv_id is one conversation of its own, equal rows are separate turns, and a conversation of one empty turn still
    makes a window.  Other columns are not read.  A single turn over the budget is kept whole in a window of its own.
    """
    placed = spans(_ordered_turns(conversations, id_col, turn_col, role_col, text_col), budget, history)
    piece = F.concat(F.lit(OPEN), escape(F.col("role")), F.lit(MID), escape(F.col("text")), F.lit(CLOSE))
    head = F.length(F.concat(F.lit(OPEN), escape(F.col("role")), F.lit(MID)))
    rows = placed.withColumns({"piece": piece, "head": head})
    new = F.struct(F.col("span_start").alias("window_start"), F.lit(True).alias("new"))
    again = F.struct(F.col("span_end").alias("window_start"), F.lit(False).alias("new"))
    targets = F.when(F.col("span_end") - F.col("start") <= history, F.array(new, again)).otherwise(F.array(new))
    member = F.struct("start", "new", "role", "piece", "head", "tokens").alias("m")
    windows = (rows.withColumn("to", F.explode(targets)).select("*", "to.*")
               .groupBy("conv_id", "window_start").agg(F.array_sort(F.collect_list(member)).alias("m"))
               .filter(F.exists("m", lambda x: x["new"])))  # the turns after the last span start no window
    first = (rows.filter((F.col("start") == 0) & (F.col("role") == "system"))
             .select(F.col("conv_id").alias("c"), F.array(F.struct(
                 "start", F.lit(False).alias("new"), "role", "piece", "head", "tokens")).alias("system")))
    # windows that begin later repeat the system turn, unless it is already among their history
    joined = windows.join(first, F.col("conv_id").eqNullSafe(F.col("c")), "left")
    lead = F.col("system").isNotNull() & (F.col("m")[0]["start"] > 0)
    full = joined.select("conv_id", "window_start", F.when(lead, F.concat("system", "m")).otherwise(F.col("m")).alias("m"))
    return full.select(
        "conv_id", "window_start",
        F.array_join(F.transform("m", lambda x: x["piece"]), "").alias("formatted"),
        F.size(F.filter("m", lambda x: ~x["new"])).cast("long").alias("n_repeated"),
        F.aggregate("m", F.lit(0).cast("long"), lambda a, x: a + x["tokens"]).alias("n_tokens"),
        loss_spans(F.col("m")).alias("loss"))


def loss_spans(members: Column) -> Column:
    """(start, length) of the text of each new assistant turn, in characters of the joined pieces."""
    empty = F.struct(F.lit(0).cast("int").alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("out"))
    span = lambda a, x: F.struct((a["at"] + x["head"]).cast("int").alias("start"),
                                 (F.length(x["piece"]) - x["head"] - len(CLOSE)).cast("int").alias("length"))
    return F.aggregate(
        members, empty,
        lambda a, x: F.struct(
            (a["at"] + F.length(x["piece"])).cast("int").alias("at"),
            F.when(x["new"] & (x["role"] == "assistant"), F.array_append(a["out"], span(a, x))).otherwise(a["out"]).alias("out")),
        lambda a: a["out"])


def read_back(windows: DataFrame) -> DataFrame:
    """Per conversation, from the windows alone: its turns in order, the texts under the loss mask, formatted characters."""
    turn = F.transform(
        F.filter(F.split("formatted", CLOSE, -1), lambda x: x != ""),
        lambda x: F.struct(unescape(F.substring_index(F.substring(x, F.lit(len(OPEN) + 1), F.length(x)), MID, 1)).alias("role"),
                           unescape(F.substring(x, F.instr(x, MID) + len(MID), F.length(x))).alias("text")))
    w = windows.select(
        "conv_id", "window_start", F.length("formatted").cast("long").alias("chars"),
        F.slice(turn, F.col("n_repeated").cast("int") + 1, F.size(turn)).alias("turns"),
        F.transform("loss", lambda s: unescape(F.substring(F.col("formatted"), s["start"] + 1, s["length"]))).alias("targets"))
    return w.groupBy("conv_id").agg(
        F.sum("chars").alias("formatted_chars"),
        F.array_sort(F.collect_list(F.struct("window_start", "turns", "targets"))).alias("w")).select(
        "conv_id", "formatted_chars", F.flatten(F.transform("w", lambda x: x["turns"])).alias("turns"),
        F.flatten(F.transform("w", lambda x: x["targets"])).alias("targets"))


def report(conversations: DataFrame, **options) -> DataFrame:
    """Digests of what the windows hold, one row per conversation."""
    r = read_back(format_windows(conversations, **options))
    loss = F.array_join("targets", "")
    return r.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256)
        .alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"), "formatted_chars")


#: fixed value: the conversation that the query adds, whose texts are made of control strings
PLANTED = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]

_HALF = (BUDGET - HISTORY) // 2
_TEMPLATE = len(OPEN) + len(MID) + len(CLOSE)
ORACLE_SQL = rf"""
WITH turn AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
              UNION ALL VALUES {', '.join(f"({a}, {b}, '{r}', '{t}')" for a, b, r, t in PLANTED)}),
t AS (SELECT *, len(regexp_extract_all(text, '[A-Za-z0-9]+|[^A-Za-z0-9 \t\r\n]')) + {OVERHEAD} AS tokens,
             length(role) + length(regexp_replace(role, '[^<\[\\]', '', 'g')) + length(text)
             + length(regexp_replace(text, '[^<\[\\]', '', 'g')) + {_TEMPLATE} AS chars,
             row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS k FROM turn),
p AS (SELECT *, sum(tokens) OVER w - tokens AS start, sum(CASE WHEN tokens > {_HALF} THEN 1 ELSE 0 END) OVER w
             - CASE WHEN tokens > {_HALF} THEN 1 ELSE 0 END AS bigs FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY k)),
b AS (SELECT *, CASE WHEN tokens > {_HALF} THEN -1 ELSE start // {_HALF} END AS block FROM p),
s AS (SELECT *, min(start) OVER o AS span_start, max(start + tokens) OVER o AS span_end, max(start + tokens) OVER (PARTITION BY conv_id) AS total
      FROM b WINDOW o AS (PARTITION BY conv_id, bigs, tokens > {_HALF}, block)),
repeated AS (SELECT conv_id, chars, span_end AS at, start FROM s WHERE span_end - start <= {HISTORY} AND span_end < total),
lead AS (SELECT conv_id, chars FROM s WHERE start = 0 AND role = 'system'),
window_at AS (SELECT DISTINCT conv_id, span_start AS at FROM s WHERE span_start > 0),
systems AS (SELECT w.conv_id, l.chars FROM window_at w JOIN lead l USING (conv_id)
            WHERE NOT EXISTS (SELECT 1 FROM repeated r WHERE r.conv_id = w.conv_id AND r.at = w.at AND r.start = 0)),
extra AS (SELECT conv_id, sum(chars) AS more FROM (SELECT conv_id, chars FROM repeated UNION ALL SELECT conv_id, chars FROM systems) GROUP BY conv_id)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       (sum(chars) + coalesce(max(more), 0))::BIGINT AS formatted_chars
FROM s LEFT JOIN extra USING (conv_id) GROUP BY conv_id
"""


def planted(conversations: DataFrame) -> DataFrame:
    """``conversations`` and the conversation of control strings."""
    rows = F.array(*[F.struct(F.lit(a).cast("long").alias("conv_id"), F.lit(b).cast("long").alias("turn"), F.lit(r).alias("role"),
                              F.lit(t).alias("text")) for a, b, r, t in PLANTED])
    extra = conversations.sparkSession.range(1).select(F.inline(rows))
    return conversations.select("conv_id", "turn", "role", "text").unionByName(extra)
