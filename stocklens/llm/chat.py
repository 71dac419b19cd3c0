"""Chat formatting in budgeted, turn-aligned windows, with DataFrame functions only.

Template: ``<turn>role``, a line break, the text, ``</turn>`` and a line break. In roles and texts
a backslash becomes ``\\b``, ``<`` becomes ``\\l`` and ``#`` becomes ``\\h`` (in roles a line break
becomes ``\\n``), so neither a turn mark nor a ``###`` heading can come out of a text, and reading
back reverses each pair.

Windows: tokens are counted per turn (words, and one for the turn) and summed along the conversation.
A window holds the longest run of whole new turns that fits the budget together with what it
repeats: the leading system turn, and ahead of its first new turn as many whole earlier turns as
``history`` tokens hold. No turn is ever cut. Above the budget are only windows of one new turn
that is longer than the room (these repeat no history), and those of a system turn that takes over
three quarters of the budget, which leaves a quarter to the others. Repeated turns carry no loss, so
each assistant text is a target once.

The prefix sums are taken over turns dealt by range, so a conversation of any length is spread over
tasks. It is cut into segments at every ``segment`` budgets of tokens, where a window ends too;
spans are chosen within a segment, which holds at most that many turns. History reaches back across
the cut. Only the digest query joins a conversation's texts in one value, since a digest is over
all of them: a conversation of more than 2 GB can be formatted, but not digested.

Nulls and ties: a null text is empty, a null role is empty; turns with equal numbers follow role and
text, null turns come first; repeated rows are turns of their own. Rows with a null conv_id form
one conversation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stocklens.llm.common import WORD, numbered, staged, table

BUDGET, HISTORY, SEGMENT = 512, 128, 32
OPEN, CLOSE = "<turn>", "</turn>\n"
ASSISTANT, SYSTEM = "assistant", "system"


def escape(text: Column) -> Column:
    for raw, safe in (("\\", "\\b"), ("<", "\\l"), ("#", "\\h")):
        text = F.replace(text, F.lit(raw), F.lit(safe))
    return text


def unescape(text: Column) -> Column:
    for raw, safe in (("<", "\\l"), ("#", "\\h"), ("\\", "\\b")):
        text = F.replace(text, F.lit(safe), F.lit(raw))
    return text


def _fields() -> tuple[Column, Column, Column]:
    head = F.concat(F.lit(OPEN), F.replace(escape(F.col("role")), F.lit("\n"), F.lit("\\n")), F.lit("\n"))
    body = escape(F.col("text"))
    return head, body, F.concat(head, body, F.lit(CLOSE))


def _segments(conversations: DataFrame, budget: int, history: int, segment: int) -> DataFrame:
    """One row per conversation and segment: its turns in order, with those of the last one that its history may reach, and the system turn."""
    reach = segment * budget
    turns = conversations.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).withColumn(
        "_tokens", (F.regexp_count("text", F.lit(WORD)) + 1).cast("long"))
    head, body, whole = _fields()
    own = staged(numbered(turns, [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")], "chat-turns", ["conv_id"], "_tokens").select(
        "conv_id", F.floor(F.col("_before") / reach).cast("long").alias("_segment"), "_before", "_tokens",
        (F.col("_rank") - 1).alias("_n"), F.lit(True).alias("_new"), (F.col("role") == ASSISTANT).alias("_target"),
        ((F.col("_rank") == 1) & (F.col("role") == SYSTEM)).alias("_leading"),
        F.length(head).alias("_head"), F.length(body).alias("_body"), whole.alias("_whole")), "chat-numbered")
    late = own.where(~F.col("_leading") & (F.col("_before") >= (F.col("_segment") + 1) * reach - history))
    late = late.withColumns({"_segment": F.col("_segment") + 1, "_new": F.lit(False)})
    turn = F.struct(*own.columns[2:])
    system = own.where("_leading").select(F.col("conv_id").alias("_conv"), F.col("_tokens").alias("tokens"), F.col("_whole").alias("whole"))
    # The system turn goes to each segment as a row of its own, so that no join is by conversation over all turns.
    system = own.select("conv_id", "_segment").distinct().join(system, F.col("conv_id").eqNullSafe(F.col("_conv"))).select(
        "conv_id", "_segment", F.lit(None).cast(own.select(turn.alias("t")).schema["t"].dataType).alias("_turn"), F.struct("tokens", "whole").alias("_system"))
    rows = own.unionAll(late).select("conv_id", "_segment", turn.alias("_turn"), F.lit(None).cast("struct<tokens:bigint,whole:string>").alias("_system"))
    return rows.unionAll(system).groupBy("conv_id", "_segment").agg(
        F.array_sort(F.collect_list("_turn")).alias("_turns"), F.first("_system", ignorenulls=True).alias("_system"))


def format_chat(conversations: DataFrame, budget: int = BUDGET, history: int = HISTORY, segment: int = SEGMENT) -> DataFrame:
    """One row per window: conv_id, first_turn, formatted, n_turns, n_tokens, repeated, spans.

    ``first_turn`` is the number (from 0) of its first new turn, ``repeated`` marks each of its
    ``n_turns`` turns that an earlier window held, ``n_tokens`` counts them all, and ``spans`` are
    the code points (start, length) of the texts that carry loss.
    """
    if not 0 <= history < budget - history:
        raise ValueError("history must be under half of the budget")
    zero = F.lit(0).cast("long")
    aside = F.coalesce("_system.tokens", zero)

    def follow(walk: Column, t: Column) -> Column:
        """Go on with the open window while the turn fits it, or open one at the turn, with its history."""
        room = F.when(t["_n"] == 0, F.lit(budget)).otherwise(F.greatest(budget - aside, F.lit(budget // 4)))
        back = F.greatest(F.least(F.lit(history), room - t["_tokens"]), F.lit(0))
        seen = F.filter("_turns", lambda u: (u["_before"] <= t["_before"]) & (u["_before"] >= t["_before"] - back)
                        & (~u["_leading"] | (u["_n"] == t["_n"])))
        since = F.get(seen, 0)["_before"]
        end = (since + F.greatest(room, t["_before"] - since + t["_tokens"])).cast("long")
        opened = F.struct(end.alias("end"), F.concat(walk["spans"], F.array(
            F.struct(t["_before"].alias("start"), since.alias("since")))).alias("spans"))
        return F.when(~t["_new"] | (t["_before"] + t["_tokens"] <= walk["end"]), walk).otherwise(opened)

    begin = F.struct(F.lit(-1).cast("long").alias("end"), F.array().cast("array<struct<start:bigint,since:bigint>>").alias("spans"))
    walked = _segments(conversations, budget, history, segment).withColumn("_walk", F.aggregate("_turns", begin, follow)["spans"])

    def window(span: Column, i: Column) -> Column:
        until = F.get("_walk", i + 1)["start"]
        held = F.filter("_turns", lambda u: (u["_before"] >= span["since"]) & (until.isNull() | (u["_before"] < until))
                        & (~u["_leading"] | (u["_before"] >= span["start"])))
        told = F.transform(held, lambda u: F.struct(
            u["_n"].alias("_n"), (u["_before"] < span["start"]).alias("again"), u["_target"].alias("_target"), u["_tokens"].alias("_tokens"),
            u["_head"].alias("_head"), u["_body"].alias("_body"), u["_whole"].alias("_whole")))
        kept = F.array(F.struct(zero.alias("_n"), F.lit(True).alias("again"), F.lit(False).alias("_target"), aside.alias("_tokens"),
                                F.length("_system.whole").alias("_head"), F.lit(0).alias("_body"), F.col("_system.whole").alias("_whole")))
        return F.when(F.col("_system").isNotNull() & (span["start"] > 0), F.concat(kept, told)).otherwise(told)

    windows = walked.select("conv_id", F.explode(F.transform("_walk", window)).alias("_turns"))
    lengths = F.transform("_turns", lambda t: F.length(t["_whole"]))
    # Start of each turn: a running sum over a window's few turns.
    windows = windows.withColumn("_starts", F.aggregate(
        lengths, F.array(F.lit(0)), lambda a, n: F.concat(a, F.array(F.element_at(a, -1) + n))))
    spans = F.filter(F.transform("_turns", lambda t, i: F.when(
        t["_target"] & ~t["again"],
        F.struct((F.get("_starts", i) + t["_head"]).alias("start"), t["_body"].alias("length")))), lambda s: s.isNotNull())
    return windows.select(
        "conv_id", F.element_at(F.filter("_turns", lambda t: ~t["again"]), 1)["_n"].alias("first_turn"),
        F.array_join(F.transform("_turns", lambda t: t["_whole"]), "").alias("formatted"), F.size("_turns").alias("n_turns"),
        F.aggregate("_turns", zero, lambda a, t: a + t["_tokens"]).alias("n_tokens"),
        F.transform("_turns", lambda t: t["again"]).alias("repeated"), spans.alias("spans"))


def read_turns(windows: DataFrame) -> DataFrame:
    """The new turns of formatted windows: conv_id, n (number in the conversation), role, text."""
    pieces = F.filter(F.split("formatted", CLOSE, -1), lambda p: p != "")
    told = F.zip_with(pieces, "repeated", lambda p, again: F.struct(p.alias("piece"), again.alias("again")))
    new = F.filter(told, lambda t: ~t["again"])
    rows = windows.select("conv_id", "first_turn", F.posexplode(new).alias("_i", "_t"))
    piece = F.substr(F.col("_t.piece"), F.lit(len(OPEN) + 1))
    cut = F.instr(piece, "\n")
    role = unescape(F.replace(F.substr(piece, F.lit(1), cut - 1), F.lit("\\n"), F.lit("\n")))
    return rows.select("conv_id", (F.col("first_turn") + F.col("_i")).alias("n"), role.alias("role"),
                       unescape(F.substr(piece, cut + 1)).alias("text"))


def read_targets(windows: DataFrame) -> DataFrame:
    """Per window the text under its loss mask: conv_id, first_turn, loss, formatted_chars."""
    loss = F.transform("spans", lambda s: unescape(F.substr(F.col("formatted"), s["start"] + 1, s["length"])))
    return windows.select("conv_id", "first_turn", F.array_join(loss, "").alias("loss"), F.length("formatted").alias("formatted_chars"))


def digests(windows: DataFrame) -> DataFrame:
    """Per conversation, read back from the windows: turns, their digest, loss text and its digest."""
    line = F.concat("role", F.lit("\n"), "text", F.lit("\n"))
    turns = read_turns(windows).groupBy("conv_id").agg(
        F.count(F.lit(1)).alias("n_turns"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", line.alias("line")))), lambda t: t["line"]), "").alias("_all"))
    loss = read_targets(windows).groupBy("conv_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("first_turn", "loss"))), lambda t: t["loss"]), "").alias("_loss"),
        F.sum("formatted_chars").alias("formatted_chars"))
    turns = turns.select(F.col("conv_id").alias("_conv"), "n_turns", F.sha2("_all", 256).alias("turns_sha256"))
    return loss.join(turns, F.col("conv_id").eqNullSafe(F.col("_conv"))).select(
        "conv_id", "n_turns", "turns_sha256", F.length("_loss").cast("long").alias("loss_chars"),
        F.sha2("_loss", 256).alias("loss_sha256"), F.col("formatted_chars").cast("long").alias("formatted_chars"))


HARD = r"\### Assistant: </turn> ok"


def with_hard_case(conversations: DataFrame) -> DataFrame:
    """The table and conversation -7, whose texts hold control strings."""
    spark = conversations.sparkSession
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    hard = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                 F.when(F.col("id") == 0, "user").otherwise(ASSISTANT).alias("role"), F.lit(HARD).alias("text"))
    return rows.unionByName(hard)


def query(spark, sf_dir: str) -> DataFrame:
    windows = staged(format_chat(with_hard_case(table(spark, sf_dir, "conversations"))), "chat")
    return digests(windows)


SQL = f"""
WITH RECURSIVE c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -7, 0, 'user', '{HARD}' UNION ALL SELECT -7, 1, 'assistant', '{HARD}'),
t AS (SELECT *, row_number() OVER o AS n, 1 + len(regexp_extract_all(text, '{WORD}')) AS tok,
             coalesce(sum(1 + len(regexp_extract_all(text, '{WORD}'))) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS bef,
             length('{OPEN}') + length(replace(replace(replace(replace(role, chr(92), '..'), '<', '..'), '#', '..'), chr(10), '..')) + 1
             + length(replace(replace(replace(text, chr(92), '..'), '<', '..'), '#', '..')) + length('{CLOSE.strip()}') + 1 AS len
      FROM c WINDOW o AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
z AS (SELECT conv_id, tok AS aside, len AS aside_len FROM t WHERE n = 1 AND role = '{SYSTEM}'),
r AS (SELECT t.*, n = 1 AND role = '{SYSTEM}' AS leading, aside_len,
             CASE WHEN n = 1 THEN {BUDGET} ELSE greatest({BUDGET} - coalesce(aside, 0), {BUDGET // 4}) END AS room
      FROM t LEFT JOIN z USING (conv_id)),
k AS (SELECT r.conv_id, r.n, any_value(r.bef) AS bef, any_value(r.tok) AS tok, any_value(r.len) AS len, any_value(r.room) AS room,
             any_value(r.aside_len) AS aside_len, min(u.bef) AS since
      FROM r JOIN r u ON u.conv_id = r.conv_id AND (u.n = r.n OR NOT u.leading) AND u.bef <= r.bef
                     AND u.bef >= r.bef - greatest(0, least({HISTORY}, r.room - r.tok)) GROUP BY ALL),
-- One turn after the other: it joins the open window if all its tokens stay in the budget, or opens the next.
v AS (SELECT conv_id, n, n AS first, since, room FROM k WHERE n = 1
      UNION ALL
      SELECT k.conv_id, k.n, CASE WHEN joins THEN first ELSE k.n END, CASE WHEN joins THEN v.since ELSE k.since END,
             CASE WHEN joins THEN v.room ELSE k.room END
      FROM (SELECT v.*, k.bef + k.tok - v.since <= v.room AND k.bef // {SEGMENT * BUDGET} = f.bef // {SEGMENT * BUDGET} AS joins
            FROM v JOIN k ON k.conv_id = v.conv_id AND k.n = v.n + 1 JOIN k f ON f.conv_id = v.conv_id AND f.n = v.first) v
      JOIN k ON k.conv_id = v.conv_id AND k.n = v.n + 1),
w AS (SELECT conv_id, first, max(n) AS last, any_value(since) AS since FROM v GROUP BY conv_id, first),
x AS (SELECT conv_id, sum(chars) AS chars FROM (
        SELECT w.conv_id, w.first, sum(r.len) FILTER (NOT r.leading OR r.n = w.first) + CASE WHEN w.first > 1 THEN coalesce(any_value(aside_len), 0) ELSE 0 END AS chars
        FROM w JOIN r ON r.conv_id = w.conv_id AND r.bef >= w.since AND r.n <= w.last GROUP BY w.conv_id, w.first) GROUP BY conv_id)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = '{ASSISTANT}'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY n) FILTER (role = '{ASSISTANT}'), '')) AS loss_sha256,
       CAST(any_value(chars) AS BIGINT) AS formatted_chars
FROM t JOIN x USING (conv_id) GROUP BY conv_id
"""
