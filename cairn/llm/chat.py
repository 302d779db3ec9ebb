r"""Chat formatting whose grammar reads back exactly what was written.

A turn is `<turn role>text</turn>` and a line feed; in the markers `role` is the
turn's role.  A conversation is first rendered as it is and parsed again; turns
that a deterministic parser does not give back are conflicting, and are rendered
with an escaped body, marked `<turn role\>`.  In an escaped body and in every role
a backslash becomes `\\`, `<` becomes `\l`, `>` becomes `\g`, and a line feed in
a role `\n`; neither can then hold a marker, so the second reading is exact.
The loss mask is the list of spans, in code points of the formatted text, of the
assistants' bodies.

Null texts and roles are empty ones.  Turns are put in order of turn, then role,
then text; null turns come first; repeated rows are repeated turns.  An empty
table gives no rows.  A conversation is one row, so the largest must fit one.
All of it is DataFrame functions.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EXTRA = [(-7, 0, "user", "\\### Assistant: </turn> ok"), (-7, 1, "assistant", "\\### Assistant: </turn> ok")]
CLOSE = "</turn>\n"


def escape(c: Column) -> Column:
    c = F.replace(c, F.lit("\\"), F.lit("\\\\"))
    c = F.replace(c, F.lit("<"), F.lit("\\l"))
    c = F.replace(c, F.lit(">"), F.lit("\\g"))
    return F.replace(c, F.lit("\n"), F.lit("\\n"))


def unescape(c: Column) -> Column:
    """Splits at doubled backslashes first, so that what follows one is not taken for a code."""
    one = lambda p: F.replace(F.replace(F.replace(p, F.lit("\\l"), F.lit("<")), F.lit("\\g"), F.lit(">")), F.lit("\\n"), F.lit("\n"))
    return F.when(F.instr(c, "\\") == 0, c).otherwise(F.array_join(F.transform(F.split(c, r"\\\\", -1), one), "\\"))


def render_turn(turn: Column, escaped: Column) -> Column:
    head = F.concat(F.lit("<turn "), escape(turn["role"]))
    return F.when(escaped, F.concat(head, F.lit("\\>"), escape(turn["text"]), F.lit(CLOSE))).otherwise(F.concat(head, F.lit(">"), turn["text"], F.lit(CLOSE)))


def parse(formatted: Column) -> Column:
    """The turns (role, text, raw, head) of a formatted conversation, in order.

    A marker's role ends at its first `>`, which no role holds unescaped; a body
    ends at the first close marker followed by a line feed.
    """
    pieces = F.split(formatted, r"</turn>\n", -1)
    whole = F.slice(pieces, 1, F.greatest(F.lit(0), F.size(pieces) - 1))

    def turn(p: Column) -> Column:
        at = F.instr(p, ">")
        head, body = F.substring(p, F.lit(1), at), F.substring(p, at + 1, F.char_length(p))
        coded = F.endswith(head, F.lit("\\>"))
        role = F.substring(head, F.lit(7), F.char_length(head) - F.when(coded, 8).otherwise(7))
        return F.struct(
            unescape(role).alias("role"),
            F.when(coded, unescape(body)).otherwise(body).alias("text"),
            F.char_length(head).alias("head"),
            F.char_length(body).alias("raw"),
        )

    return F.transform(whole, turn)


def conflicting(turn: Column) -> Column:
    """True if the turn, rendered as it is, does not come back as that turn alone."""
    back = parse(render_turn(turn, F.lit(False)))
    only = F.get(back, F.lit(0))
    return ~F.coalesce((F.size(back) == 1) & (only["role"] == turn["role"]) & (only["text"] == turn["text"]), F.lit(False))


def format_conversations(turns: DataFrame) -> DataFrame:
    """(conv_id, source, formatted) from rows (conv_id, turn, role, text); source is the ordered turns."""
    rows = turns.select("conv_id", "turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("out", render_turn(F.struct("role", "text"), conflicting(F.struct("role", "text"))))
    grouped = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text", "out"))).alias("t"))
    return grouped.select(
        "conv_id",
        F.transform("t", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text"))).alias("source"),
        F.array_join(F.transform("t", lambda x: x["out"]), "").alias("formatted"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """Adds the parsed turns, whether they equal the source, and the loss mask (start, length)."""
    read = formatted.withColumn("turns", parse(F.col("formatted")))
    plain = F.transform("turns", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text")))
    spans = F.aggregate(
        "turns",
        F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,length:bigint>>").alias("mask")),
        lambda acc, x: F.struct(
            (acc["at"] + x["head"] + x["raw"] + len(CLOSE)).alias("at"),
            F.when(x["role"] == "assistant", F.array_append(acc["mask"], F.struct((acc["at"] + x["head"]).cast("long").alias("start"), x["raw"].cast("long").alias("length")))).otherwise(acc["mask"]).alias("mask"),
        ),
        lambda acc: acc["mask"],
    )
    return read.withColumn("identical", plain == F.col("source")).withColumn("loss_mask", spans)


def under_mask(formatted: Column, mask: Column) -> Column:
    """The texts under a loss mask, read from the formatted text; bodies after an escaping marker are unescaped."""

    def body(x: Column) -> Column:
        start, length = x["start"].cast("int"), x["length"].cast("int")
        raw = F.substring(formatted, start + 1, length)
        return F.when(F.substring(formatted, start - 1, F.lit(2)) == "\\>", unescape(raw)).otherwise(raw)

    return F.array_join(F.transform(mask, body), "")


def op4_chat(spark, sf_dir: str) -> DataFrame:
    """Digests of every conversation, read back from its formatted text."""
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame(EXTRA, "conv_id long, turn long, role string, text string")
    read = read_back(format_conversations(turns.unionByName(extra)))
    said = F.array_join(F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    loss = under_mask(F.col("formatted"), F.col("loss_mask"))
    digest = lambda c: F.sha2(c.cast("binary"), 256)
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        digest(said).alias("turns_sha256"),
        F.char_length(loss).cast("long").alias("loss_chars"),
        digest(loss).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
        "identical",
    )


ORACLE_SQL = r"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
f AS (SELECT *, 15 + length(role) + length(text) + CASE WHEN contains(text, '</turn>' || chr(10)) THEN 1 + length(regexp_replace(text, '[^\\<>\n]', '', 'g')) ELSE 0 END AS n FROM t)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
CAST(length(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS BIGINT) AS loss_chars,
sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256, CAST(sum(n) AS BIGINT) AS formatted_chars, true AS identical FROM f GROUP BY conv_id
"""
