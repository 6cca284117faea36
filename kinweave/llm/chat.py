"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it are the context, and only that reply is
under the loss mask. A conversation whose last turn isn't an assistant's gives one more example, its `tail`, that
holds all its turns and no mask, so that no turn is lost. An example is one string plus the mask as a start and a
length in code points. Control strings of the template inside roles and texts are escaped, and unescape() gets the
texts back exactly.

Turns are taken in the order of turn, role, text. Nulls: a null role or text counts as empty, a null conv_id is a
conversation like any other, null turns come first. Empty and very long texts are texts like others. Repeated rows are
turns like any others. An empty table gives no
examples. Columns beside conv_id, turn, role and text are ignored. The expansion repeats contexts, so its output
grows with the square of the turns of a conversation: that is what the method is.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import table


@dataclass(frozen=True)
class ChatTemplate:
    """A turn is turn_open, role, role_close, text, turn_close; `controls` are the strings escaped inside texts.

    No control string may begin inside another, and all four marks have to be made of control strings and white space.
    """

    turn_open: str = "<s>[INST] "
    role_close: str = " [/INST]\n"
    turn_close: str = "</s>\n"
    controls: tuple[str, ...] = ("<s>", "</s>", "[INST]", "[/INST]")
    escape_char: str = "\\"
    trainable: str = "assistant"

    def escape(self, text: Column) -> Column:
        """The escape character becomes itself and 0, the k-th control string that character and k."""
        e = self.escape_char
        out = F.replace(text, F.lit(e), F.lit(e + "0"))
        for k, control in enumerate(self.controls, 1):
            out = F.replace(out, F.lit(control), F.lit(f"{e}{k}"))
        return out

    def unescape(self, text: Column) -> Column:
        e, out = self.escape_char, text
        for k, control in enumerate(self.controls, 1):
            out = F.replace(out, F.lit(f"{e}{k}"), F.lit(control))
        return F.replace(out, F.lit(e + "0"), F.lit(e))

    def render(self, role: Column, text: Column) -> Column:
        return F.concat(F.lit(self.turn_open), self.escape(role), F.lit(self.role_close), self.escape(text), F.lit(self.turn_close))


def expand(conversations: DataFrame, template: ChatTemplate = ChatTemplate()) -> DataFrame:
    """conv_id, example (0, 1, ... in a conversation), tail, formatted, loss_start, loss_length."""
    t = template
    turns = conversations.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    order = W.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    so_far = order.rowsBetween(W.unboundedPreceding, W.currentRow)
    is_reply = F.col("role") == t.trainable
    rows = turns.withColumns({"is_reply": is_reply, "piece": t.render(F.col("role"), F.col("text"))}).select(
        "conv_id",
        "is_reply",
        F.length(t.escape(F.col("text"))).alias("target"),
        F.coalesce(F.sum(F.col("is_reply").cast("int")).over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("example"),
        F.lead(F.lit(1)).over(order).isNull().alias("last"),
        F.collect_list("piece").over(so_far).alias("pieces"),
    )
    examples = rows.filter("is_reply OR last").withColumn("formatted", F.array_join("pieces", ""))
    end = F.length("formatted") - len(t.turn_close)
    return examples.select(
        "conv_id",
        "example",
        (~F.col("is_reply")).alias("tail"),
        "formatted",
        F.when(F.col("is_reply"), end - F.col("target")).otherwise(0).alias("loss_start"),
        F.when(F.col("is_reply"), F.col("target")).otherwise(0).alias("loss_length"),
    )


def parse(formatted: Column, template: ChatTemplate = ChatTemplate()) -> Column:
    """The turns of an example, as an array of (role, text)."""
    t = template
    closed = F.split(formatted, _literal(t.turn_close))
    pieces = F.slice(closed, 1, F.size(closed) - 1)

    def turn(piece: Column) -> Column:
        inner = F.split(F.substring(piece, len(t.turn_open) + 1, 1 << 30), _literal(t.role_close), 2)
        return F.struct(t.unescape(inner[0]).alias("role"), t.unescape(inner[1]).alias("text"))

    return F.transform(pieces, turn)


def _literal(s: str) -> str:
    return "\\Q" + s + "\\E"


def read_back(examples: DataFrame, template: ChatTemplate = ChatTemplate()) -> DataFrame:
    """What the examples of each conversation hold: turns (all, in order), replies under the mask, formatted_chars.

    Each example gives the turns that come after the last reply before its own, so that every turn is read once.
    """
    t = template
    turns = parse(F.col("formatted"), t)
    parsed = examples.withColumn("turns", turns)
    earlier = F.filter(F.slice("turns", 1, F.size("turns") - 1), lambda x: x["role"] == t.trainable)
    reply_at = F.transform(F.slice("turns", 1, F.size("turns") - 1), lambda x, i: F.when(x["role"] == t.trainable, i + 1))
    known = F.when(F.size(earlier) == 0, 0).otherwise(F.array_max(reply_at))
    masked = F.when(F.col("tail"), F.lit(None)).otherwise(
        t.unescape(F.substring("formatted", F.col("loss_start") + 1, F.col("loss_length")))
    )
    part = F.struct(
        "example", F.slice("turns", known + 1, F.size("turns") - known).alias("turns"), masked.alias("reply"),
        F.length("formatted").cast("long").alias("chars"),
    )
    grouped = parsed.select("conv_id", part.alias("part")).groupBy("conv_id").agg(F.sort_array(F.collect_list("part")).alias("parts"))
    return grouped.select(
        "conv_id",
        F.flatten(F.col("parts.turns")).alias("turns"),
        F.filter(F.col("parts.reply"), lambda x: x.isNotNull()).alias("replies"),
        F.aggregate(F.col("parts.chars"), F.lit(0).cast("long"), lambda a, x: a + x).alias("formatted_chars"),
    )


def planted(spark: SparkSession) -> DataFrame:
    """Conversation -7: a user and an assistant turn that both hold control strings."""
    row = spark.range(2)
    role = F.when(F.col("id") == 0, "user").otherwise("assistant")
    return row.select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), role.alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(planted(spark))
    back = read_back(expand(conversations))
    all_turns = F.array_join(F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    under = F.array_join("replies", "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(all_turns, 256).alias("turns_sha256"),
        F.length(under).cast("long").alias("loss_chars"),
        F.sha2(under, 256).alias("loss_sha256"),
        "formatted_chars",
    )


def _escaped_length_sql(c: str, t: ChatTemplate = ChatTemplate()) -> str:
    e = f"replace({c}, '{t.escape_char}', '{t.escape_char}0')"
    for k, control in enumerate(t.controls, 1):
        e = f"replace({e}, '{control}', '{t.escape_char}{k}')"
    return f"length({e})"


_T = ChatTemplate()
ORACLE = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), sized AS (
  SELECT *, row_number() OVER w AS pos, count(*) OVER (PARTITION BY conv_id) AS n,
    sum({_escaped_length_sql('role')} + {_escaped_length_sql('text')} + {len(_T.turn_open + _T.role_close + _T.turn_close)})
      OVER (w ROWS UNBOUNDED PRECEDING) AS chars
  FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
)
SELECT conv_id, count(*)::BIGINT AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY pos)) AS turns_sha256,
  sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY pos), '')) AS loss_sha256,
  sum(CASE WHEN role = 'assistant' OR pos = n THEN chars ELSE 0 END)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
"""
