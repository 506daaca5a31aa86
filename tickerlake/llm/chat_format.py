r"""Chat formatting in budgeted windows, with DataFrame functions only.

A turn is written ``<|im_start|>role\ntext<|im_end|>\n``. Inside texts a backslash is doubled and control strings (``<|``, ``<s>``,
``</s>``, ``[INST]``, ``[/INST]``, ``<<SYS>>``, ``<</SYS>>``) get a backslash after their first character, so no text can
open or close a turn and the original comes back exactly. In roles a line feed is written ``<\n>`` as well.

Turns are ordered by (turn, role, text), NULL turns last. Prefix sums of the turns' tokens cut a conversation into windows: with ``width`` the
budget less the system turn and the history, a turn belongs to the bin of its first token; the turn that crosses a bin's edge is a window
of its own. So a window's own turns fit the width unless one turn alone exceeds it. Every window begins with the system turn
(the conversation's first turn, if its role is ``system``) and repeats up to ``history_turns`` turns of at most
``history_tokens`` tokens. Loss covers the texts of the window's own assistant turns; repeated ones are masked.

Prefix sums have two levels (blocks of turns, then turns within a block), windows are grouped by (conversation, window) and history is an equality
join on the turn's number: a conversation of any length is spread over tasks. Only ``read_back`` gathers a whole conversation, as its
digest covers all of it. Results for odd rows: NULL text and role are empty; all rows with a NULL conv_id are one conversation; repeated rows are turns of their own; turns equal in all three columns are
interchangeable. Very long texts and conversations are formatted whole; a turn longer than a window is a window. An empty table gives no rows. Other columns are not read, so their names
cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickerlake.llm.common import table

#: Fixed values of the template.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
#: Tokens that the marks of a turn count for.
TURN_TOKENS = 4
BUDGET = 512
HISTORY_TOKENS = 128
HISTORY_TURNS = 2
BLOCK_TURNS = 256

_CONTROL = r"(<(?=\||/?s>|</?SYS>>)|\[(?=/?INST\]))"
_ESCAPED = r"([<\[])\\(?=[^\\])"


def escape(text: Column) -> Column:
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), _CONTROL, r"$1\\")


def unescape(text: Column) -> Column:
    return F.replace(F.regexp_replace(text, _ESCAPED, "$1"), F.lit("\\\\"), F.lit("\\"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("<\\n>"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("<\\n>"), F.lit("\n")))


def _same(*names: str) -> Column:
    """Equality of the named columns of the aliases a and b, NULL equal to NULL."""
    out = F.lit(True)
    for n in names:
        out = out & F.col(f"a.{n}").eqNullSafe(F.col(f"b.{n}"))
    return out


def _placed(conversations: DataFrame) -> DataFrame:
    """Turns with their number n in the conversation, the prefix sums [begin, finish) of tokens, and the system turn."""
    turns = conversations.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.coalesce(F.col("turn").cast("bigint"), F.lit((1 << 63) - 1)).alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    turns = turns.withColumn("tokens", (F.regexp_count("text", F.lit(r"\S+")) + TURN_TOKENS).cast("bigint"))
    turns = turns.withColumn("block", F.floor(F.col("turn") / BLOCK_TURNS))
    blocks = turns.groupBy("conv_id", "block").agg(
        F.sum("tokens").alias("tokens"), F.count("*").alias("turns"), F.min(F.struct("turn", "role", "text", "tokens")).alias("first")
    )
    conversation = Window.partitionBy("conv_id").orderBy("block")
    before = conversation.rowsBetween(Window.unboundedPreceding, -1)
    first = F.first("first").over(conversation)
    blocks = blocks.select(
        "conv_id",
        "block",
        F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("tokens_before"),
        F.coalesce(F.sum("turns").over(before), F.lit(0)).alias("turns_before"),
        F.when(first["role"] == "system", F.struct(first["text"].alias("text"), first["tokens"].alias("tokens"))).alias("system"),
    )
    block = Window.partitionBy("conv_id", "block").orderBy("turn", "role", "text")
    inner = turns.select("*", F.row_number().over(block).alias("k"), F.sum("tokens").over(block.rowsBetween(Window.unboundedPreceding, 0)).alias("upto"))
    placed = inner.alias("a").join(blocks.alias("b"), _same("conv_id", "block"))
    system_tokens = F.coalesce(F.col("system.tokens"), F.lit(0))
    return placed.select(
        "a.conv_id", "role", "text", "system", system_tokens.alias("system_tokens"),
        (F.col("turns_before") + F.col("k")).alias("n"),
        (F.col("tokens_before") + F.col("upto") - F.col("tokens") - system_tokens).alias("begin"),
        (F.col("tokens_before") + F.col("upto") - system_tokens).alias("finish"),
    )


def _written(role: Column, text: Column) -> Column:
    return F.concat(F.lit(OPEN), escape_role(role), F.lit("\n"), escape(text), F.lit(CLOSE))


def format_windows(
    conversations: DataFrame, budget: int = BUDGET, history_tokens: int = HISTORY_TOKENS, history_turns: int = HISTORY_TURNS
) -> DataFrame:
    """conv_id, window, text, n_context, loss.

    ``n_context`` counts the leading turns of the text that are repeated from before; ``loss`` lists (start, length) in code points of ``text``.
    """
    placed = _placed(conversations)
    width = F.greatest(F.lit(budget - history_tokens) - F.col("system_tokens"), F.lit(max(1, budget // 8)))
    is_system = (F.col("n") == 1) & F.col("system").isNotNull()
    bin_of = F.floor(F.col("begin") / width)
    crossing = (F.floor((F.col("finish") - 1) / width) != bin_of).cast("bigint")
    placed = placed.withColumn("window", F.when(is_system, F.lit(0)).otherwise(2 * bin_of + crossing).cast("bigint"))
    # Numbers of part: 0 the system turn, 1 history, 2 the window's own turns.
    own = placed.select("conv_id", "window", F.lit(2).alias("part"), "n", "role", "text")
    rest = placed.where(~is_system)
    starts = rest.groupBy("conv_id", "window").agg(F.min("n").alias("n"), F.min("begin").alias("begin"), F.first("system").alias("system"))
    offered = rest.select("conv_id", F.col("n").alias("own_n"), F.col("begin").alias("own_begin"), "role", "text", F.explode(F.sequence(F.lit(1), F.lit(history_turns))).alias("later"))
    offered = offered.withColumn("n", F.col("own_n") + F.col("later"))
    history = offered.alias("a").join(starts.alias("b"), _same("conv_id", "n") & (F.col("own_begin") >= F.col("begin") - history_tokens))
    history = history.select("a.conv_id", "window", F.lit(1).alias("part"), F.col("own_n").alias("n"), "role", "text")
    system = starts.where((F.col("system").isNotNull()) & (F.col("window") > 0)).select(
        "conv_id", "window", F.lit(0).alias("part"), F.lit(1).cast("bigint").alias("n"), F.lit("system").alias("role"), F.col("system.text").alias("text")
    )
    parts = own.unionByName(system)
    if history_turns > 0 and history_tokens > 0:
        parts = parts.unionByName(history)
    piece = F.struct(
        "part", "n",
        _written(F.col("role"), F.col("text")).alias("piece"),
        F.when((F.col("part") == 2) & (F.col("role") == "assistant"), F.length(escape("text"))).alias("loss"),
        F.length(F.concat(F.lit(OPEN), escape_role(F.col("role")), F.lit("\n"))).alias("head"),
    )
    windows = parts.groupBy("conv_id", "window").agg(F.sort_array(F.collect_list(piece)).alias("pieces"))
    # Lengths of the pieces before each piece, then the places under the loss mask.
    state = F.aggregate(
        "pieces",
        F.struct(F.lit(0).alias("at"), F.expr("CAST(array() AS array<struct<start:int,length:int>>)").alias("loss")),
        lambda acc, p: F.struct(
            (acc["at"] + F.length(p["piece"])).alias("at"),
            F.when(p["loss"].isNull(), acc["loss"])
            .otherwise(F.concat(acc["loss"], F.array(F.struct((acc["at"] + p["head"]).alias("start"), p["loss"].alias("length")))))
            .alias("loss"),
        ),
        lambda acc: acc["loss"],
    )
    return windows.select(
        "conv_id",
        "window",
        F.array_join(F.transform("pieces", lambda p: p["piece"]), "").alias("text"),
        F.size(F.filter("pieces", lambda p: p["part"] < 2)).alias("n_context"),
        state.alias("loss"),
    )


def read_back(windows: DataFrame) -> DataFrame:
    """conv_id, turns, n_turns, loss_text, formatted_chars, from the formatted windows alone."""
    split = F.split("text", "\\Q" + CLOSE + "\\E")
    own = F.expr("slice(parts, n_context + 1, greatest(size(parts) - 1 - n_context, 0))")
    body = windows.withColumn("parts", split).withColumn("own", own)
    turn = lambda p: F.substr(p, F.lit(len(OPEN) + 1))
    head = lambda p: F.substring_index(turn(p), "\n", 1)
    said = lambda p: F.substr(turn(p), F.length(head(p)) + 2)
    line = lambda p: F.concat(unescape_role(head(p)), F.lit("\n"), unescape(said(p)), F.lit("\n"))
    body = body.select(
        "conv_id",
        F.struct(
            "window",
            F.array_join(F.transform("own", line), "").alias("turns"),
            F.size("own").cast("bigint").alias("n"),
            F.array_join(F.transform("loss", lambda s: unescape(F.substr(F.col("text"), s["start"] + 1, s["length"]))), "").alias("loss"),
            F.length("text").cast("bigint").alias("chars"),
        ).alias("w"),
    )
    whole = body.groupBy("conv_id").agg(F.sort_array(F.collect_list("w")).alias("w"), F.sum("w.n").alias("n_turns"), F.sum("w.chars").alias("formatted_chars"))
    return whole.select(
        "conv_id",
        F.array_join(F.transform("w", lambda x: x["turns"]), "").alias("turns"),
        "n_turns",
        F.array_join(F.transform("w", lambda x: x["loss"]), "").alias("loss_text"),
        "formatted_chars",
    )


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(
        F.lit(-1).cast("bigint").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text")
    )
    read = read_back(format_windows(given.unionByName(extra)))
    return read.select(
        "conv_id",
        "n_turns",
        F.sha2("turns", 256).alias("turns_sha256"),
        F.length("loss_text").cast("bigint").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        "formatted_chars",
    )


_ESCAPE_SQL = r"regexp_replace(regexp_replace(replace({x}, '\', '\\'), '<(\||/?s>|</?SYS>>)', '<\\\1', 'g'), '\[(/?INST\])', '[\\\1', 'g')"
OP6_SQL = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), counted AS (
  SELECT *, len(regexp_extract_all(text, '\\S+')) + {TURN_TOKENS} AS tokens,
    length({_ESCAPE_SQL.format(x="text")}) + length({_ESCAPE_SQL.format(x="role")}) + {len(OPEN) + 1 + len(CLOSE)} AS chars,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS n
  FROM turns
), placed AS (
  SELECT *, coalesce(max(CASE WHEN n = 1 AND role = 'system' THEN tokens END) OVER (PARTITION BY conv_id), 0) AS sys,
    coalesce(max(CASE WHEN n = 1 AND role = 'system' THEN chars END) OVER (PARTITION BY conv_id), 0) AS sys_chars,
    sum(tokens) OVER (PARTITION BY conv_id ORDER BY n) AS upto
  FROM counted
), binned AS (
  SELECT *, upto - tokens - sys AS b, upto - sys AS f, greatest({BUDGET - HISTORY_TOKENS} - sys, {BUDGET // 8}) AS width FROM placed
), windowed AS (
  SELECT *, CASE WHEN n = 1 AND sys > 0 THEN 0
    ELSE 2 * CAST(floor(b / width) AS BIGINT) + CASE WHEN floor((f - 1) / width) <> floor(b / width) THEN 1 ELSE 0 END END AS w
  FROM binned
), starts AS (
  SELECT conv_id, w, min(n) AS n, min(b) AS b, any_value(sys_chars) AS sys_chars FROM windowed WHERE NOT (n = 1 AND sys > 0) GROUP BY conv_id, w
), context AS (
  SELECT s.conv_id, sum(coalesce(r.chars, 0)) AS chars FROM starts s JOIN windowed r
    ON r.conv_id = s.conv_id AND r.n < s.n AND r.n >= s.n - {HISTORY_TURNS} AND r.b >= s.b - {HISTORY_TOKENS} AND NOT (r.n = 1 AND r.sys > 0)
  GROUP BY s.conv_id
), repeated AS (
  SELECT conv_id, sum(CASE WHEN w > 0 THEN sys_chars ELSE 0 END) AS chars FROM starts GROUP BY conv_id
), whole AS (
  SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY n) AS turns,
    coalesce(string_agg(text, '' ORDER BY n) FILTER (WHERE role = 'assistant'), '') AS loss, sum(chars) AS chars
  FROM windowed GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss)::BIGINT AS loss_chars, sha256(loss) AS loss_sha256,
  (whole.chars + coalesce(context.chars, 0) + coalesce(repeated.chars, 0))::BIGINT AS formatted_chars
FROM whole LEFT JOIN context USING (conv_id) LEFT JOIN repeated USING (conv_id)
"""
