"""Chat formatting by rotating the perspective over all parties.

For every participant (each distinct role but ``system``) the dialogue is rendered with that speaker as the
assistant and all others as named users. The result has a row for each perspective and turn: the rendered
segment, its place in the whole text (code points), the part of it that is trained on, and a flag. Places
are running sums over blocks of turns and the blocks' totals; blocks are ranges of all turns in order, dealt
out to tasks alike whatever the turns' numbers are, so a very long dialogue isn't gathered in one task.
``assemble`` joins segments to whole texts.

Texts and names can't forge turns: in both, ``<|`` gets a backslash between its characters, and so does
``|>`` (one more where backslashes stand there already, so this can be undone); line breaks in names become
blanks. Places and masks are those of the rendered text.

Edge cases: a null role is the participant ``unknown``; a null text is empty. Turns that tie are ordered by
role, then by text, nulls first. A dialogue of system turns only has no perspectives. Rows with a null
conv_id form one dialogue. Repeated rows are repeated turns. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import read, spool

CLOSE = "\n<|end|>\n"


def escaped(text: Column) -> Column:
    """text without the marks that open or close a turn; unescaped gives it back."""
    return F.regexp_replace(F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|"), r"\|(\\*)>", r"|\\$1>")


def unescaped(text: Column) -> Column:
    """The text that escaped made."""
    return F.regexp_replace(F.regexp_replace(text, r"\|\\(\\*)>", "|$1>"), r"<\\(\\*)\|", "<$1|")


def rotate(conversations: DataFrame) -> DataFrame:
    """(conv_id, perspective, turn, speaker, shown, segment, start, end, train_start, train_end, trained)."""
    turns = conversations.select("conv_id", "turn", F.coalesce("role", F.lit("unknown")).alias("speaker"), escaped(F.coalesce("text", F.lit(""))).alias("text"))
    order = ["conv_id", F.col("turn").asc_nulls_first(), "speaker", "text"]
    ranges = turns.withColumn("_i", F.monotonically_increasing_id()).repartitionByRange(int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions")), *order, "_i")
    turns = spool(ranges.drop("_i").withColumn("block", F.spark_partition_id()), "turns")
    parties = turns.where("speaker <> 'system'").select(F.col("conv_id").alias("c"), F.col("speaker").alias("perspective")).distinct()
    each = turns.join(parties, F.col("conv_id").eqNullSafe(F.col("c"))).drop("c")
    shown = F.when(F.col("speaker") == "system", "system").when(F.col("speaker") == F.col("perspective"), "assistant").otherwise(F.concat(F.lit("user name="), escaped(F.translate("speaker", "\r\n", "  "))))
    head = F.concat(F.lit("<|"), shown, F.lit("|>\n"))
    each = each.select("*", shown.alias("shown"), head.alias("head"), F.concat(head, "text", F.lit(CLOSE)).alias("segment"))
    keys = ["conv_id", "perspective"]
    each = each.withColumn("size", F.length("segment").cast("long"))
    totals = each.groupBy(*keys, "block").agg(F.sum("size").alias("total"))
    before = F.coalesce(F.sum("total").over(Window.partitionBy(*keys).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    totals = totals.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("block").alias("_block"), before.alias("before"))
    placed = each.join(totals, F.col("conv_id").eqNullSafe(F.col("_conv_id")) & (F.col("perspective") == F.col("_perspective")) & (F.col("block") == F.col("_block")))
    inner = Window.partitionBy(*keys, "block").orderBy(F.col("turn").asc_nulls_first(), "speaker", "text").rowsBetween(Window.unboundedPreceding, 0)
    end = F.col("before") + F.sum("size").over(inner)
    placed = placed.withColumn("end", end).withColumn("start", F.col("end") - F.col("size"))
    trained = F.col("speaker") == F.col("perspective")
    first = F.col("start") + F.length("head")
    return placed.select(*keys, "turn", "speaker", "shown", "segment", "start", "end", F.when(trained, first).alias("train_start"), F.when(trained, first + F.length("text")).alias("train_end"), trained.alias("trained"))


def assemble(segments: DataFrame) -> DataFrame:
    """Whole texts (conv_id, perspective, text, masks) of segments; masks: arrays of trained (start, end)."""
    parts = F.array_sort(F.collect_list(F.struct("start", "segment", "train_start", "train_end")))
    whole = segments.groupBy("conv_id", "perspective").agg(parts.alias("p"))
    masks = F.transform(F.filter("p", lambda x: x["train_start"].isNotNull()), lambda x: F.struct(x["train_start"].alias("start"), x["train_end"].alias("end")))
    return whole.select("conv_id", "perspective", F.array_join(F.transform("p", lambda x: x["segment"]), "").alias("text"), masks.alias("masks"))


def op9_perspective_rotation(spark, sf_dir):
    """All dialogues from every participant's perspective."""
    return rotate(read(spark, sf_dir, "conversations"))


OP9_SQL = """
WITH t AS (
  SELECT conv_id, turn, coalesce(role, 'unknown') AS speaker,
    regexp_replace(regexp_replace(coalesce(text, ''), '<(\\\\*)\\|', '<\\\\\\1|', 'g'), '\\|(\\\\*)>', '|\\\\\\1>', 'g') AS text
  FROM conversations),
p AS (SELECT DISTINCT conv_id AS c, speaker AS perspective FROM t WHERE speaker <> 'system'),
e AS (
  SELECT conv_id, perspective, turn, speaker, text,
    CASE WHEN speaker = 'system' THEN 'system' WHEN speaker = perspective THEN 'assistant' 
      ELSE 'user name=' || regexp_replace(regexp_replace(translate(speaker, chr(13) || chr(10), '  '), '<(\\\\*)\\|', '<\\\\\\1|', 'g'), '\\|(\\\\*)>', '|\\\\\\1>', 'g') END AS shown
  FROM t JOIN p ON conv_id IS NOT DISTINCT FROM c),
s AS (SELECT *, '<|' || shown || '|>' || chr(10) AS head, '<|' || shown || '|>' || chr(10) || text || chr(10) || '<|end|>' || chr(10) AS segment FROM e),
q AS (SELECT *, CAST(sum(length(segment)) OVER (PARTITION BY conv_id, perspective ORDER BY turn NULLS FIRST, speaker, text ROWS UNBOUNDED PRECEDING) AS BIGINT) AS "end" FROM s),
r AS (SELECT *, "end" - length(segment) AS start, speaker = perspective AS trained FROM q)
SELECT conv_id, perspective, turn, speaker, shown, segment, start, "end",
  CASE WHEN trained THEN start + length(head) END AS train_start,
  CASE WHEN trained THEN start + length(head) + length(text) END AS train_end, trained
FROM r
"""
