"""Multi-party perspective rotation of dialogues, with DataFrame functions only.

For every participant of a conversation (each role but `system`, NULL being the participant `unknown`) the dialogue is
rendered once with that speaker as the assistant: its own turns are assistant turns with mask 1, all others are user
turns that carry the speaker's name, system turns stay system turns; those have mask 0. A rendering is a sequence of
segments whose texts follow each other without gap, so a segment has its place in the whole string.

No text or name can forge a frame: in both, a backslash goes between the two characters of `<|` and of `|>`, and line ends
in names become spaces.

Places are found from lengths alone; the texts join last, once. The result has a row for each turn and participant, which
is what rotation means: a conversation of many speakers costs turns times speakers.

Defined results: a NULL turn sorts first, a NULL text is empty. Turns order by number, then role, then the text's MD5. Repeated
rows are turns of their own. A conversation of system turns only has no participant and no rendering. A NULL conv_id is a
conversation of its own. Rows are segments, so a conversation of any length is never in one row; positions are running
sums within chunks of CHUNK turn numbers plus sums over chunks. Turns that share one number, or have none, are one chunk. Other
columns are not read. Empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CHUNK = 512
#: What follows a turn's text; fixed text of the chat format.
END = "<|end|>\n"


def _header(role: Column, name: Column) -> Column:
    return F.concat(F.lit("<|"), role, F.when(name.isNotNull(), F.concat(F.lit(" name="), name)).otherwise(F.lit("")), F.lit("|>\n"))


def harmless(text: Column) -> Column:
    """text whose character pairs of a frame are parted by a backslash."""
    return F.replace(F.replace(text, F.lit("<|"), F.lit("<\\|")), F.lit("|>"), F.lit("|\\>"))


def rotations(conversations: DataFrame) -> DataFrame:
    """(conv_id, perspective, seq, turn, role, name, segment, mask, start, end, content_start, content_end), a row a segment.

    seq counts from 0; start and end are code points in the rendered dialogue; content is the turn's own text and its end
    mark, which is what a trainer learns where mask is 1.
    """
    speaker = harmless(F.regexp_replace(F.coalesce(F.col("role"), F.lit("unknown")), r"[\r\n]+", " "))
    said = conversations.select("conv_id", "turn", speaker.alias("speaker"), harmless(F.coalesce(F.col("text"), F.lit(""))).alias("text")).withColumn("digest", F.md5(F.col("text").cast("binary")))
    turns = said.select("conv_id", "turn", "speaker", "digest", F.length("text").alias("chars"), F.coalesce(F.floor(F.col("turn") / CHUNK), F.lit(-(1 << 40))).cast("long").alias("chunk"))
    people = turns.filter("speaker <> 'system'").select(F.col("conv_id").alias("c"), F.col("speaker").alias("perspective")).distinct()
    each = turns.join(people, turns["conv_id"].eqNullSafe(people["c"])).drop("c")
    role = F.when(F.col("speaker") == "system", "system").when(F.col("speaker") == F.col("perspective"), "assistant").otherwise("user")
    named = each.withColumn("role", role).withColumn("name", F.when(F.col("role") == "user", F.col("speaker"))).withColumn("header", _header(F.col("role"), F.col("name")))
    sized = named.withColumn("head", F.length("header").cast("long")).withColumn("all", F.col("head") + F.col("chars") + len(END))
    chunks = sized.groupBy("conv_id", "perspective", "chunk").agg(F.sum("all").alias("chunk_chars"), F.count("*").alias("chunk_turns"))
    upto = Window.partitionBy("conv_id", "perspective").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    bases = chunks.select(
        F.col("conv_id").alias("c"), F.col("perspective").alias("p"), F.col("chunk").alias("k"),
        F.coalesce(F.sum("chunk_chars").over(upto), F.lit(0)).alias("base"), F.coalesce(F.sum("chunk_turns").over(upto), F.lit(0)).alias("seq_base"),
    )
    within = Window.partitionBy("conv_id", "perspective", "chunk").orderBy("turn", "speaker", "digest")
    before = within.rowsBetween(Window.unboundedPreceding, -1)
    placed = sized.withColumn("own", F.coalesce(F.sum("all").over(before), F.lit(0))).withColumn("own_seq", F.row_number().over(within) - 1)
    on = placed["conv_id"].eqNullSafe(bases["c"]) & (placed["perspective"] == bases["p"]) & (placed["chunk"] == bases["k"])
    start = F.col("base") + F.col("own")
    found = placed.join(bases, on).select(
        "conv_id", "perspective", (F.col("seq_base") + F.col("own_seq")).alias("seq"), "turn", "role", "name", "header", "speaker", "digest",
        start.alias("start"), (start + F.col("all")).alias("end"), (start + F.col("head")).alias("content_start"),
    )
    texts = said.groupBy(F.col("conv_id").alias("c"), F.col("turn").alias("t"), F.col("speaker").alias("s"), F.col("digest").alias("d")).agg(F.first("text").alias("text"))
    same = found["conv_id"].eqNullSafe(texts["c"]) & found["turn"].eqNullSafe(texts["t"]) & (found["speaker"] == texts["s"]) & (found["digest"] == texts["d"])
    return found.join(texts, same).select(
        "conv_id", "perspective", "seq", "turn", "role", "name", F.concat("header", "text", F.lit(END)).alias("segment"), (F.col("role") == "assistant").cast("int").alias("mask"),
        "start", "end", "content_start", F.col("end").alias("content_end"),
    )


def dialogues(rotated: DataFrame) -> DataFrame:
    """(conv_id, perspective, text, masks): whole renderings with the masked spans; for conversations known to fit a row."""
    rows = F.array_sort(F.collect_list(F.struct("seq", "segment", "mask", "content_start", "content_end")))
    whole = rotated.groupBy("conv_id", "perspective").agg(rows.alias("s"))
    spans = F.transform(F.filter("s", lambda x: x["mask"] == 1), lambda x: F.struct(x["content_start"].alias("start"), x["content_end"].alias("end")))
    return whole.select("conv_id", "perspective", F.array_join("s.segment", "").alias("text"), spans.alias("masks"))


ORACLE = r"""
WITH t AS (SELECT conv_id, turn, replace(replace(regexp_replace(coalesce(role, 'unknown'), '[\r\n]+', ' ', 'g'), '<|', '<\|'), '|>', '|\>') AS speaker,
  replace(replace(coalesce(text, ''), '<|', '<\|'), '|>', '|\>') AS text FROM conversations),
p AS (SELECT DISTINCT conv_id AS c, speaker AS perspective FROM t WHERE speaker <> 'system'),
e AS (SELECT *, CASE WHEN speaker = 'system' THEN 'system' WHEN speaker = perspective THEN 'assistant' ELSE 'user' END AS role
  FROM t JOIN p ON conv_id IS NOT DISTINCT FROM c),
h AS (SELECT *, CASE WHEN role = 'user' THEN speaker END AS name, '<|' || role || CASE WHEN role = 'user' THEN ' name=' || speaker ELSE '' END || '|>' || chr(10) AS header FROM e),
s AS (SELECT *, header || text || '<|end|>' || chr(10) AS segment FROM h),
o AS (SELECT *, row_number() OVER w - 1 AS seq, coalesce(sum(length(segment)) OVER (PARTITION BY conv_id, perspective ORDER BY turn, speaker, md5(text) ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
  FROM s WINDOW w AS (PARTITION BY conv_id, perspective ORDER BY turn, speaker, md5(text)))
SELECT conv_id, perspective, seq, turn, role, name, segment, CASE WHEN role = 'assistant' THEN 1 ELSE 0 END AS mask, start,
  (start + length(segment))::BIGINT AS "end", (start + length(header))::BIGINT AS content_start, (start + length(segment))::BIGINT AS content_end FROM o
"""
