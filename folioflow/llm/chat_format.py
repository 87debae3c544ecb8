"""Chat formatting: conversations logged as growing snapshots collapse to the longest, which are then rendered.

Every turn has two 64-bit hashes of its place, role and text. Their running sums over a conversation identify each
prefix, because a sum over places says which turn stands where. A conversation is dropped if its whole sum is that
of a proper prefix of another one (an anti-join), or if it equals a conversation with a smaller id.

Turns are put in order by range, whatever conversation they belong to, and written with a number that rises with the
order. A long conversation lies in several ranges; it is numbered and summed range by range, and what its earlier ranges
hold is added. Only the first conversation of a range can have earlier ones, so these additions are one row a
range and are broadcast. Rendering writes blocks of ``block_turns`` turns, counted by place: a conversation of at
most so many is one row.

Only DataFrame functions are used. Turns are ordered by turn, role and text (null first; texts by their first ``HEAD``
characters and then by md5), and repeated rows count as turns of their own, dealt to ranges by a number of their own.
Null roles render as ``unknown`` and null texts as empty, but differ from such values when compared. All rows with a
null conversation id are one conversation. An empty table gives an empty result. Only the four named columns are
read, so others cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from folioflow.llm.common import kept

HEAD = 256
# Text of a range.
RANGE_BYTES = 96 << 20
BLOCK_TURNS = 512
START, BETWEEN, END = "<|im_start|>", "\n", "<|im_end|>\n"
SUMS = ["a_low", "a_high", "b_low", "b_high"]


def halves(name: str, hashed: Column) -> list[Column]:
    """A 64-bit hash as two non-negative numbers, whose sums cannot run over."""
    return [hashed.bitwiseAND(0xFFFFFFFF).alias(f"{name}_low"), F.shiftrightunsigned(hashed, 32).alias(f"{name}_high")]


def in_order(df: DataFrame, conv_id: str, turn: str, role: str, text: str, range_bytes: int) -> DataFrame:
    """conv_id, role, text, slice (the range) and at (a number that rises with the order) of every turn, written."""
    said = df.select(
        F.col(conv_id).cast("bigint").alias("conv_id"),
        F.col(turn).cast("bigint").alias("turn"),
        F.col(role).cast("string").alias("role"),
        F.col(text).cast("string").alias("text"),
    )
    size = said.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(df.sparkSession.sparkContext.defaultParallelism, -(-size // range_bytes))
    keys = {"head": F.substring("text", 1, HEAD), "md5": F.md5("text"), "row": F.monotonically_increasing_id()}
    order = ["conv_id", "turn", "role", *keys]
    ranged = said.withColumns(keys).repartitionByRange(n, *order).sortWithinPartitions(*order)
    return kept(ranged.select("conv_id", "role", "text", F.spark_partition_id().alias("slice"), F.monotonically_increasing_id().alias("at")), "turns")


def joined(left: DataFrame, right: DataFrame, *keys: str, how: str = "inner") -> DataFrame:
    """Join on keys that may be null."""
    other = right.select(*(F.col(k).alias(f"_r_{k}") if k in keys else F.col(k) for k in right.columns))
    same = [left[k].eqNullSafe(other[f"_r_{k}"]) for k in keys]
    return left.join(other, same, how).drop(*(f"_r_{k}" for k in keys))


def earlier(parts: DataFrame, *sums: str) -> DataFrame:
    """For the parts of conversations that began in an earlier range, the sums over those (``o_``): a row a range at most."""
    before = W.partitionBy("conv_id").orderBy("slice").rowsBetween(W.unboundedPreceding, -1)
    added = parts.select("conv_id", "slice", *(F.sum(c).over(before).alias(f"o_{c}") for c in sums))
    return added.filter(F.col(f"o_{sums[0]}").isNotNull())


def prefixes(turns: DataFrame) -> DataFrame:
    """at, conv_id, n (turns of the prefix), n_turns (of the conversation) and the sums, for every prefix."""
    sizes = kept(turns.groupBy("conv_id", "slice").agg(F.count("*").alias("size")), "sizes")
    bases = kept(earlier(sizes, "size"), "bases")
    # Conversations in several ranges: fewer than ranges.
    long = joined(sizes, bases.select("conv_id").distinct(), "conv_id").groupBy("conv_id").agg(F.sum("size").alias("whole"))
    here = W.partitionBy("conv_id", "slice").orderBy("at")
    either = [F.coalesce(F.col(c), F.lit("")) for c in ("role", "text")] + [F.col(c).isNull() for c in ("role", "text")]
    hashed = turns.select("conv_id", "slice", "at", F.xxhash64(F.lit(1), *either).alias("ha"), F.xxhash64(F.lit(2), *reversed(either)).alias("hb"))
    counted = hashed.withColumns({"nth": F.row_number().over(here), "all_here": F.count("*").over(W.partitionBy("conv_id", "slice"))})
    placed = joined(counted, F.broadcast(bases), "conv_id", "slice", how="left").withColumn("n", F.col("nth") + F.coalesce("o_size", F.lit(0)))
    summed = placed.select("conv_id", "slice", "at", "n", "all_here", *halves("a", F.xxhash64("n", "ha")), *halves("b", F.xxhash64("n", "hb")))
    running = here.rowsBetween(W.unboundedPreceding, 0)
    runs = kept(summed.select("conv_id", "slice", "at", "n", "all_here", *(F.sum(c).over(running).alias(c) for c in SUMS)), "running")
    totals = joined(runs, F.broadcast(long), "conv_id").groupBy("conv_id", "slice").agg(*(F.max(c).alias(c) for c in SUMS))
    added = joined(runs, F.broadcast(earlier(totals, *SUMS)), "conv_id", "slice", how="left")
    whole = joined(added, F.broadcast(long), "conv_id", how="left")
    n_turns = F.coalesce("whole", "all_here").alias("n_turns")
    return whole.select("at", "conv_id", "n", n_turns, *((F.col(c) + F.coalesce(f"o_{c}", F.lit(0))).alias(c) for c in SUMS))


def maximal(runs: DataFrame) -> DataFrame:
    """conv_id of the conversations that are no prefix of another and no copy of one with a smaller id."""
    whole = runs.filter(F.col("n") == F.col("n_turns")).groupBy("n", *SUMS).agg(F.min("conv_id").alias("conv_id"))
    shorter = runs.filter(F.col("n") < F.col("n_turns")).select("n", *SUMS).distinct()
    return whole.join(shorter, ["n", *SUMS], "left_anti").select("conv_id")


def render(turns: DataFrame, runs: DataFrame, convs: DataFrame, block_turns: int) -> DataFrame:
    """The turns of ``convs`` as marked text: conv_id, part, n_turns, text."""
    shown = F.concat(F.lit(START), F.coalesce(F.col("role"), F.lit("unknown")), F.lit(BETWEEN), F.coalesce(F.col("text"), F.lit("")), F.lit(END))
    wanted = joined(runs.select("at", "conv_id", "n", "n_turns"), convs, "conv_id")
    said = wanted.join(turns.select("at", shown.alias("shown")), "at")
    part = F.floor((F.col("n") - 1) / block_turns).cast("int").alias("part")
    blocks = said.groupBy("conv_id", part, "n_turns").agg(F.array_sort(F.collect_list(F.struct("n", "shown"))).alias("said"))
    return blocks.select("conv_id", "part", "n_turns", F.array_join(F.transform("said", lambda s: s["shown"]), "").alias("text"))


def collapse_and_render(
    df: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", block_turns: int = BLOCK_TURNS, range_bytes: int = RANGE_BYTES
) -> DataFrame:
    """Maximal conversations, rendered: conv_id, part, n_turns, text."""
    turns = in_order(df, conv_id, turn, role, text, range_bytes)
    runs = kept(prefixes(turns), "prefixes")
    return render(turns, runs, maximal(runs), block_turns)


# Conversations of up to BLOCK_TURNS turns, as all of the given tables are, make one part each.
ORACLE = f"""
WITH turns AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, substring(text, 1, {HEAD}) NULLS FIRST, md5(text)) AS n,
         '{START}' || coalesce(role, 'unknown') || chr(10) || coalesce(text, '') || '{END[:-1]}' || chr(10) AS shown
  FROM conversations),
runs AS (
  SELECT conv_id, n, count(*) OVER (PARTITION BY conv_id) AS n_turns,
         string_agg(shown, '') OVER (PARTITION BY conv_id ORDER BY n ROWS UNBOUNDED PRECEDING) AS text
  FROM turns),
whole AS (SELECT min(conv_id) AS conv_id, n_turns, text FROM runs WHERE n = n_turns GROUP BY n_turns, text)
SELECT conv_id, CAST(0 AS INT) AS part, n_turns, text FROM whole
WHERE NOT EXISTS (SELECT 1 FROM runs r WHERE r.n < r.n_turns AND r.n = whole.n_turns AND r.text = whole.text)"""
