"""Chat formatting: of logged conversations that grow turn by turn only the longest state is rendered.

All of it is DataFrame functions. A conversation is cut into blocks of turns, so that none is a group of
unbounded size: hashes of turns are combined along each block, and along the blocks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from changetide.llm.common import stored

#: Turns in a block, and in a rendered part.
BLOCK = 1024


def render_turn(role: Column, text: Column) -> Column:
    """A turn between markers; marker openings inside a text are taken apart."""
    return F.concat(F.lit("<|"), role, F.lit("|>\n"), F.replace(text, F.lit("<|"), F.lit("< |")), F.lit("<|end|>\n"))


def turn_prefixes(turns: DataFrame) -> DataFrame:
    """Each turn with its place from 1, the number of turns, and the hash (a, b) of all turns up to it.

    The hash of a prefix is the exclusive or of two 64-bit hashes of each turn with its place, so it
    rolls along with the turns, and blocks can be combined.
    """
    clean = turns.select(
        F.col("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).withColumn("block", F.coalesce(F.floor(F.col("turn") / BLOCK), F.lit(-(1 << 60))))
    in_block = Window.partitionBy("conv_id", "block").orderBy("turn", "role", "text")
    placed = clean.withColumn("row", F.row_number().over(in_block).cast("long"))
    for name, seed in (("h", 1), ("g", 2)):
        placed = placed.withColumn(name, F.xxhash64(F.lit(seed), "block", "row", "turn", "role", "text"))
    so_far = in_block.rowsBetween(Window.unboundedPreceding, 0)
    rolled = placed.withColumns({n: F.expr(f"bit_xor({n})").over(so_far) for n in ("h", "g")})
    totals = placed.groupBy("conv_id", "block").agg(
        F.expr("bit_xor(h)").alias("all_h"), F.expr("bit_xor(g)").alias("all_g"), F.count(F.lit(1)).alias("size")
    )
    blocks = Window.partitionBy("conv_id").orderBy("block")
    before = blocks.rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select(
        F.col("conv_id").alias("conv"),
        F.col("block").alias("of_block"),
        F.coalesce(F.expr("bit_xor(all_h)").over(before), F.lit(0)).alias("base_h"),
        F.coalesce(F.expr("bit_xor(all_g)").over(before), F.lit(0)).alias("base_g"),
        F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base"),
        F.sum("size").over(Window.partitionBy("conv_id")).alias("n_turns"),
    )
    joined = rolled.join(bases, F.col("conv_id").eqNullSafe(F.col("conv")) & (F.col("block") == F.col("of_block")))
    return joined.select(
        "conv_id",
        "role",
        "text",
        (F.col("base") + F.col("row")).alias("place"),
        "n_turns",
        F.col("base_h").bitwiseXOR(F.col("h")).alias("a"),
        F.col("base_g").bitwiseXOR(F.col("g")).alias("b"),
    )


def maximal_conversations(prefixes: DataFrame) -> DataFrame:
    """conv_id of the conversations that are no proper prefix of another; of equal ones the smallest."""
    ends = prefixes.where(F.col("place") == F.col("n_turns")).groupBy("place", "a", "b").agg(F.min("conv_id").alias("conv_id"))
    inner = prefixes.where(F.col("place") < F.col("n_turns")).select("place", "a", "b").distinct()
    return ends.join(inner, ["place", "a", "b"], "left_anti").select("conv_id")


def format_conversations(turns: DataFrame) -> DataFrame:
    """Maximal conversations as text: conv_id, part, n_turns, rendered; a part has up to 1024 turns.

    Turns are compared by number, role and text, in that order, where null counts as empty (a null number
    comes first). Turns with a null conv_id are one conversation. Repeated turns of a conversation
    are turns; conversations repeated under other ids, or being the beginning of another, go.
    Other columns are not read. An empty table gives an empty result.
    """
    prefixes, _ = stored(turn_prefixes(turns), "turns")
    kept = maximal_conversations(prefixes).select(F.col("conv_id").alias("kept"))
    chosen = prefixes.join(kept, F.col("conv_id").eqNullSafe(F.col("kept")), "left_semi")
    part = F.floor((F.col("place") - 1) / BLOCK).cast("long")
    piece = F.struct("place", render_turn(F.col("role"), F.col("text")).alias("shown"))
    return (
        chosen.groupBy("conv_id", part.alias("part"), "n_turns")
        .agg(F.array_sort(F.collect_list(piece)).alias("pieces"))
        .select("conv_id", "part", "n_turns", F.array_join(F.transform("pieces", lambda p: p["shown"]), "").alias("rendered"))
    )


SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn, coalesce(role, ''), coalesce(text, '')) AS place,
    count(*) OVER (PARTITION BY conv_id) AS n_turns
  FROM conversations),
told AS (
  SELECT *, md5(string_agg(concat_ws(':', turn, length(role), length(text), role, text), chr(30))
    OVER (PARTITION BY conv_id ORDER BY place)) AS so_far
  FROM t),
whole AS (SELECT so_far, place, min(conv_id) AS conv_id FROM told WHERE place = n_turns GROUP BY so_far, place),
kept AS (
  SELECT conv_id FROM whole
  WHERE NOT EXISTS (SELECT 1 FROM told WHERE told.so_far = whole.so_far AND told.place < told.n_turns))
SELECT conv_id, (place - 1) // 1024 AS part, n_turns,
  string_agg(concat('<|', role, '|>', chr(10), replace(text, '<|', '< |'), '<|end|>', chr(10)), '' ORDER BY place) AS rendered
FROM t SEMI JOIN kept USING (conv_id)
GROUP BY conv_id, part, n_turns
"""
