"""Collapses cumulative snapshots of conversations and renders the rest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import staged

CONV, TURN, ROLE, TEXT = "conv_id", "turn", "role", "text"


def _turns(conversations: DataFrame) -> DataFrame:
    return conversations.where(F.col(CONV).isNotNull()).select(
        CONV,
        TURN,
        F.coalesce(F.col(ROLE), F.lit("")).alias(ROLE),
        F.coalesce(F.col(TEXT), F.lit("")).alias(TEXT),
    )


#: Turns of one sorted partition with equal ``seq >> SHIFT`` are numbered and hashed together.
SHIFT = 9


def _ordered(conversations: DataFrame) -> DataFrame:
    """(conv_id, c, d, seq): different turns by content hash; ``seq`` ascends by turn, role and text.

    Only hashes are shuffled, and the texts of those turns alone whose number
    stands for several contents. Ranges are cut by conversation and turn, so a
    long conversation lies in many tasks. Written once.
    """
    turns = _turns(conversations).withColumns(
        {"c": F.xxhash64(ROLE, TEXT), "d": F.xxhash64(TEXT, F.lit(7), ROLE)}
    )
    content = turns.select(CONV, TURN, "c", "d").distinct()
    shared = content.groupBy(CONV, TURN).agg(F.count("*").alias("n")).where("n > 1")
    shared = shared.select(F.col(CONV).alias("of"), F.col(TURN).alias("at"))
    tied = turns.join(shared, (F.col(CONV) == F.col("of")) & F.col(TURN).eqNullSafe(F.col("at")), "left_semi")
    by_content = Window.partitionBy(CONV, TURN).orderBy(ROLE, TEXT)
    ranked = tied.select(CONV, TURN, ROLE, TEXT, "c", "d").distinct().withColumn("tie", F.row_number().over(by_content))
    ranked = ranked.select(
        F.col(CONV).alias("of"), F.col(TURN).alias("at"), F.col("c").alias("c2"), F.col("d").alias("d2"), "tie"
    )
    same = (
        (F.col(CONV) == F.col("of"))
        & F.col(TURN).eqNullSafe(F.col("at"))
        & (F.col("c") == F.col("c2"))
        & (F.col("d") == F.col("d2"))
    )
    numbered = content.join(ranked, same, "left").select(CONV, TURN, F.coalesce("tie", F.lit(1)).alias("tie"), "c", "d")
    order = [CONV, TURN, "tie"]
    dealt = numbered.repartitionByRange(*order).sortWithinPartitions(*order)
    return staged(dealt.select(CONV, "c", "d", F.monotonically_increasing_id().alias("seq")), "chat-turns")


def prefix_hashes(conversations: DataFrame) -> DataFrame:
    """(conv_id, k, a, b, last): the rolling hash of the first k turns, 128 bits.

    The hash of a prefix is the XOR of one hash per turn that holds the turn's
    place and content. Places and sums roll on inside chunks of up to 512 turns;
    what comes before a chunk is added from one row per chunk.
    """
    turns = _ordered(conversations).withColumn("chunk", F.shiftright("seq", SHIFT))
    in_chunk = Window.partitionBy(CONV, "chunk").orderBy("seq")
    earlier = Window.partitionBy(CONV).orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)

    def before(totals: DataFrame, **columns: Column) -> DataFrame:
        """Totals of the chunks before each chunk, 0 for the first."""
        return totals.select(CONV, "chunk", *(F.coalesce(c.over(earlier), F.lit(0)).alias(n) for n, c in columns.items()))

    sizes = before(turns.groupBy(CONV, "chunk").agg(F.count("*").alias("n")), offset=F.sum("n"))
    local = turns.withColumn("k", F.row_number().over(in_chunk))
    placed = local.join(sizes, [CONV, "chunk"]).withColumn("k", F.col("k") + F.col("offset"))
    placed = placed.select(
        CONV, "chunk", "seq", "k", F.xxhash64("k", "c", "d").alias("x"), F.xxhash64("d", "c", "k").alias("y")
    )
    sums = placed.groupBy(CONV, "chunk").agg(F.expr("bit_xor(x)").alias("x"), F.expr("bit_xor(y)").alias("y"), F.max("k").alias("k"))
    ends = sums.groupBy(CONV).agg(F.max("k").alias("n_turns"))
    sums = before(sums, x0=F.expr("bit_xor(x)"), y0=F.expr("bit_xor(y)")).join(ends, CONV)
    so_far = in_chunk.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rolling = placed.withColumns({"a": F.expr("bit_xor(x)").over(so_far), "b": F.expr("bit_xor(y)").over(so_far)})
    return rolling.join(sums, [CONV, "chunk"]).select(
        CONV,
        "k",
        F.col("a").bitwiseXOR(F.col("x0")).alias("a"),
        F.col("b").bitwiseXOR(F.col("y0")).alias("b"),
        (F.col("k") == F.col("n_turns")).alias("last"),
    )


def maximal_conversations(conversations: DataFrame) -> DataFrame:
    """conv_ids that no longer conversation starts with; of equal ones the smallest."""
    hashes = prefix_hashes(conversations)
    whole = hashes.where("last").groupBy("k", "a", "b").agg(F.min(CONV).alias(CONV))
    begun = hashes.where(~F.col("last")).select("k", "a", "b").distinct()
    return whole.join(begun, ["k", "a", "b"], "left_anti").select(CONV)


def render_conversations(conversations: DataFrame) -> DataFrame:
    """(conv_id, n_turns, rendered) of the maximal conversations.

    A conversation that equals the first turns of a longer one is a snapshot of
    it and goes; of equal conversations the smallest conv_id stays. Turns are
    ordered by number, then by role and text. Each turn is rendered as
    ``<|im_start|>role``, a line break, the text and ``<|im_end|>``. Only the
    rendering, which is one string, gathers a conversation.

    Turns without conv_id belong to no conversation and are left out. Null role
    or text counts as empty, a null turn number comes first. Rows that repeat a
    turn, content included, count once. Other columns are ignored.
    """
    kept = maximal_conversations(conversations)
    rows = _turns(conversations).join(kept, CONV, "left_semi")
    turn = F.struct(TURN, ROLE, TEXT)
    line = "concat('<|im_start|>', x.role, chr(10), x.text, '<|im_end|>', chr(10))"
    return (
        rows.groupBy(CONV)
        .agg(F.sort_array(F.collect_set(turn)).alias("turns"))
        .select(
            CONV,
            F.size("turns").cast("long").alias("n_turns"),
            F.expr(f"array_join(transform(turns, x -> {line}), '')").alias("rendered"),
        )
    )


CHAT_SQL = """
WITH turns AS (
  SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
  SELECT conv_id, count(*) AS n_turns,
         list('<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10)
              ORDER BY turn NULLS FIRST, role, text) AS parts
  FROM turns GROUP BY conv_id
), same AS (
  SELECT min(conv_id) AS conv_id, n_turns, parts FROM convs GROUP BY n_turns, parts
)
SELECT conv_id, n_turns, array_to_string(parts, '') AS rendered
FROM same s
WHERE NOT EXISTS (SELECT 1 FROM same l
                  WHERE l.parts[1] = s.parts[1] AND l.n_turns > s.n_turns
                    AND l.parts[1:s.n_turns] = s.parts)
"""
