"""Repairs the structure of conversations: cheapest edits by integer weights on a DAG."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import crc32_sql, staged

CONV, TURN, ROLE, TEXT = "conv_id", "turn", "role", "text"
#: Turns that are settled together: rows of one sorted partition with equal ``seq >> SHIFT``.
SHIFT = 9

BLANKS = " \t\n\v\f\r"
#: What may follow what: adjacent initials of roles.
LEGAL = {"su", "ua", "au"}
#: States: nothing yet, after a system turn, after a user turn, after an assistant turn.
STATES = range(4)
#: Initial of the role, and the state after it, that a state takes next besides ``s`` at the start.
NEXT = [("u", 2), ("u", 2), ("a", 3), ("u", 2)]
ROLES = {"u": "user", "a": "assistant"}
#: Edits in ASCII order, as digits from 1; 0 pads behind the end, so prefixes come first.
LETTERS = "\0DIKR"
DELETE, INSERT, KEEP, REROLE = 1, 2, 3, 4
DIGIT = 3


class Weights:
    """A path as one integer: its cost, then a fixed number of digits for its edits from the first on.

    The smaller integer is the cheaper path, and of equally cheap ones that whose
    letters come first. Without digits it is the cost alone.
    """

    def __init__(self, digits: int):
        self.bits = DIGIT * digits
        self.mask = (1 << self.bits) - 1
        self.first = 1 << (self.bits - DIGIT) if digits else 0

    def end(self, cost: int) -> int:
        return cost << self.bits

    def before(self, letter: int, cost: int, path: int) -> int:
        """``path`` with one more edit in front of it: costs add up, digits move one place on."""
        return (((path >> self.bits) + cost) << self.bits) + letter * self.first + ((path & self.mask) >> DIGIT)

    def cost(self, path: int) -> int:
        return path >> self.bits

    def letters(self, path: int) -> str:
        digits = path & self.mask
        found = []
        for shift in range(self.bits - DIGIT, -1, -DIGIT):
            if not (digit := digits >> shift & 7):
                break
            found.append(LETTERS[digit])
        return "".join(found)


def _inserted(w: Weights, paths: list[int]) -> list[int]:
    """Paths that may begin with inserted turns, from paths that do not."""
    start, system, user, assistant = paths
    user, assistant = (
        min(user, w.before(INSERT, 2, assistant)),
        min(assistant, w.before(INSERT, 2, user)),
    )
    return [min(start, w.before(INSERT, 2, user)), min(system, w.before(INSERT, 2, user)), user, assistant]


def conversation_end(w: Weights) -> list[int]:
    """Paths behind the last turn: only the start and an assistant turn may end a conversation."""
    never = w.end(1 << 62)
    return _inserted(w, [w.end(0), never, never, w.end(0)])


def settle(w: Weights, codes: str, paths: list[int]) -> list[int]:
    """Best path from each state through turns ``codes``, given those behind them.

    A code is ``!`` for a turn that has to go, else the initial of its role (``?`` for
    others than s, u and a), in upper case if its text is truncated.
    """
    for code in reversed(codes):
        if code == "!":
            # The same letter and cost before every path: with what may be inserted first.
            paths = [w.before(DELETE, 3, path) for path in paths]
        else:
            more = int(code.isupper() or code == "~")
            initial = code.lower()
            taken = []
            for state in STATES:
                fits, then = NEXT[state]
                best = min(w.before(DELETE, 3, paths[state]), w.before(REROLE, 2 + more, paths[then]))
                if initial == fits:
                    best = min(best, w.before(KEEP, more, paths[then]))
                if initial == "s" and state == 0:
                    best = min(best, w.before(KEEP, more, paths[1]))
                taken.append(best)
            paths = taken
        paths = _inserted(w, paths)
    return paths


def _after(state: int, codes: str, letters: str) -> int:
    """State after the edits ``letters`` of turns ``codes``."""
    turns = iter(codes)
    for letter in letters:
        code = "" if letter == "I" else next(turns)
        if letter != "D":
            state = 1 if letter == "K" and code.lower() == "s" else NEXT[state][1]
    return state


def damaged(conversations: DataFrame) -> DataFrame:
    """Turns with planted faults, chosen by the crc32 of ``conv_id:turn`` (nulls: a blank) modulo 20.

    0 drops the turn, 1 empties its text, 2 removes ``.!?`` from it, 3 repeats the
    turn, 4 gives it to the user. Null roles and texts become one blank.
    """
    key = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (CONV, TURN)]
    rows = conversations.select(
        CONV,
        TURN,
        F.coalesce(ROLE, F.lit(" ")).alias(ROLE),
        F.coalesce(TEXT, F.lit(" ")).alias(TEXT),
        (F.crc32(F.concat(key[0], F.lit(":"), key[1]).cast("binary")) % 20).alias("fault"),
    ).where("fault <> 0")
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.regexp_replace(TEXT, "[.!?]", ""))
    role = F.when(F.col("fault") == 4, "user").otherwise(F.col(ROLE))
    times = F.explode(F.sequence(F.lit(1), F.when(F.col("fault") == 3, 2).otherwise(1)))
    rows = rows.select(CONV, TURN, role.alias(ROLE), text.otherwise(F.col(TEXT)).alias(TEXT), times.alias("times"))
    return rows.drop("times")


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """Turns with ``seq``, which ascends by conversation, turn (nulls first), role and text.

    Ranges are cut by all of these and a random number, so neither a long
    conversation nor a turn that is repeated very often lands in one task. Written once.
    """
    order = [CONV, TURN, ROLE, TEXT, "salt"]
    rows = conversations.select(
        CONV,
        TURN,
        F.coalesce(ROLE, F.lit(" ")).alias(ROLE),
        F.coalesce(TEXT, F.lit(" ")).alias(TEXT),
        F.rand(1).alias("salt"),
    )
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("salt")
    return staged(dealt.withColumn("seq", F.monotonically_increasing_id()), "turns")


def _chunk() -> Column:
    return F.shiftright("seq", SHIFT).alias("chunk")


def _segments(rows: DataFrame) -> DataFrame:
    """(conv_id, chunk, turns, firsts): codes of up to 512 turns, and which of them are no duplicates."""
    bare = F.rtrim(F.col(TEXT), F.lit(BLANKS))
    initial = F.left(ROLE, F.lit(1))
    code = F.concat(
        F.when(initial.isin("s", "u", "a"), initial).otherwise("?"),
        F.when(bare == "", "b").when(F.right(bare, F.lit(1)).isin(".", "!", "?"), "-").otherwise("t"),
    )
    same = F.sha2(F.concat(F.length(ROLE), F.lit(":"), ROLE, TEXT), 256)
    compact = rows.select(CONV, "seq", code.alias("code"), F.unhex(same).alias("same"))
    firsts = compact.groupBy(CONV, "same").agg(F.min("seq").alias("seq"))
    both = compact.select(CONV, "seq", "code").unionByName(firsts.select(CONV, "seq"), allowMissingColumns=True)
    turn = F.when(F.col("code").isNotNull(), F.struct("seq", "code"))
    first = F.when(F.col("code").isNull(), F.col("seq"))
    return both.groupBy(CONV, _chunk()).agg(
        F.sort_array(F.collect_list(turn)).alias("turns"), F.collect_list(first).alias("firsts")
    )


def _mapped(df: DataFrame, function, **columns: str) -> DataFrame:
    """Keys of ``df``, its columns named with an empty type, and new ones that ``function`` yields row by row.

    ``function`` makes a generator that is sent the rows of a partition in order and
    yields a tuple for each.
    """
    kept = [CONV, "chunk", *(c for c in df.columns if c in columns and columns[c] == "")]
    new = {c: kind for c, kind in columns.items() if kind}
    kinds = {c: df.schema[c].dataType.simpleString() for c in kept} | new
    schema = ", ".join(f"{c} {kind}" for c, kind in kinds.items())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = function()
        next(step)
        for batch in batches:
            found = [step.send(row) for row in batch.to_pylist()]
            values = list(zip(*found)) or [()] * len(new)
            arrays = [batch.column(batch.schema.get_field_index(c)) for c in kept]
            arrays += [pa.array(list(v), _arrow(kind)) for v, kind in zip(values, new.values())]
            yield pa.record_batch(arrays, [*kept, *new])

    return df.mapInArrow(run, schema)


def _arrow(kind: str) -> pa.DataType:
    plain = {"bigint": pa.int64(), "string": pa.string(), "int": pa.int32()}
    return pa.list_(plain[kind[6:-1]]) if kind.startswith("array") else plain[kind]


def _measure():
    """Faults of a segment, its codes, and the least cost from each state before it to each behind it."""
    found, w = None, Weights(0)
    never = 1 << 50
    while True:
        row = yield found
        firsts = set(row["firsts"])
        faults, codes = [0, 0, 0], []
        for turn in row["turns"]:
            initial, fault = turn["code"]
            kind = 0 if fault == "b" else 1 if turn["seq"] not in firsts else 2 if fault == "t" else 3
            if kind < 3:
                faults[kind] += 1
            late = "~" if initial == "?" else initial.upper()
            codes.append("!" if kind < 2 else late if kind == 2 else initial)
        initials = "".join(turn["code"][0] for turn in row["turns"])
        illegal = sum(a + b not in LEGAL for a, b in zip(initials, initials[1:]))
        joined = "".join(codes)
        ends = [[0 if end == state else never for state in STATES] for end in STATES]
        costs = list(zip(*(settle(w, joined, end) for end in ends)))
        found = (joined, *faults, illegal, initials[0], initials[-1], [x for line in costs for x in line])


def _costs_to_go():
    """Least cost from each state behind a segment to the end; segments come from the last to the first."""
    found, conv, now = None, object(), None
    w = Weights(0)
    while True:
        row = yield found
        last = row[CONV] != conv
        if last:
            conv, now = row[CONV], conversation_end(w)
        behind = now
        costs = row["costs"]
        now = [min(costs[4 * state + end] + behind[end] for end in STATES) for state in STATES]
        found = (behind, int(last), now[0])


def _audits():
    """Edits of a segment from each state before it, and the state they lead to."""
    found = None
    while True:
        row = yield found
        codes = row["codes"]
        w = Weights(3 * len(codes) + 2)
        ends = conversation_end(w) if row["last"] else [w.end(cost) for cost in row["togo"]]
        letters = [w.letters(path) for path in settle(w, codes, ends)]
        found = (letters, [_after(state, codes, x) for state, x in zip(STATES, letters)])


def _chosen():
    """The state before each segment, from the first on, and with it the segment's edits."""
    found, conv, state, tail = None, object(), 0, ""
    while True:
        row = yield found
        first = row[CONV] != conv
        if first:
            conv, state = row[CONV], 0
        joint = 0 if first else int(tail + row["head"] not in LEGAL)
        found = (row["letters"][state], state, row["illegal"] + joint, row["total"] if first else 0)
        state, tail = row["ends"][state], row["tail"]


def edits(rows: DataFrame) -> DataFrame:
    """(conv_id, chunk, blank, duplicate, truncated, illegal, cost, audit, state): cheapest edits by segment.

    Segments of up to 512 turns are settled in parallel, with integers whose
    digits hold the edits of one segment. What lies behind a segment enters by
    its cost from each state alone; equal costs are told apart by the first
    letter that differs, which is found before the segment ends. Only one row per
    segment passes along a conversation, backwards for these costs and forwards
    for the states.
    """
    measured = _mapped(
        _segments(rows),
        _measure,
        codes="string",
        blank="bigint",
        duplicate="bigint",
        truncated="bigint",
        illegal="bigint",
        head="string",
        tail="string",
        costs="array<bigint>",
    )
    faults = {c: "" for c in ("codes", "blank", "duplicate", "truncated", "illegal", "head", "tail")}
    back = measured.repartition(CONV).sortWithinPartitions(CONV, F.desc("chunk"))
    behind = _mapped(back, _costs_to_go, **faults, togo="array<bigint>", last="int", total="bigint")
    split = behind.repartition(CONV, "chunk")
    found = _mapped(split, _audits, **faults, total="", letters="array<string>", ends="array<int>")
    ahead = found.repartition(CONV).sortWithinPartitions(CONV, "chunk")
    faults = {c: "" for c in ("blank", "duplicate", "truncated")}
    chosen = _mapped(ahead, _chosen, **faults, audit="string", state="int", illegal="bigint", cost="bigint")
    return staged(chosen, "edits")


def conversation_report(rows: DataFrame, edited: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit), one row per conversation with turns."""
    sums = [F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")]
    audit = F.array_join(F.sort_array(F.collect_list(F.struct("chunk", "audit"))).getField("audit"), "")
    faults = edited.groupBy(CONV).agg(*sums, audit.alias("audit"))
    turns = rows.groupBy(CONV, TURN).agg(F.lit(1).alias("one")).groupBy(CONV)
    turns = turns.agg(F.max(TURN).alias("high"), F.min(TURN).alias("low"), F.count(TURN).alias("n"))
    span = F.expr("try_cast(cast(high as decimal(38, 0)) - low + 1 - n as bigint)")
    gaps = turns.select(F.col(CONV).alias("of"), F.when(F.col("n") == 0, 0).otherwise(span).alias("gaps"))
    return faults.join(gaps, faults[CONV].eqNullSafe(gaps["of"])).drop("of")


def _repair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Turns after the edits; a segment's edits come before its turns."""
    conv, edits_, place, state = None, "", 0, 0

    def take(out: list, row: dict | None) -> None:
        """Edits up to the one that spends ``row``; all that are left without one."""
        nonlocal place, state
        while place < len(edits_):
            letter = edits_[place]
            if letter != "I" and row is None:
                raise ValueError("an edit without a turn")
            place += 1
            if letter != "D":
                system = letter == "K" and row[ROLE][:1] == "s"
                initial, then = ("s", 1) if system else NEXT[state]
                state = then
                role = row[ROLE] if letter == "K" else ROLES[initial]
                out.append((conv, role, "" if letter == "I" else row[TEXT]))
            if letter != "I":
                return

    for batch in batches:
        kind = batch.schema.field(CONV).type
        out: list = []
        for row in batch.to_pylist():
            if row["audit"] is not None:
                take(out, None)
                conv, edits_, place, state = row[CONV], row["audit"], 0, row["state"]
            else:
                take(out, row)
        yield pa.record_batch(
            [pa.array([x[i] for x in out], t) for i, t in enumerate((kind, pa.string(), pa.string()))],
            [CONV, ROLE, TEXT],
        )
    out = []
    take(out, None)
    if out:
        yield pa.record_batch(
            [pa.array([x[i] for x in out], t) for i, t in enumerate((kind, pa.string(), pa.string()))],
            [CONV, ROLE, TEXT],
        )


def repaired_turns(rows: DataFrame, edited: DataFrame) -> DataFrame:
    """(conv_id, role, text): turns after the edits, those of a conversation together and in order.

    Turns stream through a task, no conversation is held.
    """
    both = rows.select(CONV, _chunk(), "seq", ROLE, TEXT).unionByName(
        edited.select(CONV, "chunk", "audit", "state"), allowMissingColumns=True
    )
    ordered = both.repartition(CONV).sortWithinPartitions(CONV, "chunk", F.col("seq").asc_nulls_first())
    kind = rows.schema[CONV].dataType.simpleString()
    return ordered.mapInArrow(_repair, f"{CONV} {kind}, {ROLE} string, {TEXT} string")


def turn_digests(turns: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256): sha256 of ``role:text`` lines of turns in the order ``repaired_turns`` gives."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, digest, kind = None, None, None
        for batch in batches:
            kind, ids, values = batch.schema.field(CONV).type, [], []
            for of, role, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                line = f"{role}:{text}".encode("utf-8", "surrogatepass")
                if digest is None or of != conv:
                    if digest is not None:
                        ids.append(conv)
                        values.append(digest.hexdigest())
                    conv, digest = of, hashlib.sha256(line)
                else:
                    digest.update(b"\n" + line)
            yield pa.record_batch([pa.array(ids, kind), pa.array(values, pa.string())], [CONV, "repaired_sha256"])
        if digest is not None:
            last = [pa.array([conv], kind), pa.array([digest.hexdigest()], pa.string())]
            yield pa.record_batch(last, [CONV, "repaired_sha256"])

    kind = turns.schema[CONV].dataType.simpleString()
    return turns.mapInArrow(run, f"{CONV} {kind}, repaired_sha256 string")


def repair_conversations(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Report per conversation, and the repaired turns.

    Turns of a conversation are taken by number (nulls first), then role and
    text; nulls in role and text count as one blank. A turn is blank if its text
    has nothing but ASCII white space, else a duplicate if role and text stood
    earlier in the conversation, else truncated if its last other character is
    none of ``.!?``. illegal counts neighbours whose initials are not su, ua or au;
    gaps the numbers missing between the least and the greatest turn.

    Edits: keep (K, 0), give to user or assistant (R, 2), delete (D, 3, required
    for blank and duplicate turns), insert an empty user or assistant turn (I, 2);
    a truncated turn that stays adds 1. The cheapest edits that leave an optional
    system turn and then user and assistant in turns, or nothing, make the
    ``audit``, the least in ASCII order if several are equally cheap. A turn whose
    role is empty or starts with another letter has to be given away or deleted.

    Rows without conv_id are one conversation of their own. Rows that are
    repeated in full are duplicates. Other columns are ignored; an empty table
    gives empty results.
    """
    rows = ordered_turns(conversations)
    edited = edits(rows)
    return conversation_report(rows, edited), repaired_turns(rows, edited)


def repair_query(conversations: DataFrame) -> DataFrame:
    """Report on every conversation of the table after ``damaged``, with a digest of the repaired turns."""
    report, turns = repair_conversations(damaged(conversations))
    every = conversations.select(F.col(CONV).alias("id")).distinct()
    digests = turn_digests(turns).withColumnRenamed(CONV, "of")
    found = every.join(report, F.col("id").eqNullSafe(F.col(CONV)), "left")
    found = found.join(digests, F.col("id").eqNullSafe(F.col("of")), "left")
    numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return found.select(
        F.col("id").alias(CONV),
        *(F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in numbers),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
    )


def _option(letter: str, cost: str, line: str, path: str, condition: str = "") -> str:
    """SQL: ``path`` with one more edit in front of it."""
    made = f"{{'c': {path}.c + {cost}, 'a': '{letter}' || {path}.a, 'r': {line}{path}.r}}"
    return f"CASE WHEN {condition} THEN {made} END" if condition else made


def _turn(state: int) -> str:
    """SQL: the best path through a turn from one state."""
    fits, then = NEXT[state]
    here, path = f"p.v{state}", f"p.v{then}"
    kept = "chr(10) || role || ':' || text || "
    options = [
        _option("D", "3", "", here),
        _option("R", "2 + late", f"chr(10) || '{ROLES[fits]}:' || text || ", path, "stays"),
        _option("K", "late", kept, path, f"stays AND initial = '{fits}'"),
    ]
    if state == 0:
        options.append(_option("K", "late", kept, "p.v1", "stays AND initial = 's'"))
    return f"list_min([{', '.join(options)}]) AS w{state}"


def _insert(role: str, path: str) -> str:
    return _option("I", "2", f"chr(10) || '{role}:' || ", path)


REPAIR_SQL = f"""
WITH RECURSIVE keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {crc32_sql("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS fault
  FROM conversations
), damaged AS (
  SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
         CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM keyed, range(2) AS again(k) WHERE fault <> 0 AND (k = 0 OR fault = 3)
), placed AS (
  SELECT *, left(role, 1) AS initial, NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank,
         regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') AS ended,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
         count(*) OVER (PARTITION BY conv_id) AS n
  FROM damaged
), known AS (
  SELECT *, min(i) OVER (PARTITION BY conv_id, role, text) < i AS seen FROM placed
), turns AS (
  SELECT *, NOT blank AND NOT seen AS stays, CAST(NOT ended AS BIGINT) AS late,
         lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial NOT IN ('su', 'ua', 'au') AS illegal
  FROM known
), paths AS (
  SELECT DISTINCT conv_id, n + 1 AS i, {{'c': CAST(0 AS BIGINT), 'a': '', 'r': ''}} AS v0,
         {{'c': CAST(4 AS BIGINT), 'a': 'II', 'r': chr(10) || 'user:' || chr(10) || 'assistant:'}} AS v1,
         {{'c': CAST(2 AS BIGINT), 'a': 'I', 'r': chr(10) || 'assistant:'}} AS v2,
         {{'c': CAST(0 AS BIGINT), 'a': '', 'r': ''}} AS v3
  FROM turns
  UNION ALL
  SELECT conv_id, i, list_min([w0, {_insert("user", "v2")}]), list_min([w1, {_insert("user", "v2")}]), v2, v3
  FROM (
    SELECT *, list_min([w2, {_insert("assistant", "w3")}]) AS v2, list_min([w3, {_insert("user", "w2")}]) AS v3
    FROM (
      SELECT t.conv_id, t.i, {", ".join(_turn(state) for state in STATES)}
      FROM paths p JOIN turns t ON p.conv_id IS NOT DISTINCT FROM t.conv_id AND p.i = t.i + 1
    )
  )
), faults AS (
  SELECT conv_id, CASE WHEN count(turn) = 0 THEN 0 ELSE max(turn) - min(turn) + 1 - count(DISTINCT turn) END AS gaps,
         count(*) FILTER (WHERE blank) AS blank, count(*) FILTER (WHERE NOT blank AND seen) AS duplicate,
         count(*) FILTER (WHERE stays AND NOT ended) AS truncated, count(*) FILTER (WHERE illegal) AS illegal
  FROM turns GROUP BY conv_id
)
SELECT e.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank,
       coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
       coalesce(p.v0.c, 0) AS cost, coalesce(p.v0.a, '') AS audit, sha256(coalesce(substr(p.v0.r, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) e
LEFT JOIN faults f ON e.conv_id IS NOT DISTINCT FROM f.conv_id
LEFT JOIN paths p ON e.conv_id IS NOT DISTINCT FROM p.conv_id AND p.i = 1
"""
