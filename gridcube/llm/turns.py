"""Repair of conversations: the cheapest edits that make the turns alternate.

A sound conversation is ``(s?(ua)+)?`` in the initials of its roles. Its turns are aligned with every feasible
length of that alternating string by Wagner and Fischer's table: a turn is kept (K), given the role that the string
asks for (R) or deleted (D), and a missing turn is inserted (I). The cost of the best alignment so far, the
incumbent, leaves of each table only the diagonals from which it can still be reached (Ukkonen's band), and no length at
all that needs more insertions or deletions than it pays. Each table is walked back to its least audit, the
string of edits, and cost and audit together decide between lengths. Turns that must go, blank ones and
duplicates, go first of what may stand in their place, as D is the least of the letters, so the tables are made without them.

A conversation is cut into blocks of at most 32 turns. A block is aligned from every phase of the string in which it can
begin to every phase in which it can end, anywhere in the cluster, and the blocks of a conversation are then chained in
order by cost and audit. Two audits of one block and cost never begin one with the other (what one had more would be
insertions, and cost more), so the least of the whole is made of the least of the parts. Most conversations are one block.

Turns are ordered by windows of Spark, which spill; a task that chains holds a letter per edit, never a text. Repaired
texts are hashed or handed out while they stream by in order, each block behind its audit.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridcube.llm.common import Remembered, bucket_of, kept, slices, small_batches

BLOCK = 32
KEEP, REROLE, DELETE, INSERT, CUT = 0, 2, 3, 2, 1
SOUND = "[^\\x20\\x09-\\x0D]"
REMEMBERED = 50_000  # blocks a worker remembers in each of two generations

# Phases of the string: nothing yet; after s; after u; after a.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
# What may follow a phase: the string as far as it goes, by the phases it may start from.
STRINGS = {NOTHING: ("ua", "s"), SYSTEM: ("ua",), USER: ("au",), ASSISTANT: ("ua",)}
ENDS = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
FINAL = (NOTHING, ASSISTANT)


def symbols(start: str, length: int) -> str:
    """The alternating string of a length: uaua.., auau.., or s and then uaua..."""
    if start == "s":
        return ("s" + "ua" * length)[:length]
    return (start * length)[:length]


def aligned(turns: str, target: str, most: int) -> tuple[int, str] | None:
    """The cheapest edits of turns into the target, least audit among equals; None if they cost more than ``most``.

    ``turns`` has the initial of every turn, as a capital where the text is cut off. The table runs from the ends
    towards the beginnings, so that walking it forward finds the least audit.
    """
    n, m = len(turns), len(target)

    def toll(d: int) -> int:
        """What moving by d diagonals costs at the least: insertions one way, deletions the other."""
        return INSERT * d if d > 0 else -DELETE * d

    low, high = min(0, m - n), max(0, m - n)
    if toll(m - n) > most:
        return None
    while toll(low - 1) + toll(m - n - low + 1) <= most and low > -n:
        low -= 1
    while toll(high + 1) + toll(m - n - high - 1) <= most and high < m:
        high += 1
    far, width = 1 << 60, high - low + 1
    # table[i][d - low]: turns from i on against the target from i + d on
    table = [[far] * (width + 1) for _ in range(n + 1)]
    for i in range(n, -1, -1):
        row, below = table[i], table[i + 1] if i < n else None
        cut = below is not None and turns[i].isupper()
        initial = turns[i].lower() if below is not None else ""
        for k in range(min(high, m - i) - low, max(low, -i) - low - 1, -1):
            j = i + low + k
            if i == n and j == m:
                row[k] = 0
                continue
            best = row[k + 1] + INSERT if k + 1 < width and j < m and target[j] != "s" else far
            if below is not None:
                if k > 0:
                    best = min(best, below[k - 1] + DELETE)
                if j < m:
                    best = min(best, below[k] + _stay(initial, target[j]) + cut * CUT)
            row[k] = best
    cost = table[0][-low]
    if cost > most:
        return None
    i = j = 0
    audit = []
    while i < n or j < m:
        k, row = j - i - low, table[i]
        here = row[k]
        if i < n and k > 0 and table[i + 1][k - 1] + DELETE == here:
            audit.append("D")
            i += 1
        elif k + 1 < width and j < m and target[j] != "s" and row[k + 1] + INSERT == here:
            audit.append("I")
            j += 1
        else:
            audit.append("K" if turns[i].lower() == target[j] else "R")
            i, j = i + 1, j + 1
    return cost, "".join(audit)


def _stay(initial: str, wanted: str) -> int:
    if initial == wanted:
        return KEEP
    return REROLE if wanted != "s" else 1 << 60  # no turn becomes a system turn


def straight(turns: str, target: str) -> int:
    """What it costs to take turn after turn as it comes, and then to insert or delete what is missing or left."""
    tolls = sum(_stay(t.lower(), wanted) + t.isupper() * CUT for t, wanted in zip(turns, target))
    return tolls + max(0, len(target) - len(turns)) * INSERT + max(0, len(turns) - len(target)) * DELETE


def best_of(turns: str, start: str, end: str) -> tuple[int, str] | None:
    """The best alignment with any length of the string that begins with ``start`` and ends with ``end``.

    Lengths come by their distance from the turns', so that a good incumbent is found early and closes the rest.
    """
    n = len(turns)
    if start == "s":
        lengths = [1] if end == "s" else range(2 if end == "u" else 3, 2 * n + 6, 2)
    else:
        lengths = range(1 if start[0] == end else 2, 2 * n + 6, 2)
    incumbent, most = None, 1 << 40
    for length in sorted(lengths, key=lambda m: (abs(m - n), m)):
        target = symbols(start, length)
        most = min(most, straight(turns, target))
        found = aligned(turns, target, most)
        if found and (incumbent is None or found < incumbent):
            incumbent = found
            most = min(most, found[0])
    return incumbent


def block_table(codes: str, first: bool, last: bool) -> list[tuple[int, int, int, str]]:
    """(from phase, to phase, cost, audit) of a block of turns, each the best there is.

    A code is the initial of the role (``x`` where it is none of s, u, a), a capital where the text is cut off, or
    ``-`` for a turn that must go.
    """
    turns, gone = codes.replace("-", ""), DELETE * codes.count("-")
    out = []
    for phase in (NOTHING,) if first else STRINGS:
        ends = {phase: aligned(turns, "", 1 << 40)}
        for start in STRINGS[phase]:
            for end in ("sua" if start == "s" else "ua") if not last else "a":
                found = best_of(turns, start, end)
                if found and (ENDS[end] not in ends or found < ends[ENDS[end]]):
                    ends[ENDS[end]] = found
        out += [(phase, to, cost + gone, with_deleted(codes, audit)) for to, (cost, audit) in ends.items() if not last or to in FINAL]
    return out


def with_deleted(codes: str, audit: str) -> str:
    """The audit with a D for every turn that has to go, each as early as it may stand."""
    out, at = [], 0
    for edit in audit:
        while codes[at : at + 1] == "-":
            out.append("D")
            at += 1
        out.append(edit)
        at += edit != "I"
    return "".join(out) + "D" * (len(codes) - at)


def chained(tables: Iterable[list[tuple[int, int, int, str]]]) -> tuple[int, list[str]]:
    """Cost and audits, block by block, of the cheapest chain, the least audit among equals."""
    paths: dict[int, tuple[int, str, tuple]] = {NOTHING: (0, "", ())}
    for table in tables:
        ahead: dict[int, tuple[int, str, tuple]] = {}
        for phase, to, cost, audit in table:
            if phase not in paths:
                continue
            before, said, steps = paths[phase]
            total = before + cost
            if to not in ahead or total < ahead[to][0] or (total == ahead[to][0] and said + audit < ahead[to][1]):
                ahead[to] = (total, said + audit, (steps, audit))
        paths = ahead
    cost, _, steps = min((paths[p] for p in FINAL if p in paths), key=lambda path: path[:2])
    audits = []
    while steps:
        steps, audit = steps
        audits.append(audit)
    return cost, audits[::-1]


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text with faults put in by the crc32 of ``conv_id:turn`` modulo 20: 0 drops the row,
    1 empties its text, 2 takes its sentence ends away, 3 repeats it, 4 gives it to the user. Nulls of role, text and in the
    hashed key are one space."""
    key = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))
    text = F.coalesce(F.col("text"), F.lit(" "))
    rows = conversations.select("conv_id", "turn", F.coalesce(F.col("role"), F.lit(" ")).alias("role"), text.alias("text"), bucket_of(key, 20).alias("fault"))
    times = F.when(F.col("fault") == 0, 0).when(F.col("fault") == 3, 2).otherwise(1)
    return rows.select(
        "conv_id", "turn", F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.array_repeat(F.lit(0), times)).alias("_copy")).drop("_copy")


def judged(conversations: DataFrame) -> DataFrame:
    """Every row with its place in its conversation, its first fault and its code, computed once."""
    rows = conversations.select("conv_id", "turn", *(F.coalesce(F.col(c), F.lit(" ")).alias(c) for c in ("role", "text")))
    rows = rows.withColumn("initial", F.substring("role", 1, 1))
    in_order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "text")
    rows = rows.select(
        "*", (F.row_number().over(in_order) - 1).cast("long").alias("position"), F.lag("initial").over(in_order).alias("before"),
        (F.col("turn").isNotNull() & ~F.col("turn").eqNullSafe(F.lag("turn").over(in_order))).alias("new_turn"),
        F.lead(F.lit(True)).over(in_order).isNull().alias("last"))
    again = F.row_number().over(Window.partitionBy("conv_id", "role", "text").orderBy("position")) > 1
    fault = (
        F.when(~F.col("text").rlike(SOUND), "blank").when(F.col("again"), "duplicate")
        .when(~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z"), "truncated").otherwise(""))
    initial = F.when(F.col("initial").isin("s", "u", "a"), F.col("initial")).otherwise("x")
    code = F.when(F.col("fault").isin("blank", "duplicate"), "-").when(F.col("fault") == "truncated", F.upper(initial)).otherwise(initial)
    illegal = F.col("before").isNotNull() & ~F.concat("before", "initial").isin("su", "ua", "au")
    return kept(
        rows.withColumn("again", again).withColumn("fault", fault)
        .select("conv_id", "turn", "position", "role", "text", "fault", "new_turn", "last", code.alias("code"), illegal.alias("illegal")))


def edits(turns: DataFrame) -> DataFrame:
    """conv_id, block, audit, cost for every block of :func:`judged` turns; cost is that of the whole conversation."""
    # a block is a few letters and much work, so blocks are dealt out by number, not joined by their bytes
    tasks = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    codes = turns.select("conv_id", F.floor(F.col("position") / BLOCK).alias("block"), "position", "code", "last").repartition(tasks, "conv_id", "block")
    blocks = codes.groupBy("conv_id", "block").agg(
        F.array_sort(F.collect_list(F.struct("position", "code"))).alias("places"), F.max("last").alias("last"))
    blocks = blocks.select("conv_id", "block", F.array_join(F.transform("places", lambda p: p["code"]), "").alias("codes"), "last")
    conv = turns.schema["conv_id"]
    way = T.StructType([T.StructField(n, t) for n, t in (("phase", T.IntegerType()), ("to", T.IntegerType()), ("cost", T.LongType()), ("audit", T.StringType()))])
    arrow_way = pa.struct([("phase", pa.int32()), ("to", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])

    def aligned_blocks(batches):
        known = Remembered(lambda key: [dict(zip(arrow_way.names, way)) for way in block_table(*key)], REMEMBERED)
        for batch in batches:
            made = [known[codes, block == 0, last] for codes, block, last in zip(*(batch[c].to_pylist() for c in ("codes", "block", "last")))]
            yield pa.RecordBatch.from_arrays([batch["conv_id"], batch["block"], pa.array(made, pa.list_(arrow_way))], ["conv_id", "block", "ways"])

    def chains(batches):
        for conv_id, kind, rows in conversations_of(batches, ("block", "ways")):
            numbers, ways = [], []
            for block, table in rows:
                numbers.append(block)
                ways.append([tuple(w[n] for n in arrow_way.names) for w in table])
            cost, audits = chained(ways)
            yield [(conv_id, block, audit, cost) for block, audit in zip(numbers, audits)], kind

    ways = blocks.mapInArrow(aligned_blocks, T.StructType([conv, T.StructField("block", T.LongType()), T.StructField("ways", T.ArrayType(way))]))
    out = T.StructType([conv, T.StructField("block", T.LongType()), T.StructField("audit", T.StringType()), T.StructField("cost", T.LongType())])
    names = [("block", pa.int64()), ("audit", pa.string()), ("cost", pa.int64())]
    return ways.repartition("conv_id").sortWithinPartitions("conv_id", "block").mapInArrow(batched(chains, names), out)


def conversations_of(batches: Iterable[pa.RecordBatch], columns: tuple) -> Iterator[tuple]:
    """(conv_id, its Arrow type, an iterator over its rows) of batches sorted by conv_id. Rows are made a batch at a
    time and each conversation is read to its end before the next."""

    def rows():
        for batch in batches:
            for part in slices(batch):
                kind = part.schema.field("conv_id").type
                yield from zip(part["conv_id"].to_pylist(), [kind] * part.num_rows, zip(*(part[c].to_pylist() for c in columns)))

    for (conv_id, kind), group in itertools.groupby(rows(), key=lambda r: r[:2]):
        yield conv_id, kind, (row for _, _, row in group)


def batched(make, names: list, most: int = 1000):
    """A function over batches that gathers the lists of tuples which ``make`` yields into record batches of about
    ``most`` rows, the first column being the conversation."""

    def run(batches):
        held, kind = [], None
        for rows, kind in make(batches):
            held += rows
            if len(held) >= most:
                yield _batch(held, kind, names)
                held = []
        if held:
            yield _batch(held, kind, names)

    return run


def _batch(rows: list[tuple], kind: pa.DataType, names: list) -> pa.RecordBatch:
    columns = zip(*rows)
    arrays = [pa.array(column, t) for column, t in zip(columns, [kind] + [t for _, t in names])]
    return pa.RecordBatch.from_arrays(arrays, ["conv_id"] + [n for n, _ in names])


def replayed(rows: Iterable[tuple]) -> Iterator[tuple]:
    """(edit, role, text, turn) of a conversation's repaired turns, deleted ones too (with what they were), from its
    rows in order: each block's audit (not null) before its turns."""
    phase, audit, at = NOTHING, "", 0

    def due():
        nonlocal phase, at
        while audit[at : at + 1] == "I":
            at += 1
            phase, role = (ASSISTANT, "assistant") if phase == USER else (USER, "user")
            yield "I", role, "", None

    for letters, role, text, turn in rows:
        yield from due()
        if letters is not None:
            audit, at = letters, 0
            continue
        edit = audit[at]
        at += 1
        if edit != "D":
            wanted = "assistant" if phase == USER else "user"
            role = role if edit == "K" else wanted
            phase = ENDS[role[0]]
        yield edit, role, text, turn
    yield from due()


def in_stream(turns: DataFrame, made: DataFrame) -> DataFrame:
    """Turns in order, each block's audit before its turns: one shuffle of the texts, and no conversation held whole."""
    none, text = F.lit(None), F.lit(None).cast("string")
    said = made.select("conv_id", (F.col("block") * BLOCK).alias("position"), "audit", "cost", text.alias("role"), text.alias("text"), none.cast("long").alias("turn"))
    rows = turns.select("conv_id", "position", text.alias("audit"), none.cast("long").alias("cost"), "role", "text", F.col("turn").cast("long").alias("turn"))
    both = said.union(rows).repartition("conv_id")
    return both.sortWithinPartitions("conv_id", "position", F.col("audit").isNull())


def repaired(conversations: DataFrame) -> DataFrame:
    """conv_id, place, edit, role, text, turn of every repaired turn, in place order from 0; inserted turns have no turn and
    an empty text. Deleted turns come with place null."""
    small_batches(conversations.sparkSession)
    turns = judged(conversations)

    def rows_of(batches):
        for conv_id, kind, rows in conversations_of(batches, ("audit", "role", "text", "turn")):
            place = 0
            for edit, role, text, turn in replayed(rows):
                yield [(conv_id, None if edit == "D" else place, edit, role, text, turn)], kind
                place += edit != "D"

    out = T.StructType([turns.schema["conv_id"], T.StructField("place", T.LongType()), *(T.StructField(n, T.StringType()) for n in ("edit", "role", "text")), T.StructField("turn", T.LongType())])
    names = [("place", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string()), ("turn", pa.int64())]
    return in_stream(turns, edits(turns)).mapInArrow(batched(rows_of, names, most=200), out)


def audits(conversations: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 of every conversation.

    A row's first fault counts: blank (no character but white space), duplicate (role and text came earlier), truncated (the last
    character that is not white space ends no sentence). gaps are the turn numbers missing between the first and the last,
    illegal the neighbours whose initials are not su, ua or au; cost and audit are those of the cheapest edits, and
    the hash is of the repaired ``role:text`` lines. Null roles and texts are one space (so such a turn must go, or be
    given a role), null turns come first, turns of equal number are ordered by role and text, a null conv_id is a conversation
    like others, and an empty role has no initial and cannot be kept. gaps beyond a long are null. Other
    columns are ignored; no rows give no rows.
    """
    small_batches(conversations.sparkSession)
    turns = judged(conversations)
    count = {name: F.sum((F.col("fault") == name).cast("long")).alias(name) for name in ("blank", "duplicate", "truncated")}
    wide = {name: F.col(name).cast("decimal(20,0)") for name in ("high", "low", "different")}
    facts = turns.groupBy("conv_id").agg(
        F.max("turn").alias("high"), F.min("turn").alias("low"), F.sum(F.col("new_turn").cast("long")).alias("different"), *count.values(),
        F.sum(F.col("illegal").cast("long")).alias("illegal"))
    gaps = F.when(F.col("high").isNull(), 0).otherwise((wide["high"] - wide["low"] + 1 - wide["different"]).try_cast("long"))
    facts = facts.select(F.col("conv_id").alias("fact_id"), gaps.alias("gaps"), *count, "illegal")

    def hashed(batches):
        for conv_id, kind, rows in conversations_of(batches, ("audit", "role", "text", "turn", "cost")):
            said, costs = [], []

            def lines():
                for letters, role, text, turn, cost in rows:
                    if letters is not None:
                        said.append(letters)
                        costs.append(cost)
                    yield letters, role, text, turn

            digest, first = hashlib.sha256(), True
            for edit, role, text, _ in replayed(lines()):
                if edit != "D":
                    digest.update(("" if first else "\n").encode() + f"{role}:{text}".encode())
                    first = False
            yield [(conv_id, costs[0], "".join(said), digest.hexdigest())], kind

    out = T.StructType([turns.schema["conv_id"], T.StructField("cost", T.LongType()), T.StructField("audit", T.StringType()), T.StructField("repaired_sha256", T.StringType())])
    names = [("cost", pa.int64()), ("audit", pa.string()), ("repaired_sha256", pa.string())]
    repairs = in_stream(turns, edits(turns)).mapInArrow(batched(hashed, names), out)
    joined = repairs.join(facts, repairs["conv_id"].eqNullSafe(facts["fact_id"]))
    return joined.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def damaged_and_repaired(conversations: DataFrame) -> DataFrame:
    """:func:`audits` of :func:`damaged` conversations, one row for every conversation there was: one that has lost all
    its turns has zeros, an empty audit and the hash of nothing."""
    found = audits(damaged(conversations))
    all_ids = conversations.select(F.col("conv_id").alias("id")).distinct()
    numbers = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")]
    gaps = F.when(F.col("audit").isNull(), F.lit(0)).otherwise(F.col("gaps")).cast("long").alias("gaps")
    nothing = hashlib.sha256().hexdigest()
    return all_ids.join(found, all_ids["id"].eqNullSafe(found["conv_id"]), "left").select(
        F.col("id").alias("conv_id"), gaps, *numbers, F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"))


ORACLE = r"""
with recursive bits as (
  select range as byte, range::bigint as crc, 0 as k from range(256)
  union all select byte, case when crc % 2 = 1 then xor(crc >> 1, 3988292384) else crc >> 1 end, k + 1 from bits where k < 8),
tab as (select byte, crc from bits where k = 8),
keys as (select distinct conv_id, turn, coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') as key from conversations),
walk as (
  select conv_id, turn, key, 4294967295::bigint as crc, 1 as spot from keys
  union all
  select conv_id, turn, key, xor(walk.crc >> 8, tab.crc), spot + 1 from walk join tab
    on spot <= length(key) and tab.byte = xor(walk.crc & 255, ascii(substr(key, spot, 1)))),
hashed as (select conv_id, turn, xor(crc, 4294967295) % 20 as fault from walk where spot = length(key) + 1),
damaged as (
  select c.conv_id, c.turn, case when fault = 4 then 'user' else coalesce(role, ' ') end as role,
    case fault when 1 then '' when 2 then regexp_replace(coalesce(text, ' '), '[.!?]', '', 'g') else coalesce(text, ' ') end as text
  from conversations c join hashed h on c.conv_id is not distinct from h.conv_id and c.turn is not distinct from h.turn,
    unnest(case fault when 0 then [] when 3 then [0, 1] else [0] end) as copies(copy)),
placed as (
  select *, substr(role, 1, 1) as initial, row_number() over (partition by conv_id order by turn nulls first, role, text) as pos from damaged),
judged as (
  select *, lag(initial) over (partition by conv_id order by pos) as before,
    case when not regexp_matches(text, '[^\x20\x09-\x0D]') then 'blank'
      when row_number() over (partition by conv_id, role, text order by pos) > 1 then 'duplicate'
      when not regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') then 'truncated' else '' end as fault
  from placed),
facts as (
  select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) as n,
    sum((fault = 'blank')::int) as blank, sum((fault = 'duplicate')::int) as duplicate, sum((fault = 'truncated')::int) as truncated,
    sum((before is not null and before || initial not in ('su', 'ua', 'au'))::int) as illegal
  from judged group by conv_id),
step as (
  select conv_id, 0::bigint as i, phase, cost, audit from facts, (values (0, 0, ''), (2, 2, 'I'), (3, 4, 'II')) as s(phase, cost, audit)
  union all
  select conv_id, i, phase, best.c as cost, best.a as audit from (
    select conv_id, i, phase, min({'c': cost, 'a': audit}) as best from (
      select t.conv_id, t.i, ins.phase, t.cost + ins.cost as cost, t.audit || ins.audit as audit from (
        select s.conv_id, s.i + 1 as i, edit.phase, s.cost + edit.cost as cost, s.audit || edit.letter as audit
        from step s join judged j on s.conv_id is not distinct from j.conv_id and j.pos = s.i + 1,
          unnest([
            {'letter': 'D', 'phase': s.phase, 'cost': 3},
            {'letter': case when j.initial = case when s.phase = 2 then 'a' else 'u' end then 'K' else 'R' end,
             'phase': case when s.phase = 2 then 3 else 2 end,
             'cost': case when j.fault in ('blank', 'duplicate') then null else (j.fault = 'truncated')::int
               + case when j.initial = case when s.phase = 2 then 'a' else 'u' end then 0 else 2 end end},
            {'letter': 'K', 'phase': 1,
             'cost': case when s.phase <> 0 or j.initial <> 's' or j.fault in ('blank', 'duplicate') then null else (j.fault = 'truncated')::int end}
          ]) as e(edit) where edit.cost is not null) t
      join (values (0, 0, 0, ''), (1, 1, 0, ''), (2, 2, 0, ''), (3, 3, 0, ''), (0, 2, 2, 'I'), (1, 2, 2, 'I'), (2, 3, 2, 'I'), (3, 2, 2, 'I'),
        (0, 3, 4, 'II'), (1, 3, 4, 'II')) as ins(was, phase, cost, audit) on ins.was = t.phase)
    group by conv_id, i, phase)),
best as (
  select conv_id, b.c as cost, b.a as audit from (
    select s.conv_id, min({'c': s.cost, 'a': s.audit}) as b from step s join facts f
      on s.conv_id is not distinct from f.conv_id and s.i = f.n where s.phase in (0, 3) group by s.conv_id)),
letters as (
  select conv_id, spot, substr(audit, spot, 1) as letter from best, unnest(range(1, length(audit) + 1)) as r(spot)),
numbered as (
  select *, sum((letter <> 'I')::int) over (partition by conv_id order by spot) as pos, sum((letter <> 'D')::int) over (partition by conv_id order by spot) as place from letters),
lines as (
  select n.conv_id, n.spot, n.place, n.letter, j.role, j.text, j.initial from numbered n left join judged j
    on n.letter <> 'I' and n.conv_id is not distinct from j.conv_id and n.pos = j.pos where n.letter <> 'D'),
shifted as (select *, coalesce(max((place = 1 and letter = 'K' and initial = 's')::int) over (partition by conv_id), 0) as shift from lines),
repaired as (
  select conv_id, string_agg(case when letter = 'K' then role when (place - shift) % 2 = 1 then 'user' else 'assistant' end || ':' || coalesce(text, ''),
    chr(10) order by spot) as body from shifted group by conv_id)
select c.conv_id, coalesce(f.gaps, 0)::bigint as gaps, coalesce(f.blank, 0)::bigint as blank, coalesce(f.duplicate, 0)::bigint as duplicate,
  coalesce(f.truncated, 0)::bigint as truncated, coalesce(f.illegal, 0)::bigint as illegal, coalesce(b.cost, 0)::bigint as cost, coalesce(b.audit, '') as audit,
  sha256(coalesce(r.body, '')) as repaired_sha256
from (select distinct conv_id from conversations) c left join facts f on c.conv_id is not distinct from f.conv_id
  left join best b on c.conv_id is not distinct from b.conv_id left join repaired r on c.conv_id is not distinct from r.conv_id
"""
