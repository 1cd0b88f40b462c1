"""Operator 13: cheapest repair of a conversation's structure.

The repaired roles must read ``(s?(ua)+)?`` by their initials.  Going through
a conversation, a row is kept, re-roled, deleted, or preceded by an inserted
one; where the roles so far have led is one of four states.  The cost to go
from each state before a row to the end is a vector of four numbers, and the
Viterbi recursion runs backwards through the rows.  Less their least number,
the vectors that can occur are few (:data:`VECTORS`), so a row is a step in a
table.

Conversations may be of any length, so rows in order are cut into blocks of
``BLOCK``.  A block starts from every speculative vector that may stand at its
end; the vectors soon differ by constants only (rank convergence), and then
the block's first vector is known whatever follows.  Blocks that have not
converged are fixed up in passes, each of which joins them with what is known
of the blocks behind and doubles how far they look.  The same is done forwards
for the state in which a block is entered.  With both at hand each block
traces its rows by itself: among the cheapest edits it takes the ASCII-least.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tastegraph.llm.common import materialize, slices

#: Rows of a block.
BLOCK = 1024
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
#: States: nothing yet, after s, after u, after a; the roles may end in the first and the last.
ROLES = {1: "system", 2: "user", 3: "assistant"}
_APPENDED = (2, 2, 3, 2)
_END = (0, 2 * INSERT, INSERT, 0)
#: Kinds of rows: 0 must go; otherwise 1 + 2 * role (0 another, 1 s, 2 u, 3 a) + truncated.
_KINDS = 9


def _kept(state: int, kind: int) -> int | None:
    role = (kind - 1) // 2
    return role if kind and (role == _APPENDED[state] or (role == 1 and state == 0)) else None


def _before(kind: int, after: tuple[int, ...]) -> tuple[int, ...]:
    """Costs to go before a row from those behind it."""
    cost = [DELETE + c for c in after]
    if kind:
        late = TRUNCATED * ((kind - 1) % 2)
        for s in range(4):
            cost[s] = min(cost[s], REROLE + late + after[_APPENDED[s]])
            if _kept(s, kind) is not None:
                cost[s] = min(cost[s], KEEP + late + after[_kept(s, kind)])
    for _ in range(2):  # one or two insertions
        cost = [min(c, INSERT + cost[_APPENDED[s]]) for s, c in enumerate(cost)]
    return tuple(cost)


def _relative(costs: tuple[int, ...]) -> tuple[int, ...]:
    return tuple(c - min(costs) for c in costs)


def _reachable() -> tuple[list[tuple[int, ...]], np.ndarray]:
    """All vectors, less their least number, that rows can lead to, and the
    vector before a row of each kind."""
    vectors, steps = [_relative(_END)], []
    for v in vectors:  # grows while it is read
        ahead = [_relative(_before(k, v)) for k in range(_KINDS)]
        vectors += [x for x in dict.fromkeys(ahead) if x not in vectors]
        steps.append([vectors.index(x) for x in ahead])
    return vectors, np.array(steps)


def _trace(after: tuple[int, ...], kind: int, state: int) -> tuple[str, int]:
    """The ASCII-least cheapest edits at one row: inserted roles' initials and
    then the row's own edit, and the state they lead to."""
    cost, late, inserted = _before(kind, after), TRUNCATED * ((kind - 1) % 2), ""
    while True:
        if cost[state] == DELETE + after[state]:
            return inserted + "D", state
        if cost[state] == INSERT + cost[_APPENDED[state]]:
            state = _APPENDED[state]
            inserted += ROLES[state][0]
            continue
        kept = _kept(state, kind)
        if kept is not None and cost[state] == KEEP + late + after[kept]:
            return inserted + "K", kept
        return inserted + "R", _APPENDED[state]


def _closing(state: int) -> str:
    """Initials of the roles to insert at the end of a conversation."""
    return {0: "", 1: "ua", 2: "a", 3: ""}[state]


VECTORS, _STEP = _reachable()
_EDITS = [[[_trace(v, k, s) for s in range(4)] for k in range(_KINDS)] for v in VECTORS]
_EXIT = np.array([[[e[1] for e in row] for row in kinds] for kinds in _EDITS])
_STEPS = _STEP.tolist()


# ---------------------------------------------------------------- rows

def damage(conversations: DataFrame) -> DataFrame:
    """Planted faults, by the crc32 of ``conv_id:turn`` modulo 20: 0 drops the
    row, 1 empties its text, 2 removes its ``.!?``, 3 repeats it, 4 sets its
    role to user.  A null is one space in the key, the role and the text."""
    def spaced(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    code = F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn")).cast("binary")) % 20
    text = F.when(code == 1, F.lit("")).when(code == 2, F.translate(spaced("text"), ".!?", "")).otherwise(spaced("text"))
    copies = F.array_repeat(F.lit(0), F.when(code == 3, F.lit(2)).otherwise(F.lit(1)))
    return (conversations.filter(code != 0)
            .select("conv_id", "turn", F.when(code == 4, F.lit("user")).otherwise(spaced("role")).alias("role"), text.alias("text"), copies.alias("_c"))
            .select("conv_id", "turn", "role", "text", F.explode("_c")).drop("col"))


_ORDER = ["conv_id", "turn", "role", "lead", "digest"]


def _keyed(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, and what orders the rows of one turn: the
    text's first 32 characters and its SHA-256."""
    text, role = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("text", "role"))
    return (rows.select("conv_id", F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"))
            .withColumn("lead", F.substring("text", 1, 32)).withColumn("digest", F.unhex(F.sha2(F.col("text").cast("binary"), 256))))


def _ordered(rows: DataFrame) -> DataFrame:
    """The rows without their texts, numbered from 0 in the order of
    conversations and turns, with their first fault and kind."""
    blank = ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    whole = F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")
    features = _keyed(rows).select(*_ORDER, F.substring("role", 1, 1).alias("initial"), blank.alias("blank"), (~blank & ~whole).alias("cut_off"))
    rows = materialize(features.orderBy(*_ORDER).withColumn("id", F.monotonically_increasing_id()), "conversation-order")
    part = F.shiftright("id", 33)
    sizes = rows.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))
    # one row per partition of the sort
    offsets = sizes.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("offset"))
    rows = (rows.withColumn("part", part).join(F.broadcast(offsets), "part")
            .withColumn("pos", F.col("offset") + F.col("id").bitwiseAND(F.lit((1 << 33) - 1))).drop("part", "offset", "id"))
    first = rows.groupBy("conv_id", "role", "digest").agg(F.min("pos").alias("pos")).select("pos", F.lit(True).alias("first"))
    duplicate = ~F.col("blank") & F.col("first").isNull()
    role = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for k, r in ROLES.items() for x in (r[0], k)]), F.col("initial")), F.lit(0))
    truncated = ~F.col("blank") & ~F.col("duplicate") & F.col("cut_off")
    kind = F.when(F.col("blank") | F.col("duplicate"), 0).otherwise(1 + 2 * role + F.col("truncated").cast("int"))
    return materialize(rows.join(first, "pos", "left").withColumn("duplicate", duplicate).withColumn("truncated", truncated)
                       .select(F.floor(F.col("pos") / BLOCK).alias("block"), "pos", *_ORDER, "initial", "blank", "duplicate", "truncated",
                               kind.cast("int").alias("kind")), "conversation-rows")


# ---------------------------------------------------------------- blocks

def _segments(conv: list) -> list[tuple[int, int]]:
    cuts = [0, *(i for i in range(1, len(conv)) if conv[i] != conv[i - 1]), len(conv)]
    return list(zip(cuts, cuts[1:]))


def _summarise(group: pa.Table) -> pa.Table:
    """One row of a block: its first and last conversation, the vector before
    its first row by the vector behind its last one, and the state it is left
    in by that vector and the state it is entered in."""
    group = group.sort_by("pos")
    kinds, segments = group.column("kind").to_pylist(), _segments(group.column("conv_id").to_pylist())
    every = np.arange(len(VECTORS))
    vectors = [every]
    for kind in reversed(kinds[segments[-1][0]:]):
        vectors.append(_STEP[vectors[-1], kind])
    single = len(segments) == 1
    up = vectors[-1]
    if not single:
        v = 0
        for kind in reversed(kinds[:segments[0][1]]):
            v = _STEPS[v][kind]
        up = np.full(len(VECTORS), v)
    state = np.broadcast_to(np.arange(4) if single else np.zeros(4, int), (len(VECTORS), 4))
    for kind, behind in zip(kinds[segments[-1][0]:], vectors[-2::-1]):
        state = _EXIT[behind[:, None], kind, state]
    ends = group.select(["block", "conv_id", "initial"]).take([0, len(kinds) - 1])
    return pa.table([ends.column("block").slice(0, 1), ends.column("conv_id").slice(0, 1), ends.column("conv_id").slice(1, 1), ends.column("initial").slice(1, 1),
                     pa.array([up.tolist()], pa.list_(pa.int32())), pa.array([state.tolist()], pa.list_(pa.list_(pa.int32())))],
                    names=["block", "first", "last", "initial", "up", "down"])


def _resolve(chain: DataFrame, step: int, name: str) -> DataFrame:
    """``(block, value)``: ``value`` where it is known, else ``map`` of the
    value of the block ``step`` further, for all blocks of ``(block, map,
    value)``.  A map that gives one value whatever comes in is known too.
    Each pass doubles how far a block looks."""
    known = F.coalesce("value", F.when(F.size(F.array_distinct("map")) == 1, F.col("map")[0]))
    chain = materialize(chain.select("block", "map", known.alias("value"), (F.col("block") + step).alias("at")), name)
    while chain.filter("value is null").limit(1).count():
        ahead = chain.select(F.col("block").alias("at"), F.col("map").alias("further"), F.col("value").alias("there"), F.col("at").alias("beyond"))
        # blocks that are known leave the join early, the others meet one row each
        chain = materialize(chain.filter("value is null").join(ahead, "at").select(
            "block", F.transform("further", lambda x: F.get(F.col("map"), x)).alias("map"), F.get(F.col("map"), F.col("there")).alias("value"),
            F.col("beyond").alias("at")).unionByName(chain.filter("value is not null")), name)
    return chain.select("block", "value")


def _entries(rows: DataFrame) -> DataFrame:
    """What each block must know of the others: the vector behind its last
    row, the state it is entered in, the initial before its first row (null:
    a conversation starts) and whether its last conversation goes on."""
    conv = rows.schema["conv_id"].dataType
    schema = T.StructType([T.StructField("block", T.LongType()), T.StructField("first", conv), T.StructField("last", conv), T.StructField("initial", T.StringType()),
                           T.StructField("up", T.ArrayType(T.IntegerType())), T.StructField("down", T.ArrayType(T.ArrayType(T.IntegerType())))])
    blocks = materialize(rows.select("block", "pos", "conv_id", "initial", "kind").groupBy("block").applyInArrow(_summarise, schema), "blocks")
    behind = blocks.select((F.col("block") - 1).alias("block"), F.struct(F.col("first").alias("conv")).alias("behind"))
    ahead = blocks.select((F.col("block") + 1).alias("block"), F.struct(F.col("last").alias("conv"), "initial").alias("ahead"))
    blocks = materialize(blocks.join(behind, "block", "left").join(ahead, "block", "left").select(
        "block", "up", "down", (F.col("behind").isNotNull() & F.col("behind.conv").eqNullSafe(F.col("last"))).alias("goes_on"),
        F.when(F.col("ahead").isNotNull() & F.col("ahead.conv").eqNullSafe(F.col("first")), F.col("ahead.initial")).alias("prior")), "block-links")

    start = _resolve(blocks.select("block", F.col("up").alias("map"), F.when(~F.col("goes_on"), F.col("up")[0]).alias("value")), 1, "block-vectors")
    vector = start.select((F.col("block") - 1).alias("block"), F.col("value").alias("vector"))
    blocks = materialize(blocks.join(vector, "block", "left").select(
        "block", "down", "goes_on", "prior", F.when(F.col("goes_on"), F.col("vector")).otherwise(0).alias("vector")), "block-ends")
    down = F.col("down")[F.col("vector")]
    left = _resolve(blocks.select("block", down.alias("map"), F.when(F.col("prior").isNull(), down[0]).alias("value")), -1, "block-states")
    entered = left.select((F.col("block") + 1).alias("block"), F.col("value").alias("entered"))
    return blocks.join(entered, "block", "left").select(
        "block", "vector", "goes_on", "prior", F.when(F.col("prior").isNotNull(), F.col("entered")).otherwise(0).alias("entered"))


def _edit_block(group: pa.Table) -> pa.Table:
    group = group.sort_by("pos")
    kinds, initials = group.column("kind").to_pylist(), group.column("initial").to_pylist()
    vector, entered, prior, goes_on = (group.column(n)[0].as_py() for n in ("vector", "entered", "prior", "goes_on"))
    segments = _segments(group.column("conv_id").to_pylist())
    before, edit, role, after, illegal = [], [], [], [], []
    for k, (a, b) in enumerate(segments):
        last = k == len(segments) - 1
        behind = [vector if last else 0]
        for kind in reversed(kinds[a + 1:b]):
            behind.append(_STEPS[behind[-1]][kind])
        state = entered if k == 0 else 0
        for kind, v in zip(kinds[a:b], reversed(behind)):
            made, state = _EDITS[v][kind][state]
            before.append(made[:-1])
            edit.append(made[-1])
            role.append(ROLES[state] if made[-1] == "R" else None)
        after += [""] * (b - a - 1) + ["" if last and goes_on else _closing(state)]
        previous = [prior if k == 0 else None, *initials[a:b - 1]]
        illegal += [p is not None and p + i not in ("su", "ua", "au") for p, i in zip(previous, initials[a:b])]
    made = [pa.array(before, pa.string()), pa.array(edit, pa.string()), pa.array(role, pa.string()), pa.array(after, pa.string()), pa.array(illegal, pa.bool_())]
    kept = group.select([n for n in group.column_names if n not in ("vector", "entered", "prior", "goes_on", "block", "kind", "initial")])
    return pa.table([*kept.columns, *made], names=[*kept.column_names, "before", "edit", "new_role", "after", "illegal"])


def edits(rows: DataFrame) -> DataFrame:
    """The cheapest edits of every row (conv_id, turn, role, text; null role
    and text: one space), one output row each, without its text.

    ``pos`` numbers all rows by conv_id, turn (nulls first), then role, the
    text's first 32 characters and its digest; ``blank``, ``duplicate`` and
    ``truncated`` say its first fault; ``illegal`` that its role may not follow
    that of the row before; ``before`` and ``after`` are the initials of the
    roles inserted next to it (``after`` at the end of a conversation only),
    ``edit`` is K, R or D, and ``new_role`` the role of an R.  Repeated rows
    are duplicates, other columns are ignored, rows of a null conv_id are one
    conversation, and an empty table gives no rows."""
    ordered = _ordered(rows)
    keep = ["pos", *_ORDER, "blank", "duplicate", "truncated"]
    met = ordered.join(_entries(ordered), "block").select("block", *keep, "initial", "kind", "vector", "entered", "prior", "goes_on")
    schema = T.StructType([met.schema[n] for n in keep] + [T.StructField(n, T.StringType()) for n in ("before", "edit", "new_role", "after")]
                          + [T.StructField("illegal", T.BooleanType())])
    return materialize(met.groupBy("block").applyInArrow(_edit_block, schema), "conversation-edits")


# ---------------------------------------------------------------- repaired rows

def _merged(rows: DataFrame, made: DataFrame) -> DataFrame:
    """Texts and edits of each conversation in one task's order, the text of a
    row before its edits.  One exchange of the texts, and no row waits in
    memory; a conversation's lines are in one task, as they are one sequence."""
    texts = _keyed(rows).select(*_ORDER, F.lit(-1).cast("long").alias("pos"), "text",
                                *[F.lit(None).cast("string").alias(n) for n in ("before", "edit", "new_role", "after")])
    return (texts.unionByName(made.select(*_ORDER, "pos", F.lit(None).cast("string").alias("text"), "before", "edit", "new_role", "after"))
            .repartition("conv_id").sortWithinPartitions(*_ORDER, "pos"))


_NAMES = {r[0]: r for r in ROLES.values()}


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(conv_id, edit, role, text) in order; role and text are null for D."""
    text = None
    for b in slices(batches):
        for conv, role, pos, held, before, edit, new_role, after in zip(*(b.column(n).to_pylist() for n in (
                "conv_id", "role", "pos", "text", "before", "edit", "new_role", "after"))):
            if pos < 0:
                text = held
                continue
            for i in before:
                yield conv, "I", _NAMES[i], ""
            yield conv, edit, *((None, None) if edit == "D" else (new_role or role, text))
            for i in after:
                yield conv, "I", _NAMES[i], ""


def _batched(batches: Iterator[pa.RecordBatch], made, names: list[str], kinds: list[pa.DataType], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The tuples of ``made(batches)``, conv_id first, as Arrow batches."""
    first = next(batches, None)
    if first is None:
        return
    kinds, found = [first.schema.field("conv_id").type, *kinds], made(chain([first], batches))
    while held := list(islice(found, rows)):
        yield pa.record_batch([pa.array(v, t) for v, t in zip(zip(*held), kinds)], names=names)


def repaired(rows: DataFrame, made: DataFrame | None = None) -> DataFrame:
    """The repaired conversations: ``(conv_id, line, role, text, edit)``, lines
    from 0, of the rows that :func:`edits` keeps, re-roles or inserts."""
    conv = rows.schema["conv_id"].dataType
    schema = T.StructType([T.StructField("conv_id", conv), T.StructField("line", T.LongType()),
                           *[T.StructField(n, T.StringType()) for n in ("role", "text", "edit")]])

    def made_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        whose, line = object(), 0
        for conv, edit, role, text in _lines(batches):
            if conv != whose:
                whose, line = conv, 0
            if edit != "D":
                yield conv, line, role, text, edit
                line += 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batched(batches, made_lines, schema.names, [pa.int64(), pa.string(), pa.string(), pa.string()])

    return _merged(rows, edits(rows) if made is None else made).mapInArrow(run, schema)


def digests(rows: DataFrame, made: DataFrame) -> DataFrame:
    """``(conv_id, audit, repaired_sha256)``: the edits' initials in order, and
    the SHA-256 of the repaired ``role:text`` joined by line feeds."""
    conv = rows.schema["conv_id"].dataType
    schema = T.StructType([T.StructField("conv_id", conv), T.StructField("audit", T.StringType()), T.StructField("repaired_sha256", T.StringType())])

    def made_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        whose, audit, sha, any_line = object(), [], None, False
        for conv, edit, role, text in _lines(batches):
            if sha is None or conv != whose:
                if sha is not None:
                    yield whose, "".join(audit), sha.hexdigest()
                whose, audit, sha, any_line = conv, [], hashlib.sha256(), False
            audit.append(edit)
            if edit != "D":
                sha.update(("\n" * any_line + f"{role}:{text}").encode())
                any_line = True
        if sha is not None:
            yield whose, "".join(audit), sha.hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batched(batches, made_digests, schema.names, [pa.string(), pa.string()])

    return _merged(rows, made).mapInArrow(run, schema)


def report(conversations: DataFrame, rows: DataFrame) -> DataFrame:
    """One row per conv_id of ``conversations`` on the repair of ``rows``: gaps
    in the turns, first faults, illegal successions, cost, audit and the digest
    of the repaired conversation; zeros and empty texts for one without rows."""
    made = edits(rows)
    inserted = F.length("before") + F.length("after")
    cost = (INSERT * inserted + F.when(F.col("edit") == "D", DELETE)
            .otherwise(F.when(F.col("edit") == "R", REROLE).otherwise(KEEP) + TRUNCATED * F.col("truncated").cast("int")))
    counts = ["blank", "duplicate", "truncated", "illegal"]
    gaps = F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0))
    summed = made.groupBy("conv_id").agg(gaps.alias("gaps"), *[F.sum(F.col(c).cast("long")).alias(c) for c in counts], F.sum(cost.cast("long")).alias("cost"))
    longs, texts = ["gaps", *counts, "cost"], ["audit", "repaired_sha256"]

    def widened(df: DataFrame) -> DataFrame:
        return df.select("conv_id", *[F.col(c) if c in df.columns else F.lit(None).cast("long" if c in longs else "string").alias(c) for c in longs + texts])

    every = widened(conversations.select("conv_id").distinct()).unionByName(widened(summed)).unionByName(widened(digests(rows, made)))
    nothing = {"audit": "", "repaired_sha256": hashlib.sha256().hexdigest()}
    return every.groupBy("conv_id").agg(*[F.coalesce(F.max(c), F.lit(0).cast("long")).alias(c) for c in longs],
                                        *[F.coalesce(F.max(c), F.lit(nothing[c])).alias(c) for c in texts])
