"""Repair of the structure of conversations by cheapest edits, the least list of edits among equals.

A conversation should consist of an optional system row and then pairs of a user and an assistant row. Every row
is kept (K), given the role the place needs (R, cost 1) or deleted (D, cost 2); empty user or assistant rows can be
inserted (I, cost 5) anywhere. Blank rows and rows that repeat an earlier one must go; a truncated row that stays
costs 5 more. The audit is the string of edits; of all cheapest ones the least by ASCII is taken.

1. Rows are range-partitioned by conversation and turn, so a long conversation lies in several parts, each of a
   bounded number of rows. Texts stay behind: what follows needs a few numbers for each row.
2. Cost DP. A row is a min-plus matrix between four states (nothing yet, after system, user, assistant), rows of a
   part are multiplied by doubling. Conversations that cross parts have one matrix a part; these are
   chained backwards, so every part knows the cost of what comes after it.
3. Path ranking. Nodes are (row, state), arcs are edits that lie on a cheapest path. Every node points along its
   least arc; pointers and audits double: the rank of a node's first 2^(k+1) edits comes from the ranks
   of its first 2^k and of the first 2^k of the node its pointer reaches. Arcs of one node have different letters and a
   letter leads to one node, so a string of edits names one path. The least path's node at any place is
   reached through the doubled pointers, by the binary digits of the place; doubling stops when neither
   ranks nor pointers change. Where a conversation crosses parts, the pointers of a part
   map the state it is entered in to the one it is left in; these maps are chained forwards.
4. Edits and texts meet in one sort by conversation and place, and are streamed: a task holds one row, the hash
   of what came before, and the audit. A SHA-256 has to be fed in order, so the longest conversation is one task's stream.

Nulls: a null role or text is one space, so it cannot be kept as it is; rows without a turn come first; rows without
a conversation are one conversation. Rows of one turn follow each other by role and hash of their texts. An
empty role is no system, user or assistant either. Roles go by their first letter. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from martloom.llm.support import Workspace

ROWS_A_PART = 65_536
# Costs of edits, and white space.
DELETE, INSERT, REROLE, TRUNCATED = 2, 5, 1, 5
BLANKS = " \t\n\x0b\x0c\r"
NONE, SYSTEM, USER, ASSISTANT = range(4)
NEEDED = np.array([USER, USER, ASSISTANT, USER])  # the role, and state, that an inserted or changed row takes
FAULTS = ("", "blank", "duplicate", "truncated")
LETTERS = ["D", "I", "K", "R"]  # in ASCII order
FAR = 1 << 40
END = np.array([0, 2 * INSERT, INSERT, 0])  # cost of ending in each state: what is missing is inserted
CLOSURE = np.array([[0, FAR, INSERT, 2 * INSERT], [FAR, 0, INSERT, 2 * INSERT], [FAR, FAR, 0, INSERT], [FAR, FAR, INSERT, 0]])

NARROW_ROW = "conv_id bigint, part bigint, pos bigint, code int, fault int"
EDIT_ROW = "conv_id bigint, pos bigint, before int, letter string, after int, fault int"
SUMMARY_ROW = (
    "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, "
    "audit string, repaired_sha256 string"
)
REPAIRED_ROW = "conv_id bigint, place bigint, turn bigint, role string, text string"


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows (conv_id, turn, role, text) of `conversations`, a quarter of them damaged by a fixed rule."""
    spaced = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")]
    kind = F.crc32(F.concat_ws(":", *spaced[:2]).cast("binary")) % 20
    rows = conversations.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"), spaced[2].alias("role"), spaced[3].alias("text"), kind.alias("kind")
    )
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.where("kind <> 0").select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), F.explode(copies).alias("copy")
    ).drop("copy")


# ---- numbers of one part -------------------------------------------------------------------------------------


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Min-plus products of two stacks of matrices."""
    return np.minimum((a[:, :, :, None] + b[:, None, :, :]).min(2), FAR)


class _Part:
    """The rows of one part, in order: segments of conversations, their matrices and their cheapest arcs."""

    def __init__(self, rows: pa.Table):
        pos = rows.column("pos").to_numpy()
        order = np.argsort(pos)
        self.pos = pos[order]
        self.conv = rows.column("conv_id").take(pa.array(order)).combine_chunks()
        self.code = rows.column("code").to_numpy()[order].astype(np.int64)
        self.fault = rows.column("fault").to_numpy()[order].astype(np.int64)
        known = self.conv.is_valid().to_numpy(zero_copy_only=False)
        ids = self.conv.fill_null(0).to_numpy()
        fresh = np.ones(len(pos), bool)
        fresh[1:] = (ids[1:] != ids[:-1]) | (known[1:] != known[:-1])
        self.segment = np.cumsum(fresh) - 1
        self.first = np.flatnonzero(fresh)
        self.last = np.append(self.first[1:], len(pos)) - 1
        self.extra = np.where(self.fault == 3, TRUNCATED, 0)
        self.must_go = (self.fault == 1) | (self.fault == 2)

    def segment_of(self) -> dict:
        return {self.conv[int(i)].as_py(): k for k, i in enumerate(self.first)}

    def matrices(self) -> np.ndarray:
        """Cost of getting from a state before a row to one after it, inserts before the row included."""
        n = len(self.pos)
        step = np.full((n, 4, 4), FAR)
        every = np.arange(4)
        step[:, every, every] = DELETE
        stays = np.flatnonzero(~self.must_go)
        for state in range(4):
            need = NEEDED[state]
            step[stays, state, need] = np.minimum(step[stays, state, need], REROLE + self.extra[stays])
            for role in (SYSTEM, USER, ASSISTANT):
                if role == need or (role == SYSTEM and state == NONE):
                    rows = stays[self.code[stays] == role]
                    step[rows, state, role] = np.minimum(step[rows, state, role], self.extra[rows])
        return _product(np.broadcast_to(CLOSURE, (n, 4, 4)), step)

    def to_segment_ends(self) -> np.ndarray:
        """For every row the product of the matrices from it to the end of its segment, by doubling."""
        rest = self.matrices()
        end = self.last[self.segment]
        reach = 1
        while True:
            rows = np.flatnonzero(np.arange(len(end)) + reach <= end)
            if not len(rows):
                return rest
            rest[rows] = _product(rest[rows], rest[rows + reach])
            reach *= 2

    def solve(self, ahead: np.ndarray, ends: np.ndarray) -> None:
        """Cheapest arcs and doubled pointers. `ahead`: for each segment the cost of what follows it, by state;
        `ends`: whether nothing follows."""
        n, count = len(self.pos), len(self.first)
        cost = (self.to_segment_ends() + ahead[self.segment][:, None, :]).min(2)
        # layers of four nodes: one before each row, and one behind each segment
        layer = np.arange(n) + self.segment
        behind = self.last + np.arange(count) + 1
        distance = np.full((n + count, 4), FAR)
        distance[layer], distance[behind] = cost, ahead
        own = np.arange(4 * (n + count)).reshape(-1, 4)
        letter = np.full(own.shape, len(LETTERS))  # none: the path ends here
        target = own.copy()
        every = np.arange(4)

        def offer(layers: np.ndarray, states: np.ndarray, code: int, price: np.ndarray, to: np.ndarray) -> None:
            """Take an arc where it is on a cheapest path; letters come in falling order, so the least stays."""
            flat = distance.reshape(-1)
            best = (distance[layers, states] < FAR) & (price + flat[to] == distance[layers, states])
            letter[layers[best], states[best]] = code
            target[layers[best], states[best]] = to[best]

        grid = np.repeat(layer, 4), np.tile(every, n)
        row = np.repeat(np.arange(n), 4)
        offer(*grid, 3, np.where(self.must_go[row], FAR, REROLE + self.extra[row]), (grid[0] + 1) * 4 + NEEDED[grid[1]])
        role = self.code[row]
        fits = (role > 0) & ~self.must_go[row] & ((role == NEEDED[grid[1]]) | ((role == SYSTEM) & (grid[1] == NONE)))
        offer(*grid, 2, np.where(fits, self.extra[row], FAR), (grid[0] + 1) * 4 + role)
        offer(*grid, 1, np.full(4 * n, INSERT), grid[0] * 4 + NEEDED[grid[1]])
        closing = np.repeat(behind[ends], 2), np.tile([SYSTEM, USER], int(ends.sum()))
        offer(*closing, 1, np.full(len(closing[0]), INSERT), closing[0] * 4 + NEEDED[closing[1]])
        offer(*grid, 0, np.full(4 * n, DELETE), (grid[0] + 1) * 4 + grid[1])

        self.letter, self.behind = letter.reshape(-1), behind
        self.pointers = [target.reshape(-1)]
        self.length = (self.letter < len(LETTERS)).astype(np.int64)
        rank, kinds = self.letter, len(LETTERS) + 1
        while True:
            ahead_of = self.pointers[-1]
            names, longer = np.unique(rank * kinds + rank[ahead_of], return_inverse=True)
            self.length = self.length + self.length[ahead_of]
            self.pointers.append(ahead_of[ahead_of])
            settled = len(names) == kinds and np.array_equal(self.pointers[-1], ahead_of)
            rank, kinds = longer, len(names)
            if settled:
                break

    def left_in(self) -> np.ndarray:
        """For each segment the state it is left in, by the state it is entered in."""
        starts = (self.first + np.arange(len(self.first)))[:, None] * 4 + np.arange(4)
        return self.pointers[-1][starts] % 4

    def edits(self, entered: np.ndarray) -> pa.Table:
        """The least path's edits: for each row its letter, and the inserts before it and, at the end, behind it."""
        n = len(self.pos)
        starts = (self.first + np.arange(len(self.first))) * 4 + entered
        length = self.length[starts]
        node = np.repeat(starts, length)
        place = np.arange(len(node)) - np.repeat(np.cumsum(length) - length, length)
        for k, pointer in enumerate(self.pointers):
            node = np.where(place >> k & 1, pointer[node], node)
        owner = np.repeat(np.arange(len(self.first)), length)
        letter, row = self.letter[node], node // 4 - owner
        closing = row > self.last[owner]
        inserted = letter == 1
        before = np.bincount(row[inserted & ~closing], minlength=n)[:n]
        after = np.bincount(row[inserted & closing] - 1, minlength=n)[:n]
        letters = np.zeros(n, np.int64)
        letters[row[~inserted]] = letter[~inserted]
        columns = [self.conv, pa.array(self.pos), pa.array(before, pa.int32()), pa.array(np.array(LETTERS)[letters], pa.string()), pa.array(after, pa.int32()), pa.array(self.fault, pa.int32())]
        return pa.Table.from_arrays(columns, names=[c.split()[0] for c in EDIT_ROW.split(", ")])


# ---- parts of the whole table --------------------------------------------------------------------------------


def _transfers(rows: pa.Table) -> pa.Table:
    part = _Part(rows)
    matrices = part.to_segment_ends()[part.first].reshape(len(part.first), 16)
    return _segments(rows, part, "matrix", pa.array(list(matrices), pa.list_(pa.int64())))


def _segments(rows: pa.Table, part: _Part, name: str, values: pa.Array) -> pa.Table:
    number = pa.array([rows.column("part")[0].as_py()] * len(part.first), pa.int64())
    return pa.Table.from_arrays([part.conv.take(pa.array(part.first)), number, values], names=["conv_id", "part", name])


def _solved(rows: pa.Table, borders: pa.Table) -> tuple[_Part, np.ndarray]:
    part = _Part(rows)
    ahead, ends, entered = np.tile(END, (len(part.first), 1)), np.ones(len(part.first), bool), np.zeros(len(part.first), np.int64)
    known = part.segment_of()
    for border in borders.to_pylist():
        at = known[border["conv_id"]]
        ahead[at], ends[at], entered[at] = border["ahead"], border["ends"], border.get("entered", 0)
    part.solve(ahead, ends)
    return part, entered


def _maps(rows: pa.Table, borders: pa.Table) -> pa.Table:
    part, _ = _solved(rows, borders)
    return _segments(rows, part, "left_in", pa.array(list(part.left_in()), pa.list_(pa.int64())))


def _edits(rows: pa.Table, borders: pa.Table) -> pa.Table:
    if not len(rows):
        return pa.Table.from_batches([], _Part.EMPTY)
    part, entered = _solved(rows, borders)
    return part.edits(entered)


_Part.EMPTY = pa.schema([("conv_id", pa.int64()), ("pos", pa.int64()), ("before", pa.int32()), ("letter", pa.string()), ("after", pa.int32()), ("fault", pa.int32())])


def _chained(segments: DataFrame, forward: bool) -> DataFrame:
    """Stream the segments of each conversation, holding what goes from one to the next: four costs or one state."""

    def backwards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, ahead = object(), END
        for batch in batches:
            out, ends = [], []
            for conv, matrix in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                ends.append(conv != current)
                current, ahead = conv, END if conv != current else ahead
                out.append([int(x) for x in ahead])
                ahead = np.minimum((np.array(matrix).reshape(4, 4) + ahead).min(1), FAR)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.list_(pa.int64())), pa.array(ends, pa.bool_())], names=["conv_id", "part", "ahead", "ends"])

    def forwards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state = object(), NONE
        for batch in batches:
            out = []
            for conv, left_in in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                current, state = conv, NONE if conv != current else state
                out.append(state)
                state = left_in[state]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.int64())], names=["conv_id", "part", "entered"])

    dealt = segments.repartition("conv_id")
    if forward:
        return dealt.sortWithinPartitions("conv_id", "part").mapInArrow(forwards, "conv_id bigint, part bigint, entered bigint")
    return dealt.sortWithinPartitions("conv_id", F.desc("part")).mapInArrow(backwards, "conv_id bigint, part bigint, ahead array<bigint>, ends boolean")


def _meeting(rows: DataFrame, borders: DataFrame, run, schema: str) -> DataFrame:
    return rows.groupBy("part").cogroup(borders.groupBy("part")).applyInArrow(run, schema)


def _ordered(work: Workspace, rows: DataFrame, rows_a_part: int) -> DataFrame:
    """All rows with `pos`, their place in the order of conversations and turns; its upper bits are the part."""
    flat = work.table(
        rows.select(
            F.col("conv_id").cast("bigint").alias("conv_id"),
            F.col("turn").cast("bigint").alias("turn"),
            F.coalesce("role", F.lit(" ")).alias("role"),
            F.coalesce("text", F.lit(" ")).alias("text"),
        ).select("*", F.xxhash64("role", "text").alias("high"), F.xxhash64(F.lit(1), "role", "text").alias("low")),
        "rows",
    )
    parts = max(int(work.spark.conf.get("spark.sql.shuffle.partitions")), -(-flat.count() // rows_a_part))
    # the last key only spreads equal rows
    order = [F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), F.asc("role"), F.asc("high"), F.asc("low"), F.asc("copy")]
    dealt = flat.withColumn("copy", F.monotonically_increasing_id()).repartitionByRange(parts, *order).sortWithinPartitions(*order)
    return work.table(dealt.drop("copy").withColumn("pos", F.monotonically_increasing_id()), "ordered")


def _narrow(work: Workspace, ordered: DataFrame) -> DataFrame:
    """What the edits depend on: (conv_id, part, pos, code, fault)."""
    firsts = ordered.groupBy("conv_id", "high", "low").agg(F.min("pos").alias("pos")).select("pos", F.lit(True).alias("new"))
    end = F.substring(F.rtrim("text", F.lit(BLANKS)), -1, 1)
    initial = F.substring("role", 1, 1)
    code = F.when(initial == "s", SYSTEM).when(initial == "u", USER).when(initial == "a", ASSISTANT).otherwise(0)
    looked = ordered.select("conv_id", F.shiftright("pos", 33).alias("part"), "pos", code.alias("code"), end.alias("end")).join(firsts, "pos", "left")
    fault = F.when(F.col("end") == "", 1).when(F.col("new").isNull(), 2).when(~F.col("end").isin(".", "!", "?"), 3).otherwise(0)
    return work.table(looked.select("conv_id", "part", "pos", "code", fault.alias("fault")), "narrow")


def edits(work: Workspace, ordered: DataFrame) -> DataFrame:
    """The cheapest edits of every row of `_ordered`: letter, inserts before and, behind the last row, after it."""
    narrow = _narrow(work, ordered)
    spans = narrow.groupBy(F.col("conv_id").alias("long_id")).agg(F.min("part").alias("lo"), F.max("part").alias("hi")).where("lo < hi")
    crossing = work.table(narrow.join(spans, F.col("conv_id").eqNullSafe(F.col("long_id")), "left_semi"), "crossing")
    transfers = crossing.groupBy("part").applyInArrow(_transfers, "conv_id bigint, part bigint, matrix array<bigint>")
    ahead = work.table(_chained(transfers, forward=False), "ahead")
    maps = _meeting(crossing, ahead, _maps, "conv_id bigint, part bigint, left_in array<bigint>")
    entered = work.table(_chained(maps, forward=True), "entered")
    met = F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("part") == F.col("at"))
    borders = ahead.join(entered.select(F.col("conv_id").alias("of"), F.col("part").alias("at"), "entered"), met).drop("of", "at")
    return _meeting(narrow, borders, _edits, EDIT_ROW)


def _streams(rows: DataFrame, conversations: DataFrame | None, rows_a_part: int) -> DataFrame:
    """Rows, their edits and one marker for each conversation, sorted by conversation and place."""
    work = Workspace(rows.sparkSession, "conversation-repair")
    ordered = _ordered(work, rows, rows_a_part)
    found = work.table(edits(work, ordered), "edits")
    everyone = (conversations if conversations is not None else ordered).select(F.col("conv_id").cast("bigint").alias("conv_id")).distinct()
    markers = everyone.select("conv_id", F.lit(-1).cast("bigint").alias("pos"))
    letters = found.withColumn("kind", F.lit(0))
    texts = ordered.select("conv_id", "pos", "turn", "role", "text", F.lit(1).alias("kind"))
    stream = letters.unionByName(texts, allowMissingColumns=True).unionByName(markers, allowMissingColumns=True)
    columns = ["conv_id", "pos", "kind", "before", "letter", "after", "fault", "turn", "role", "text"]
    return stream.select(*columns).repartition("conv_id").sortWithinPartitions(F.asc_nulls_first("conv_id"), "pos", "kind")


ROLES = ["", "system", "user", "assistant"]
INITIALS = {"s": SYSTEM, "u": USER, "a": ASSISTANT}


class _Conversation:
    """One conversation while its rows go by."""

    def __init__(self, conv_id):
        self.conv_id, self.state, self.audit, self.cost = conv_id, NONE, [], 0
        self.hash, self.rows = hashlib.sha256(), 0
        self.faults = [0] * len(FAULTS)
        self.low = self.high = self.turn = None
        self.turns = self.illegal = 0
        self.before = None

    def insert(self, times: int) -> Iterator[tuple]:
        for _ in range(times):
            self.audit.append("I")
            self.cost += INSERT
            self.state = int(NEEDED[self.state])
            yield self.out(None, ROLES[self.state], "")

    def out(self, turn, role: str, text: str) -> tuple:
        self.hash.update(f"{chr(10) if self.rows else ''}{role}:{text}".encode())
        self.rows += 1
        return self.conv_id, self.rows - 1, turn, role, text

    def row(self, edit: tuple, turn, role: str, text: str) -> Iterator[tuple]:
        before, letter, after, fault = edit
        if turn is not None:
            self.turns += turn != self.turn
            self.low, self.high, self.turn = turn if self.low is None else self.low, turn, turn
        if self.before is not None:
            self.illegal += self.before + role[:1] not in ("su", "ua", "au")
        self.before = role[:1]
        self.faults[fault] += 1
        yield from self.insert(before)
        self.audit.append(letter)
        if letter == "D":
            self.cost += DELETE
        else:
            self.cost += TRUNCATED * (fault == 3) + REROLE * (letter == "R")
            self.state = int(NEEDED[self.state]) if letter == "R" else INITIALS[role[0]]
            yield self.out(turn, ROLES[self.state] if letter == "R" else role, text)
        yield from self.insert(after)

    def summary(self) -> tuple:
        gaps = 0 if self.low is None else min(self.high - self.low + 1 - self.turns, (1 << 63) - 1)
        return (self.conv_id, gaps, *self.faults[1:], self.illegal, self.cost, "".join(self.audit), self.hash.hexdigest())


def _walk(batches: Iterator[pa.RecordBatch], summaries: bool) -> Iterator[tuple]:
    current, edit = None, None
    for batch in batches:
        for conv_id, pos, kind, before, letter, after, fault, turn, role, text in zip(*(c.to_pylist() for c in batch.columns)):
            if pos < 0:  # the marker opens a conversation
                if current is not None and summaries:
                    yield current.summary()
                current = _Conversation(conv_id)
            elif kind == 0:
                edit = (before, letter, after, fault)
            else:
                for out in current.row(edit, turn, role, text):
                    if not summaries:
                        yield out
    if current is not None and summaries:
        yield current.summary()


def _batched(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 100 + len(row[-2]) + len(row[-1])
        if len(held) == 1000 or size > 4 << 20:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"bigint": pa.int64(), "string": pa.string()}
    return pa.schema([(name, kinds[kind]) for name, kind in (c.split() for c in ddl.split(", "))])


def summaries(rows: DataFrame, conversations: DataFrame | None = None, rows_a_part: int = ROWS_A_PART) -> DataFrame:
    """One row per conversation of `conversations` (by default of `rows`): its faults, and its cheapest repair's cost,
    audit and digest."""
    schema = _arrow(SUMMARY_ROW)
    return _streams(rows, conversations, rows_a_part).mapInArrow(lambda b: _batched(_walk(b, True), schema), SUMMARY_ROW)


def repaired(rows: DataFrame, rows_a_part: int = ROWS_A_PART) -> DataFrame:
    """The repaired conversations: rows (conv_id, place, turn, role, text); inserted ones have no turn."""
    schema = _arrow(REPAIRED_ROW)
    return _streams(rows, None, rows_a_part).mapInArrow(lambda b: _batched(_walk(b, False), schema), REPAIRED_ROW)
