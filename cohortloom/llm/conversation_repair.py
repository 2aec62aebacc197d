"""Conversation structure repair: the cheapest edits that give every conversation legal turns.

Legal role initials are ``(s?(ua)+)?``: an optional system turn, then user and assistant in
turns. A row may be kept (0), get the role user or assistant (1) or be deleted (2); a row with
empty text may be inserted anywhere (5); a truncated row that stays costs 5 more, blank and
duplicate rows must go. Of the cheapest edits those with the ASCII-least audit, the initials of
the edits in order (Delete, Insert, Keep, Rerole), are applied.

Prefix-doubling path ranking. A cost dynamic program from the end gives the cost to go of every
node (row, state); arcs that keep it are optimal. Nodes are ranked by the least audit of length 1,
2, 4, ... that optimal arcs spell from them: the rank of a pair of ranks, of the node and of the
node its pointer leads to, while pointers double. An audit spells one path, as the arcs of a node
have different initials. The final ranks select each node's arc, and the doubled pointers yield the
node at every place of the path without walking it. All conversations of a batch are solved together
in numpy.

Conversations of up to ``PART`` rows are dealt out by id and repaired in one sorted stream. Longer
ones, however long, are numbered by a range sort and cut into parts. Parts are solved in parallel:
first each part's costs between its entry and exit states (4 x 4), then, over this narrow table, the
costs to go at every border, then the exit for every entry, then the entry of each part, and
last the part's edits. Only the finished pieces of one conversation, ``PART`` times fewer rows,
come together in order, since SHA-256 reads a text from its start.

Defined cases: rows are taken in the order of ``place``, then role, then text; a null role or
text is one space; a role is judged by its first character, case-sensitively; a null id is an id of its own;
repeated rows are duplicates of the first; null turns are left out of the gaps, which are null if
they exceed a bigint; a conversation without rows has no result (the caller knows the ids); no rows
give no result. Only the named columns are read, so other columns may have any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortloom.llm.common import BLANKS, modest_batches
from cohortloom.operators.materialize import settle
from cohortloom.operators.numbering import global_row_number
from cohortloom.operators.sizing import broadcast_small

PART = 1024  # rows of a conversation that are solved together

DELETE, INSERT, KEEP, REROLE = 1, 2, 3, 4
INITIALS = np.frombuffer(b"\0DIKR", np.uint8)
# States: nothing yet, after system, after user, after assistant; 4 stands for none.
STATES, NONE = 4, 4
NEXT = np.array([2, 2, 3, 2])  # after an inserted or reroled turn
KEPT = np.array([[1, 4, 4, 4], [2, 2, 4, 2], [4, 4, 3, 4], [4, 4, 4, 4]])  # by the initial s, u, a, other
FAR = 1 << 60
FINAL = np.array([0, 10, 5, 0])  # costs to go after the last row: what must still be inserted


def _closed(costs: np.ndarray) -> np.ndarray:
    """Costs to go with insertions before the next row; states are the second axis."""
    start, system, user, assistant = (costs[:, s] for s in range(STATES))
    after_user = np.minimum(user, assistant + 5)
    after_assistant = np.minimum(assistant, user + 5)
    return np.stack(
        [np.minimum(start, after_user + 5), np.minimum(system, after_user + 5), after_user, after_assistant], 1
    )


class Rows:
    """Rows of several conversations, or parts of them, one after the other."""

    def __init__(self, kind: np.ndarray, fault: np.ndarray, starts: np.ndarray):
        self.kind, self.fault = kind, fault
        self.must_go = (fault == BLANK) | (fault == DUPLICATE)
        self.extra = np.where(fault == TRUNCATED, 5, 0)
        self.starts = starts
        self.lengths = np.diff(np.append(starts, len(kind)))
        self.first = starts + np.arange(len(starts))  # a group has a node more than rows
        self.last = self.first + self.lengths

    def costs(self, end: np.ndarray) -> np.ndarray:
        """Costs to go of (node, state, case), given those of each group's end."""
        to_go = np.full((len(self.kind) + len(self.starts), *end.shape[1:]), FAR)
        to_go[self.last] = end
        order = np.argsort(-self.lengths, kind="stable")
        falling = -self.lengths[order]
        for step in range(int(-falling[0]) if len(falling) else 0):
            some = order[: np.searchsorted(falling, -step, "left")]
            row = self.starts[some] + self.lengths[some] - 1 - step
            node = self.last[some] - 1 - step
            to_go[node] = _closed(np.min(self._choices(row, to_go[node + 1]), axis=0))
        return to_go

    def _choices(self, row: np.ndarray, after: np.ndarray) -> tuple[np.ndarray, ...]:
        """Costs of Delete, Keep and Rerole in every state."""
        padded = np.concatenate([after, np.full_like(after[:, :1], FAR)], 1)
        stays = np.where(self.must_go[row], FAR, self.extra[row])[:, None, None]
        kept = np.take_along_axis(padded, KEPT[self.kind[row]][:, :, None], 1)
        return after + 2, kept + stays, after[:, NEXT] + stays + 1

    def paths(self, end: np.ndarray, final: np.ndarray) -> Paths:
        return Paths(self, self.costs(end[:, :, None])[:, :, 0], final)


class Paths:
    """The cheapest edits of ASCII-least audit from every node, as doubled pointers."""

    def __init__(self, rows: Rows, to_go: np.ndarray, final: np.ndarray):
        nodes = len(to_go)
        self.rows, self.to_go = rows, to_go
        inner = np.ones(nodes, bool)
        inner[rows.last] = False
        self.row_of = np.cumsum(inner) - 1  # of inner nodes
        here = np.flatnonzero(inner)
        costs = np.full((nodes, 5, STATES), FAR)
        heads = np.tile(np.arange(nodes * STATES).reshape(nodes, 1, STATES), (1, 5, 1))
        insertable = inner.copy()
        insertable[rows.last] = final  # before the first row of a next part, that part inserts
        costs[insertable, INSERT] = to_go[insertable][:, NEXT] + 5
        heads[:, INSERT] = (np.arange(nodes) * STATES)[:, None] + NEXT
        if len(here):
            row = self.row_of[here]
            drop, keep, rerole = rows._choices(row, to_go[here + 1][:, :, None])
            costs[here, DELETE], costs[here, KEEP], costs[here, REROLE] = drop[..., 0], keep[..., 0], rerole[..., 0]
            following = ((here + 1) * STATES)[:, None]
            heads[here, DELETE] = following + np.arange(STATES)
            heads[here, KEEP] = following + np.minimum(KEPT[rows.kind[row]], STATES - 1)
            heads[here, REROLE] = following + NEXT
        optimal = costs == to_go[:, None, :]
        optimal = optimal.transpose(0, 2, 1).reshape(-1, 5)
        heads = heads.transpose(0, 2, 1).reshape(-1, 5)
        self.initial, self.pointers, self.length = _ranked(optimal, heads)

    def walk(self, entry: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """From the entry state of every group: the nodes (times states, plus state) of the path,
        the group of each, and the node where the path ends."""
        start = self.rows.first * STATES + entry
        sizes = self.length[start]
        group = np.repeat(np.arange(len(start)), sizes)
        place = np.arange(len(group)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        node, end = start[group], start
        for bit, pointer in enumerate(self.pointers):
            node = np.where(place >> bit & 1, pointer[node], node)
            end = np.where(sizes >> bit & 1, pointer[end], end)
        return node, group, end


def _ranked(optimal: np.ndarray, heads: np.ndarray) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """Each node's initial, pointers over 1, 2, 4, ... edits and audit length."""
    nodes = np.arange(len(optimal))
    initial = np.where(optimal.any(axis=1), np.argmax(optimal, axis=1), 0)
    length = (initial > 0).astype(np.int64)
    rank, pointer = initial, np.where(initial > 0, heads[nodes, initial], nodes)
    while (rank[pointer] > 0).any():
        length = length + length[pointer]
        rank = np.unique(rank * (rank.max() + 1) + rank[pointer], return_inverse=True)[1]
        pointer = pointer[pointer]
    by_rank = np.where(optimal, np.arange(5) * (rank.max() + 1) + rank[heads], FAR)
    chosen = np.argmin(by_rank, axis=1)
    initial = np.where(optimal.any(axis=1), chosen, 0)
    pointers = [np.where(initial > 0, heads[nodes, initial], nodes)]
    while (initial[pointers[-1]] > 0).any():
        pointers.append(pointers[-1][pointers[-1]])
    return initial, pointers, length


# Faults, in the order in which they count.
BLANK, DUPLICATE, TRUNCATED = 1, 2, 3
GOOD_PAIRS = ((0, 1), (1, 2), (2, 1))
COUNTS = ("blank", "duplicate", "truncated", "illegal", "cost")


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Whole groups of equal keys from sorted batches, with their first rows."""
    held: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = table if held is None else pa.concat_tables([held, table])
        starts = _starts(table, keys)
        if len(starts) > 1:
            yield table.slice(0, starts[-1]).combine_chunks(), starts[:-1]
        held = table.slice(starts[-1]) if len(starts) else None
    if held is not None:
        yield held.combine_chunks(), np.zeros(1, np.int64)


def _starts(table: pa.Table, keys: list[str]) -> np.ndarray:
    values = list(zip(*(table[key].to_pylist() for key in keys)))
    new = [i for i, value in enumerate(values) if i == 0 or value != values[i - 1]]
    return np.array(new, np.int64)


def _array(table: pa.Table, name: str) -> np.ndarray:
    return table[name].to_numpy()


def _with_duplicates(table: pa.Table, starts: np.ndarray) -> np.ndarray:
    fault = _array(table, "fault").astype(np.int64)
    roles, texts = table["role"].to_pylist(), table["text"].to_pylist()
    ends = [*starts[1:].tolist(), len(roles)]
    for start, end in zip(starts.tolist(), ends):
        seen = set()
        for i in range(start, end):
            turn = roles[i], texts[i]
            if turn not in seen:
                seen.add(turn)
            elif fault[i] != BLANK:
                fault[i] = DUPLICATE
    return fault


def _whole_pieces(batches):
    """One piece per short conversation."""
    for table, starts in _groups(batches, ["id"]):
        groups = len(starts)
        rows = Rows(_array(table, "kind"), _with_duplicates(table, starts), starts)
        ends = np.tile(FINAL, (groups, 1))
        entry = np.zeros(groups, np.int64)
        yield _piece(table, rows, rows.paths(ends, np.ones(groups, bool)), entry, np.zeros(groups, np.int64))


def _parts(batches) -> Iterator[tuple[pa.Table, Rows, np.ndarray, np.ndarray]]:
    """Parts of long conversations: rows, costs to go at the end, whether it is the last part."""
    for table, starts in _groups(batches, ["id", "part"]):
        rows = Rows(_array(table, "kind"), _array(table, "fault").astype(np.int64), starts)
        final = _array(table, "final")[starts]
        known = "ends" in table.column_names
        ends = np.array(table["ends"].take(pa.array(starts)).to_pylist()) if known else np.zeros((len(starts), 4), np.int64)
        yield table, rows, ends, final


def _crossings(batches):
    """Costs from every entry to every exit of a part; the last part's are those to the end."""
    for table, rows, _, final in _parts(batches):
        exits = np.where(np.eye(STATES, dtype=bool), 0, FAR)[None].repeat(len(final), 0)
        exits[final] = FINAL[None, :, None]
        costs = rows.costs(exits)[rows.first]
        yield _keyed(table, rows, {"costs": pa.array(costs.reshape(len(final), -1).tolist(), pa.list_(pa.int64()))})


def _borders(batches):
    """From the last part to the first: the costs to go at every part's end."""
    conversation, to_go = None, None
    for batch in batches:
        ends = []
        for id_, final, costs in zip(batch["id"].to_pylist(), batch["final"].to_pylist(), batch["costs"].to_pylist()):
            crossing = np.array(costs).reshape(STATES, STATES)
            if final or id_ != conversation:
                conversation, to_go = id_, FINAL
                ends.append(to_go.tolist())
                to_go = crossing[:, 0]
            else:
                ends.append(to_go.tolist())
                to_go = (crossing + to_go).min(axis=1)
        yield pa.record_batch(
            [batch["id"], batch["part"], pa.array(ends, pa.list_(pa.int64()))], names=["id", "part", "ends"]
        )


def _exits(batches):
    """The state in which each part is left, for every entry state."""
    for table, rows, ends, final in _parts(batches):
        paths = rows.paths(ends, final)
        exits = [paths.walk(np.full(len(final), s))[2] % STATES for s in range(STATES)]
        yield _keyed(table, rows, {"exits": pa.array(np.stack(exits, 1).tolist(), pa.list_(pa.int64()))})


def _entries(batches):
    """From the first part to the last: the state in which each is entered."""
    conversation, state = None, 0
    for batch in batches:
        entries = []
        for id_, part, exits in zip(batch["id"].to_pylist(), batch["part"].to_pylist(), batch["exits"].to_pylist()):
            if part == 0 or id_ != conversation:
                conversation, state = id_, 0
            entries.append(state)
            state = exits[state]
        yield pa.record_batch(
            [batch["id"], batch["part"], pa.array(entries, pa.int64())], names=["id", "part", "entry"]
        )


def _part_pieces(batches):
    for table, rows, ends, final in _parts(batches):
        entry = _array(table, "entry")[rows.starts]
        yield _piece(table, rows, rows.paths(ends, final), entry, _array(table, "part")[rows.starts])


def _keyed(table: pa.Table, rows: Rows, columns: dict[str, pa.Array]) -> pa.RecordBatch:
    at = pa.array(rows.starts)
    keys = {name: table[name].take(at).combine_chunks() for name in ("id", "part", "final")}
    return pa.record_batch(list((keys | columns).values()), names=list(keys | columns))


def _piece(table: pa.Table, rows: Rows, paths: Paths, entry: np.ndarray, part: np.ndarray) -> pa.RecordBatch:
    """What becomes of each group: audit, repaired turns, counts."""
    groups, n = len(entry), len(rows.kind)
    node, group, end = paths.walk(entry)
    edit = paths.initial[node]
    spelled = INITIALS[edit].tobytes().decode()
    cuts = np.searchsorted(group, np.arange(groups + 1)).tolist()
    audits = [spelled[a:b] for a, b in zip(cuts, cuts[1:])]

    stays = edit != DELETE
    edit, at, state, of = edit[stays], paths.row_of[node[stays] // STATES], node[stays] % STATES, group[stays]
    # Behind the rows' own values stand those of inserted and reroled turns.
    roles = pa.concat_arrays([table["role"].combine_chunks(), pa.array(["user", "assistant"])])
    texts = pa.concat_arrays([table["text"].combine_chunks(), pa.array([""])])
    role_at = np.where(edit == KEEP, at, n + NEXT[state] - 2)
    text_at = np.where(edit == INSERT, n, at)
    offsets = pa.array(np.searchsorted(of, np.arange(groups + 1)), pa.int32())
    owner = np.repeat(np.arange(groups), rows.lengths)
    pair = rows.kind[:-1] * 4 + rows.kind[1:]
    wrong = ~np.isin(pair, [a * 4 + b for a, b in GOOD_PAIRS]) & (owner[:-1] == owner[1:])
    counted = [np.bincount(owner[rows.fault == f], minlength=groups) for f in (BLANK, DUPLICATE, TRUNCATED)]
    counted.append(np.bincount(owner[:-1][wrong], minlength=groups))
    costs = paths.to_go.reshape(-1)
    counted.append(costs[rows.first * STATES + entry] - costs[end])
    ends = rows.starts + rows.lengths - 1
    columns = {
        "id": table["id"].take(pa.array(rows.starts)).combine_chunks(),
        "part": pa.array(part, pa.int64()),
        "audit": pa.array(audits, pa.string()),
        "roles": pa.ListArray.from_arrays(offsets, roles.take(pa.array(role_at))),
        "texts": pa.ListArray.from_arrays(offsets, texts.take(pa.array(text_at))),
        "first": pa.array(rows.kind[rows.starts], pa.int64()),
        "last": pa.array(rows.kind[ends], pa.int64()),
        **{name: pa.array(values, pa.int64()) for name, values in zip(COUNTS, counted)},
    }
    return pa.record_batch(list(columns.values()), names=list(columns))


class _Total:
    """The finished pieces of one conversation, in order."""

    def __init__(self, id_):
        self.id, self.digest, self.audit, self.last = id_, hashlib.sha256(), [], None
        self.counts, self.begun = dict.fromkeys(COUNTS, 0), False

    def add(self, piece: dict) -> None:
        for name in COUNTS:
            self.counts[name] += piece[name]
        if self.last is not None and (self.last, piece["first"]) not in GOOD_PAIRS:
            self.counts["illegal"] += 1
        self.last = piece["last"]
        self.audit.append(piece["audit"])
        for role, text in zip(piece["roles"], piece["texts"]):
            self.digest.update(f"{chr(10) if self.begun else ''}{role}:{text}".encode())
            self.begun = True

    def row(self) -> dict:
        found = {"id": self.id, "audit": "".join(self.audit), "repaired_sha256": self.digest.hexdigest()}
        return found | self.counts


def _finish(batches):
    """Sums up the pieces of each conversation, which come in order."""
    total = None
    for batch in batches:
        texts = [("id", batch.schema.field("id").type), ("audit", pa.string()), ("repaired_sha256", pa.string())]
        schema, done = pa.schema(texts + [(name, pa.int64()) for name in COUNTS]), []
        for piece in batch.to_pylist():
            if total is None or piece["id"] != total.id:
                done += [] if total is None else [total.row()]
                total = _Total(piece["id"])
            total.add(piece)
        yield pa.RecordBatch.from_pylist(done, schema)
    if total is not None:
        yield pa.RecordBatch.from_pylist([total.row()], schema)


def _finished(batches):
    return _finish(_whole_pieces(batches))


def prepared(
    turns: DataFrame, id_: str, place: Column, turn: Column, role: Column, text: Column
) -> DataFrame:
    """The rows as the stages read them: id, turn, place, role, text, kind and own fault."""
    rows = turns.select(
        F.col(id_).alias("id"),
        turn.cast("long").alias("turn"),
        place.alias("place"),
        F.coalesce(role, F.lit(" ")).alias("role"),
        F.coalesce(text, F.lit(" ")).alias("text"),
    )
    bare = F.rtrim("text", F.lit(BLANKS))
    initial = F.substring("role", 1, 1)
    kind = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    fault = F.when(bare == "", BLANK).when(~F.substring(bare, -1, 1).isin(".", "!", "?"), TRUNCATED)
    return rows.withColumns({"kind": kind.cast("long"), "fault": fault.otherwise(0)})


class Repair:
    """The repair of conversations: ``pieces``, ``turns`` and ``summaries`` are DataFrames.

    ``place`` orders a conversation's rows, ``turn`` is the number that gaps are counted in.
    """

    def __init__(self, rows: DataFrame, id_: str, place: Column, turn: Column, role: Column, text: Column):
        modest_batches(rows.sparkSession)
        self.rows = prepared(rows, id_, place, turn, role, text)
        turns = self.rows.groupBy("id", "turn").agg(F.count(F.lit(1)).alias("n"))
        span = F.try_subtract(F.max("turn"), F.min("turn"))
        self.heads = settle(
            turns.groupBy("id").agg(
                F.sum("n").alias("n"),
                F.when(F.count("turn") == 0, 0).otherwise(F.try_subtract(span, F.count("turn") - 1)).alias("gaps"),
            )
        )
        self.id_type = self.rows.schema["id"].dataType
        long = self.heads.filter(F.col("n") > PART).select(F.col("id").alias("long_id"))
        self.has_long = bool(long.head(1))
        self.long = broadcast_small(long)[0] if self.has_long else None

    def _schema(self, fields: str) -> T.StructType:
        found = T.StructType([T.StructField("id", self.id_type)])
        for field in T.StructType.fromDDL(fields).fields:
            found = found.add(field)
        return found

    def _piece_schema(self) -> T.StructType:
        counts = ", ".join(f"{name} long" for name in COUNTS)
        return self._schema(
            f"part long, audit string, roles array<string>, texts array<string>, first long, last long, {counts}"
        )

    def _short_rows(self) -> DataFrame:
        rows = self.rows
        if self.has_long:
            rows = rows.join(self.long, rows["id"].eqNullSafe(F.col("long_id")), "left_anti")
        return rows.repartition("id").sortWithinPartitions("id", "place", "role", "text").drop("place", "turn")

    def _long_pieces(self) -> DataFrame:
        long = self.rows.join(self.long, self.rows["id"].eqNullSafe(F.col("long_id")), "left_semi")
        numbered = global_row_number(long.drop("turn"), ["id", "place", "role", "text"], "number").drop("place")
        firsts = settle(numbered.groupBy("id").agg(F.min("number").alias("start"), F.max("number").alias("stop")))
        placed = _joined(numbered, broadcast_small(firsts)[0], ["id"]).withColumns(
            {
                "part": F.floor((F.col("number") - F.col("start")) / PART),
                "final": F.floor((F.col("stop") - F.col("start")) / PART) == F.floor((F.col("number") - F.col("start")) / PART),
            }
        )
        twice = settle(
            numbered.groupBy("id", "role", "text")
            .agg(F.min("number").alias("earliest"), F.count(F.lit(1)).alias("n"))
            .filter("n > 1")
            .drop("n")
        )
        placed = _joined(placed, twice, ["id", "role", "text"], "left")
        fault = F.when((F.col("number") > F.col("earliest")) & (F.col("fault") != BLANK), DUPLICATE)
        placed = settle(
            placed.withColumn("fault", fault.otherwise(F.col("fault"))).select(
                "id", "part", "number", "final", "role", "text", "kind", "fault"
            )
        )
        parts, keyed = ["id", "part"], "part long, final boolean"
        crossings = _dealt(placed.drop("role", "text"), parts, "number").mapInArrow(
            _crossings, self._schema(f"{keyed}, costs array<long>")
        )
        backwards = crossings.repartition("id").sortWithinPartitions("id", F.desc("part"))
        ends = settle(backwards.mapInArrow(_borders, self._schema("part long, ends array<long>")))
        known = _joined(placed, ends, parts)
        exits = _dealt(known.drop("role", "text"), parts, "number").mapInArrow(
            _exits, self._schema(f"{keyed}, exits array<long>")
        )
        forwards = exits.repartition("id").sortWithinPartitions("id", "part")
        entries = settle(forwards.mapInArrow(_entries, self._schema("part long, entry long")))
        return _dealt(_joined(known, entries, parts), parts, "number").mapInArrow(_part_pieces, self._piece_schema())

    def pieces(self) -> DataFrame:
        """(id, part, audit, roles, texts, counts): the repaired conversation, in parts."""
        short = self._short_rows().mapInArrow(_whole_pieces, self._piece_schema())
        return short.unionAll(self._long_pieces()) if self.has_long else short

    def turns(self) -> DataFrame:
        """(id, part, place, role, text) of every turn after the repair."""
        both = F.posexplode(F.arrays_zip("roles", "texts")).alias("place", "turn")
        listed = self.pieces().select("id", "part", both)
        return listed.select("id", "part", "place", F.col("turn.roles").alias("role"), F.col("turn.texts").alias("text"))

    def summaries(self) -> DataFrame:
        """One row per conversation: gaps, counts, cost, audit and digest of the repaired text."""
        counts = ", ".join(f"{name} long" for name in COUNTS)
        schema = self._schema(f"audit string, repaired_sha256 string, {counts}")
        found = self._short_rows().mapInArrow(_finished, schema)
        if self.has_long:
            together = self._long_pieces().repartition("id").sortWithinPartitions("id", "part")
            found = found.unionAll(together.mapInArrow(_finish, schema))
        return _joined(found, self.heads.drop("n"), ["id"])


def _dealt(rows: DataFrame, parts: list[str], number: str) -> DataFrame:
    return rows.repartition(*parts).sortWithinPartitions(*parts, number)


def _joined(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """A join on keys of which null is a value."""
    renamed = right.withColumnsRenamed({key: f"right_{key}" for key in keys})
    on = [left[key].eqNullSafe(renamed[f"right_{key}"]) for key in keys]
    return left.join(renamed, on, how).drop(*(f"right_{key}" for key in keys))


def damage(rows: DataFrame) -> DataFrame:
    """Rows of (conv_id, turn, role, text) with known faults, to repair; copy numbers repeated rows.

    The CRC-32 of conversation and turn, modulo 20, says which: 0 drops the row, 1 empties its
    text, 2 removes its final marks, 3 repeats it, 4 makes it the user's. Nulls are one space.
    """
    blank = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    role, text = F.coalesce("role", blank), F.coalesce("text", blank)
    sort = F.crc32(key.cast("binary")) % 20
    marked = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), sort.alias("sort")).filter("sort != 0")
    copies = F.when(F.col("sort") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return marked.select(
        "conv_id",
        "turn",
        F.struct("turn", F.col("role").alias("role"), F.xxhash64("text").alias("text")).alias("origin"),
        F.when(F.col("sort") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("sort") == 1, "")
        .when(F.col("sort") == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text"))
        .alias("text"),
        F.explode(copies).alias("copy"),
    )


def repair(
    rows: DataFrame,
    id_: str = "conv_id",
    place: Column | None = None,
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> Repair:
    """The repair of ``rows``; they are in the order of ``place``, by default the turn."""
    return Repair(rows, id_, F.col(turn) if place is None else place, F.col(turn), F.col(role), F.col(text))
