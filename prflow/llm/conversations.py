"""Conversation repair: the cheapest edits that make a conversation well formed.

Turns are dealt by conversation and sorted by turn inside the partitions (one
shuffle; finding repeated turns uses the same partitioning). A task then
streams over the sorted Arrow batches. What it carries from row to row is the
state of a dynamic program over four states of role order: for each state the
cheapest script so far, its place in ASCII order among the others, and the
running hash of the repaired text. So no text and no conversation is gathered.
Backpointers take four bytes a turn and are packed away in compressed blocks
when a conversation is long; the script that is returned has a letter a turn
too, so they are never more than a small multiple of the result.

Two scripts for one state that cost the same differ before either ends,
as both end in an edit of the last row; so their order is known when they meet
and the smallest whole script is the smallest at every step.
"""

from __future__ import annotations

import hashlib
import zlib
from functools import lru_cache

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLANKS = "".join(map(chr, [0x20, *range(0x09, 0x0E)]))
ENDINGS = (".", "!", "?")

# Costs of the edits.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3

# Faults of a turn, the first that holds.
FINE, BLANK, DUPLICATE, CUT = range(4)

# States: nothing kept yet, system kept, user kept, assistant kept.
START, SYSTEM, USER, ASSISTANT = range(4)
FINAL = (START, ASSISTANT)
ALLOWED = {"su", "ua", "au"}
# Any state gets to USER or ASSISTANT with two insertions, and what START can
# do beyond ASSISTANT is worth one deletion: a dearer script is never the best.
SLACK = 2 * INSERT + DELETE

PACKED = 1 << 20  # bytes of backpointers in a block

TURN = "conv_id, turn, role, text"


def _wanted(state: int) -> int:
    """The state after the role that has to follow, if it is not system."""
    return ASSISTANT if state == USER else USER


def _kept(state: int, initial: str) -> int | None:
    if initial == "s":
        return SYSTEM if state == START else None
    if initial == "u":
        return None if state == USER else USER
    if initial == "a":
        return ASSISTANT if state == USER else None
    return None


def _with_insertions(scripts: tuple) -> dict[int, tuple]:
    """state -> (cost, rank, insertions, base) of the best script that ends in
    the state, insertions after the last row included."""
    best = {}
    for base, script in enumerate(scripts):
        state, cost = base, None if script is None else script[0]
        for inserted in range(3):
            if script is None:
                break
            found = (cost + inserted * INSERT, script[1], inserted, base)
            if state not in best or found < best[state]:
                best[state] = found
            state = _wanted(state)
    return best


@lru_cache(maxsize=100_000)
def _step(scripts: tuple, initial: str, fault: int) -> tuple:
    """One row: scripts is a tuple of (cost, rank) or None by state, costs
    above the least. Gives what the least rose by, the new tuple, for each new
    state (state, base, insertions, edit), and the packed backpointers."""
    best: dict[int, tuple] = {}
    for state, (cost, rank, inserted, base) in _with_insertions(scripts).items():
        edits = [("D", DELETE, state)]
        if fault not in (BLANK, DUPLICATE):
            more = TRUNCATED if fault == CUT else 0
            edits.append(("R", REROLE + more, _wanted(state)))
            after = _kept(state, initial)
            if after is not None:
                edits.append(("K", more, after))
        for edit, price, after in edits:
            found = (cost + price, rank, "I" * inserted + edit, base, inserted)
            if after not in best or found < best[after]:
                best[after] = found
    least = min(found[0] for found in best.values())
    live = {state: found for state, found in best.items() if found[0] <= least + SLACK}
    order = sorted(live, key=lambda state: live[state][1:3])
    new = tuple(
        (live[state][0] - least, order.index(state)) if state in live else None for state in range(4)
    )
    moves = tuple((state, live[state][3], live[state][4], live[state][2][-1]) for state in live)
    packed = bytearray(4)
    for state, base, inserted, edit in moves:
        packed[state] = base | inserted << 2 | "DRK".index(edit) << 4
    return least, new, moves, bytes(packed)


class _Text:
    """Running hash of lines joined by newlines, for one script."""

    __slots__ = ("hash", "lines")

    def __init__(self, hash=None, lines: int = 0):
        self.hash, self.lines = hash or hashlib.sha256(), lines

    def copy(self) -> _Text:
        return _Text(self.hash.copy(), self.lines)

    def add(self, role: str, text: str) -> None:
        self.hash.update((("\n" if self.lines else "") + role + ":" + text).encode())
        self.lines += 1

    def insert(self, state: int, times: int) -> None:
        for _ in range(times):
            state = _wanted(state)
            self.add(_ROLES[state], "")


_ROLES = {USER: "user", ASSISTANT: "assistant"}
_INITIALS = {SYSTEM: "s", USER: "u", ASSISTANT: "a"}


class _Conversation:
    """What is carried along one conversation."""

    def __init__(self):
        self.cost, self.scripts = 0, ((0, 0), None, None, None)
        self.texts = {START: _Text()}
        self.back, self.blocks, self.rows = bytearray(), [], 0
        self.faults = [0, 0, 0, 0]
        self.illegal, self.before = 0, None
        self.first = self.last = None
        self.distinct = 0

    def turn(self, turn: int | None, role: str, text: str, fault: int) -> None:
        initial = role[:1]
        self.faults[fault] += 1
        if self.before is not None and self.before + initial not in ALLOWED:
            self.illegal += 1
        self.before = initial
        if turn is not None and turn != self.last:
            self.first = turn if self.first is None else self.first
            self.last, self.distinct = turn, self.distinct + 1
        rise, self.scripts, moves, packed = _step(self.scripts, initial if initial in ("s", "u", "a") else "", fault)
        self.cost += rise
        texts = {}
        for state, base, inserted, edit in moves:
            body = self.texts[base].copy()
            if inserted:
                body.insert(base, inserted)
            if edit != "D":
                body.add(role if edit == "K" else _ROLES[state], text)
            texts[state] = body
        self.texts = texts
        self.back += packed
        self.rows += 1
        if len(self.back) >= PACKED:
            self.blocks.append(zlib.compress(bytes(self.back), 1))
            self.back = bytearray()

    def _edits(self, state: int, insertions: int) -> tuple[str, str]:
        """Script and roles of the result, from the last row to the first."""
        script, roles = [], []

        def inserted(base: int, times: int) -> int:
            states = []
            for _ in range(times):
                base = _wanted(base)
                states.append(_INITIALS[base])
            script.extend("I" * times)
            roles.extend(reversed(states))

        inserted(state, insertions)
        while self.back or self.blocks:
            block = bytes(self.back) if self.back else zlib.decompress(self.blocks.pop())
            self.back = bytearray()
            for at in range(len(block) - 4, -1, -4):
                packed = block[at + state]
                edit = "DRK"[packed >> 4]
                script.append(edit)
                if edit != "D":
                    roles.append(_INITIALS[state])
                state = packed & 3
                inserted(state, packed >> 2 & 3)
        return "".join(reversed(script)), "".join(reversed(roles))

    def result(self) -> tuple:
        ends = _with_insertions(self.scripts)
        cost, _, insertions, base = min(ends[state] for state in FINAL if state in ends)
        text = self.texts[base]
        text.insert(base, insertions)
        script, roles = self._edits(base, insertions)
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.distinct
        return (
            self.rows, gaps, self.faults[BLANK], self.faults[DUPLICATE], self.faults[CUT], self.illegal,
            self.cost + cost, script, roles, text.hash.hexdigest(),
        )


_RESULT = (
    "n_turns long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
    "roles string, repaired_sha256 string"
)


def _turns(turns: DataFrame, present: Column | None) -> DataFrame:
    """The four columns, null roles and texts as one space, and whether the
    row counts."""
    counts = F.lit(True) if present is None else F.coalesce(present, F.lit(False))
    blank = F.lit(" ")
    return turns.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", blank).alias("role"),
        F.coalesce("text", blank).alias("text"), counts.alias("present"),
    )


def _sorted(turns: DataFrame) -> DataFrame:
    """Turns with their fault, dealt by conversation and sorted by turn."""
    dealt = turns.repartition("conv_id")
    same = Window.partitionBy("conv_id", "present", "role", F.sha2("text", 256)).orderBy(
        F.asc_nulls_first("turn")
    )
    end = F.substring(F.rtrim("text", F.lit(BLANKS)), -1, 1)
    fault = (
        F.when(end == "", BLANK).when(F.row_number().over(same) > 1, DUPLICATE)
        .when(~end.isin(*ENDINGS), CUT).otherwise(FINE)
    )
    return dealt.withColumn("fault", fault).sortWithinPartitions(
        "conv_id", F.asc_nulls_first("turn"), "role", "text"
    )


def repair(turns: DataFrame, present: Column | None = None) -> DataFrame:
    """The cheapest repair of every conversation: ``(conv_id, n_turns, gaps,
    blank, duplicate, truncated, illegal, cost, audit, roles,
    repaired_sha256)``.

    ``turns`` has conv_id, turn, role and text. Roles count by their initial.
    A turn is blank, else a duplicate (role and text were seen before in the
    conversation), else truncated (it ends without ``.!?``), else fine. Edits
    are Keep, Rerole, Delete and Insert, one letter each in ``audit``; of
    cheapest scripts the one least in ASCII order counts. ``roles`` are the
    initials of the result: nothing, or an optional system and then pairs of
    user and assistant. ``repaired_sha256`` is the hash of its ``role:text``
    lines; ``repaired_turns`` gives them as rows.

    ``present`` marks the rows that count; others only name a conversation, so
    one without turns has a row of zeros. Null roles and texts are one space,
    null turns come first and a null conv_id is a conversation of its own.
    Rows of one turn are taken by role and text. An empty table gives an empty
    result; other columns are not looked at. Texts of any length pass once.
    """
    rows = _sorted(_turns(turns, present))
    id_type = rows.schema["conv_id"].dataType.simpleString()

    def run(batches):
        import pyarrow as pa

        names = ["conv_id", *[part.split()[0] for part in _RESULT.split(", ")]]
        kinds = None
        now, open_ = None, False
        carried = _Conversation()

        def packed(done: list[tuple]):
            columns = list(zip(*done))
            types = [kinds, *[pa.int64()] * 7, *[pa.string()] * 3]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

        for batch in batches:
            kinds, done = batch.schema.field(0).type, []
            for conv_id, turn, role, text, present, fault in zip(*[column.to_pylist() for column in batch.columns]):
                if not open_ or conv_id != now:
                    if open_:
                        done.append((now, *carried.result()))
                    now, open_, carried = conv_id, True, _Conversation()
                if present:
                    carried.turn(turn, role, text, fault)
            if done:
                yield packed(done)
        if open_:
            yield packed([(now, *carried.result())])

    return rows.mapInArrow(run, f"conv_id {id_type}, {_RESULT}")


def repaired_turns(turns: DataFrame, present: Column | None = None) -> DataFrame:
    """``(conv_id, step, edit, turn, role, text)``: the repaired conversations
    as rows, in the order of ``step``; deleted turns are left out and inserted
    ones have no turn and an empty text. Nulls, ties and empty tables as for
    ``repair``. The scripts become one row a step and join their turns by
    place, so a long conversation is spread over the cluster again."""
    scripts = repair(turns, present).select("conv_id", "audit", "roles")
    id_type = scripts.schema["conv_id"].dataType.simpleString()

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for at in range(batch.num_rows):
                conv_id, audit, roles = batch.column(0)[at : at + 1], batch.column(1)[at].as_py(), batch.column(2)[at].as_py()
                place, kept, rows = 0, 0, []
                for step, edit in enumerate(audit):
                    if edit != "D":
                        rows.append((step, edit, None if edit == "I" else place, roles[kept]))
                        kept += 1
                    place += edit != "I"
                    if rows and (len(rows) == 10_000 or step + 1 == len(audit)):
                        columns = list(zip(*rows))
                        types = [pa.int64(), pa.string(), pa.int64(), pa.string()]
                        yield pa.RecordBatch.from_arrays(
                            [conv_id.take(pa.array([0] * len(rows))), *[pa.array(c, t) for c, t in zip(columns, types)]],
                            ["conv_id", "step", "edit", "place", "initial"],
                        )
                        rows = []

    steps = scripts.mapInArrow(run, f"conv_id {id_type}, step long, edit string, place long, initial string")
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "text")
    placed = _turns(turns, present).filter("present").withColumn("at", (F.row_number().over(order) - 1).cast("long"))
    placed = placed.select(F.col("conv_id").alias("c"), "at", "turn", F.col("role").alias("own"), "text")
    joined = steps.join(placed, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("place") == F.col("at")), "left")
    given = F.when(F.col("initial") == "u", "user").otherwise("assistant")
    return joined.select(
        "conv_id", "step", "edit", "turn", F.when(F.col("edit") == "K", F.col("own")).otherwise(given).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
