"""Repair of conversations by Wagner-Fischer alignment with the role grammar `(s?(ua)+)?`.

Turns are range-partitioned by (conversation, turn, role, text) and sorted, so a task meets
conversations whole, except the first and the last of its range. Those inside a range are
repaired where they are. Of the others, which may be as long as a third of all rows, each
range holds one piece:

1. a turn's first occurrence in its conversation is found by digests, pre-aggregated;
2. every piece gives the cost from each state of the grammar to each other one;
3. from these, piece by piece from the end, the cost of all that follows a piece;
4. every piece gives the state it leads to from each state, if cheapest in all;
5. with its first state known, every piece is repaired, and one task a conversation joins
   the parts, a megabyte at a time.

Steps 2 to 4 keep a few integers a piece, and there are at most two pieces a range.

**Alignment.** A conversation is cut into segments of SEGMENT turns. A segment is aligned
with the grammar's strings of each feasible length from its first state: one table of
edit distances holds all of them, as each is the beginning of the next longer one. Cells
whose cost, with the least for what is left, exceeds the incumbent's (the cheapest
alignment met so far) are not visited: Ukkonen's band, which is narrow as insertions cost 5 and
deletions 2. The lengths of least cost are traced back, smallest letter first, and their audits
compared.

Cost: keep 0, rerole to user or assistant 1, delete 2, insert an empty turn of user or
assistant 5, an undeleted truncated turn 5. Blank and duplicate turns must be deleted.
"""

from __future__ import annotations

import hashlib
import re
from functools import lru_cache
from itertools import groupby

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanstar.llm.rows import configure_batches, release
from gleanstar.session import stage

SEGMENT = 32
DELETE, INSERT, REROLE, TRUNCATED = 2, 5, 1, 5
_SPACE = " \t\n\x0b\x0c\r"
_INFINITE = 1 << 40
# States of the grammar: nothing yet, after s, after u, after a; the roles each may go on with.
_NEXT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
# The role a turn is given, or a new one has, in each state.
_GIVEN = ("u", "u", "a", "u")
_ROLE = {"u": "user", "a": "assistant"}
# What may stand after the whole conversation: nothing, where it may end.
_END = (0, _INFINITE, _INFINITE, 0)
_FLUSH = 1 << 20


def fault(text: str, duplicate: bool) -> str:
    """blank, duplicate, truncated or nothing."""
    tail = text.rstrip(_SPACE)
    if not tail:
        return "blank"
    if duplicate:
        return "duplicate"
    return "" if tail[-1] in ".!?" else "truncated"


def code(role: str, found: str) -> str:
    """One letter a turn: D must go, capitals are truncated, x is a role outside the grammar."""
    if found in ("blank", "duplicate"):
        return "D"
    letter = role[:1] if role[:1] in "sua" and role else "x"
    return letter.upper() if found else letter


def targets(state: int, length: int) -> list[str]:
    """The longest of the grammar's strings from a state; its beginnings are the others."""
    pair = "ua" * (length // 2 + 1)
    if state == 2:
        return [("a" + pair)[:length]]
    return [pair[:length]] + ([("s" + pair)[:length]] if state == 0 and length else [])


def _exit(state: int, target: str) -> int:
    return {"s": 1, "u": 2, "a": 3}[target[-1]] if target else state


def _edits(letter: str, wanted: str | None):
    """(audit letter, cost) of the edits that use a turn up: to the wanted role, or away."""
    out = [("D", DELETE)]
    if letter != "D" and wanted is not None:
        extra = TRUNCATED if letter.isupper() else 0
        if letter.lower() == wanted:
            out.append(("K", extra))
        elif wanted in _ROLE:
            out.append(("R", REROLE + extra))
    return out


def _least_rest(codes: str) -> list[int]:
    """The least cost of the turns from each place on, whatever the target."""
    rest = [0] * (len(codes) + 1)
    for i in range(len(codes) - 1, -1, -1):
        rest[i] = rest[i + 1] + (DELETE if codes[i] == "D" or codes[i].isupper() else 0)
    return rest


def distances(codes: str, target: str, limit: int) -> list[int]:
    """The edit distance between the turns and each beginning of the target, up to a limit
    (_INFINITE beyond): a row of the table a turn, cells beyond the limit left out."""
    least = _least_rest(codes)
    width = len(target) + 1
    row = [INSERT * j if INSERT * j + least[0] <= limit else _INFINITE for j in range(width)]
    for i, letter in enumerate(codes):
        below = [_INFINITE] * width
        bound = limit - least[i + 1]
        low = next((j for j in range(width) if row[j] < _INFINITE), width)
        for j in range(low, width):
            best = row[j] + DELETE
            if j:
                if letter != "D":
                    same = letter.lower() == target[j - 1]
                    if same or target[j - 1] != "s":
                        best = min(best, row[j - 1] + (not same) * REROLE + letter.isupper() * TRUNCATED)
                best = min(best, below[j - 1] + INSERT)
            if best <= bound:
                below[j] = best
        row = below
    return row


def trace(codes: str, target: str, cost: int) -> str:
    """The smallest audit, as text, of the given least cost between the turns and the target."""
    n, m = len(codes), len(target)
    after: list[dict[int, int]] = [{} for _ in range(n + 1)]
    # costs from the end, within the band the cost allows
    for i in range(n, -1, -1):
        low, high = max(0, m - (n - i) - cost // INSERT), min(m, m - (n - i) + cost // DELETE)
        for j in range(high, low - 1, -1):
            best = 0 if i == n and j == m else _INFINITE
            if j < m:
                best = min(best, after[i].get(j + 1, _INFINITE) + INSERT)
            if i < n:
                for edit, price in _edits(codes[i], target[j] if j < m else None):
                    best = min(best, after[i + 1].get(j if edit == "D" else j + 1, _INFINITE) + price)
            if best <= cost:
                after[i][j] = best
    audit, i, j = [], 0, 0
    while (i, j) != (n, m):
        here, steps = after[i][j], []
        if j < m and after[i].get(j + 1, _INFINITE) + INSERT == here:
            steps.append(("I", i, j + 1))
        if i < n:
            for edit, price in _edits(codes[i], target[j] if j < m else None):
                to = j if edit == "D" else j + 1
                if after[i + 1].get(to, _INFINITE) + price == here:
                    steps.append((edit, i + 1, to))
        edit, i, j = min(steps)
        audit.append(edit)
    return "".join(audit)


def _feasible(codes: str, state: int, after: tuple[int, ...], limit: int) -> list[tuple[int, str]]:
    """(cost with what follows, target) of each length within the limit."""
    out = []
    longest = sum(c != "D" for c in codes) + max(0, limit) // INSERT + 1
    for k, target in enumerate(targets(state, longest)):
        for j, cost in enumerate(distances(codes, target, limit)):
            whole = cost + after[_exit(state, target[:j])]
            if whole <= limit and (j or not k):
                out.append((whole, target[:j]))
    return out


@lru_cache(maxsize=1 << 16)
def transitions(codes: str) -> tuple[tuple[int, ...], ...]:
    """The least cost of a segment from each state to each state."""
    everything = DELETE * len(codes)
    out = []
    for state in range(4):
        costs = [_INFINITE] * 4
        # deleting all turns and inserting at most three leads to every state that can be reached
        for whole, target in _feasible(codes, state, (0, 0, 0, 0), everything + 3 * INSERT):
            to = _exit(state, target)
            costs[to] = min(costs[to], whole)
        out.append(tuple(costs))
    return tuple(out)


@lru_cache(maxsize=1 << 17)
def aligned(codes: str, state: int, after: tuple[int, ...]) -> tuple[int, str, int]:
    """(cost of the segment, audit, last state) of the cheapest alignment of a segment that
    starts in a state, where going on from each state costs `after`; of equally cheap
    ones that with the smallest audit."""
    # the incumbent: delete all turns, and insert until a state from which it can go on
    incumbent, at, spent = _INFINITE, state, DELETE * len(codes)
    for inserted in range(4):
        incumbent = min(incumbent, spent + INSERT * inserted + after[at])
        at = _NEXT[at][_GIVEN[at]]
    least = min(a for a in after)
    # bands start narrow and widen until the incumbent lies within
    limit = least + sum(_least_rest(codes)[:1]) + 2 * INSERT
    while True:
        limit = min(limit, incumbent)
        found = _feasible(codes, state, after, limit)
        if found or limit == incumbent:
            break
        limit += limit - least + INSERT
    cheapest = min(whole for whole, _ in found)
    audits = [(trace(codes, t, cheapest - after[_exit(state, t)]), t) for whole, t in found if whole == cheapest]
    audit, target = min(audits)
    to = _exit(state, target)
    return cheapest - after[to], audit, to


def _segments(codes: str) -> list[str]:
    return [codes[i : i + SEGMENT] for i in range(0, len(codes), SEGMENT)]


def before(step: tuple[tuple[int, ...], ...], after: tuple[int, ...]) -> tuple[int, ...]:
    """The cost of going on from each state, through a segment or piece and what follows."""
    return tuple(min(_INFINITE, *(c + a for c, a in zip(row, after, strict=True))) for row in step)


def chained(first, second):
    """Transitions through one part and the next."""
    columns = list(zip(*second, strict=True))
    return tuple(tuple(min(_INFINITE, *(a + b for a, b in zip(row, col, strict=True))) for col in columns) for row in first)


def passed(codes: str):
    """Transitions through a whole piece."""
    out = tuple(tuple(0 if i == j else _INFINITE for j in range(4)) for i in range(4))
    for part in _segments(codes):
        out = chained(out, transitions(part))
    return out


def _relative(after: tuple[int, ...]) -> tuple[int, ...]:
    least = min(after)
    return tuple(min(_INFINITE, a - least) if a < _INFINITE else _INFINITE for a in after)


def follow(codes: str, afters: list[tuple[int, ...]], state: int) -> tuple[int, list[str], int]:
    """(cost, audits by segment, last state) of a piece from a state, with the costs of going
    on after each of its segments."""
    cost, audits = 0, []
    for part, after in zip(_segments(codes), afters, strict=True):
        spent, audit, state = aligned(part, state, after)
        cost += spent
        audits.append(audit)
    return cost, audits, state


def afters(codes: str, after: tuple[int, ...]) -> list[tuple[int, ...]]:
    """The costs of going on after each segment of a piece, given those after its end."""
    out = []
    for part in reversed(_segments(codes)):
        out.append(_relative(after))
        after = before(transitions(part), after)
    return out[::-1]


def repaired(audit, turns, state: int):
    """The lines of a repaired piece: `audit` over turns (role, text), from a state."""
    turns = iter(turns)
    for edit in audit:
        if edit == "D":
            next(turns)
            continue
        if edit == "K":
            role, text = next(turns)
            state = _NEXT[state][role[:1]]
        else:
            given = _GIVEN[state]
            state, role = _NEXT[state][given], _ROLE[given]
            text = next(turns)[1] if edit == "R" else ""
        yield f"{role}:{text}"


class Summary:
    """Counts over the turns of a conversation or of a piece, in order."""

    FIELDS = ("blank", "duplicate", "truncated", "illegal", "turns", "low", "high", "first", "last")

    def __init__(self):
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.low = self.high = self.first = self.last = None

    def add(self, turn, role: str, faults: list[tuple[str, int]]) -> None:
        n = 0
        for found, times in faults:
            n += times
            if found:
                setattr(self, found, getattr(self, found) + times)
        if not n:
            return
        initial = role[:1]
        if turn is not None and turn != self.high:
            self.turns += 1
            self.low = turn if self.low is None else self.low
            self.high = turn
        if self.last is not None:
            self.illegal += self.last + initial not in ("su", "ua", "au")
        self.illegal += (n - 1) * (initial + initial not in ("su", "ua", "au"))
        self.first = initial if self.first is None else self.first
        self.last = initial

    def append(self, other: Summary) -> None:
        """The counts of the next piece."""
        if other.last is None:
            return
        self.blank, self.duplicate, self.truncated = self.blank + other.blank, self.duplicate + other.duplicate, self.truncated + other.truncated
        self.illegal += other.illegal + (self.last is not None and self.last + other.first not in ("su", "ua", "au"))
        self.turns += other.turns - (other.low is not None and other.low == self.high)
        self.low = other.low if self.low is None else self.low
        self.high = self.high if other.high is None else other.high
        self.first, self.last = other.first if self.last is None else self.first, other.last

    @property
    def gaps(self) -> int:
        return 0 if self.low is None else self.high - self.low + 1 - self.turns

    def values(self) -> list:
        return [getattr(self, f) for f in self.FIELDS]

    @classmethod
    def of(cls, values) -> Summary:
        out = cls()
        for f, v in zip(cls.FIELDS, values, strict=True):
            setattr(out, f, v)
        return out


_SUMMARY_DDL = "blank long, duplicate long, truncated long, illegal long, turns long, low long, high long, first string, last string"
_RESULT_DDL = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def _batch(ddl_schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * len(ddl_schema)
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, ddl_schema, strict=True)], schema=ddl_schema)


def _digest(role: str, text: str) -> bytes:
    return xxhash.xxh3_128_digest(f"{len(role)}:{role}{text}".encode())


def _whole(turns: list[tuple]) -> tuple:
    """The result of a conversation that is here as a whole: turns (turn, role, text, times)."""
    summary, seen, codes, kept = Summary(), set(), [], []
    for turn, role, text, times in turns:
        if not times:
            continue
        key = _digest(role, text)
        first = fault(text, key in seen)
        again = fault(text, True)
        seen.add(key)
        summary.add(turn, role, [(first, 1), (again, times - 1)])
        codes.append(code(role, first) + "D" * (times - 1))
        kept += [(role, text)] * times
    codes = "".join(codes)
    cost, audits, _ = follow(codes, afters(codes, _END), 0)
    audit = "".join(audits)
    sha = hashlib.sha256("\n".join(repaired(audit, kept, 0)).encode()).hexdigest()
    s = summary
    return (s.gaps, s.blank, s.duplicate, s.truncated, s.illegal, cost if codes else 0, audit, sha)


def _merge_equal(batches):
    """Equal rows of a batch as one with their number."""
    for batch in batches:
        table = pa.Table.from_batches([batch])
        out = table.group_by(["conv", "turn", "role", "text"]).aggregate([("times", "sum")])
        out = out.select(["conv", "turn", "role", "text", "times_sum"]).rename_columns(batch.schema.names)
        yield from out.combine_chunks().to_batches()


def _listed(column: pa.Array) -> list:
    return column.to_numpy(zero_copy_only=False).tolist() if column.type == pa.string() else column.to_pylist()


def _streamed(schema: pa.Schema):
    """Results of the conversations inside a range, and the turns of those at its borders."""

    def run(batches):
        from pyspark import TaskContext

        part, none = TaskContext.get().partitionId(), (None,) * 8
        current, inner, turns, number, out, held = None, False, [], 0, [], 0

        def border():
            nonlocal number
            for turn, role, text, times in turns:
                yield (current[0], part, number, turn, role, text, times, *none)
                number += 1

        for batch in batches:
            for conv, turn, role, text, times in zip(*map(_listed, batch.columns), strict=True):
                if current is None or conv != current[0]:
                    if current is not None:
                        out += [(current[0], part, None, None, None, None, None, *_whole(turns))] if inner else list(border())
                        inner = True
                    current, turns, number = (conv,), [], 0
                if turns and turns[-1][:3] == (turn, role, text):
                    turns[-1] = (turn, role, text, turns[-1][3] + times)
                else:
                    turns.append((turn, role, text, times))
                if not inner and len(turns) > 1000:
                    # the last one stays: it may meet its equals
                    last = turns.pop()
                    out += border()
                    turns = [last]
                held += len(text or "")
                if held > _FLUSH * 4 and out:
                    yield _batch(schema, out)
                    out, held = [], 0
        if current is not None:
            out += border()
        if out:
            yield _batch(schema, out)
        release()

    return run


def _groups(batches, width: int):
    """(key, rows) of consecutive rows with equal first columns; rows are read as they are asked for."""

    def rows():
        for batch in batches:
            yield from zip(*map(_listed, batch.columns), strict=True)

    for key, group in groupby(rows(), key=lambda r: r[:width]):
        yield key, group


def repair_conversations(
    conversations: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    times_col: str | None = None,
) -> DataFrame:
    """One row per conversation: id, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256 (of the repaired `role:text` lines).

    Turns are ordered by turn, NULL first, those of one turn by role and text. A turn's first
    fault counts: blank (white space only), duplicate (role and text seen earlier in the
    conversation), truncated (the last character that is no white space is none of .!?). NULL role
    and text count as one blank. gaps: numbers missing between the smallest and the largest
    turn. illegal: neighbours whose roles' initials are not su, ua or au. NULL is a conversation
    of its own. Equal rows are duplicates of one another. `times_col` tells how often a row
    stands; a conversation whose rows all stand 0 times has zeros, an empty audit and the hash
    of the empty text. An empty table gives no rows. Other columns are not read. Runs when it
    is called.
    """
    configure_batches(conversations)
    spark = conversations.sparkSession
    times = F.lit(1) if times_col is None else F.col(times_col)
    here = times.cast("long") > 0

    def present(name: str) -> Column:
        return F.when(here, F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(" ")))

    rows = conversations.select(
        F.col(f"`{conv_col}`").alias("conv"), F.when(here, F.col(f"`{turn_col}`").cast("long")).alias("turn"),
        present(role_col).alias("role"), present(text_col).alias("text"), times.cast("long").alias("times"),
    )
    conv = rows.schema["conv"].dataType.simpleString()
    merged = rows.mapInArrow(_merge_equal, f"conv {conv}, turn long, role string, text string, times long")
    # the order of whole texts, told by their beginnings and else by a hash
    keys = [F.col("conv"), F.col("turn"), F.col("role"), F.substring("text", 1, 64), F.xxhash64("text")]
    ranged = merged.repartitionByRange(*keys).sortWithinPartitions(*keys, "text")
    ddl = f"conv {conv}, part long, number long, turn long, role string, text string, times long, {_RESULT_DDL}"
    schema = _arrow(spark, ddl)
    found = stage(ranged.mapInArrow(_streamed(schema), ddl), "conversations")
    whole = found.filter("number is null")
    names = [n for n in schema.names[7:]]
    joined = _across_ranges(found.filter("number is not null"), conv)
    return whole.select("conv", *names).unionByName(joined).withColumnRenamed("conv", conv_col)


def _arrow(spark, ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(spark.createDataFrame([], ddl).schema)


def _across_ranges(border: DataFrame, conv: str) -> DataFrame:
    """Results of the conversations at the borders of ranges, piece by piece."""
    spark = border.sparkSession
    key = F.struct("part", "number")
    marked = border.filter("times > 0").withColumn("digest", F.md5(F.concat_ws(":", F.length("role").cast("string"), "role", "text")))
    firsts = marked.groupBy("conv", "digest").agg(F.min(key).alias("first")).withColumnsRenamed({"conv": "c", "digest": "d"})
    same = F.col("conv").eqNullSafe(F.col("c")) & (F.col("digest") == F.col("d"))
    seen = marked.select("conv", "part", "number", "digest").join(firsts, same).select("conv", "part", "number", (key != F.col("first")).alias("seen"))
    # a piece's turns without texts; conversations without a turn have a row all the same
    light = border.select(
        "conv", "part", "number", "turn", "role", "times", (F.length(F.regexp_replace("text", r"[\x20\x09-\x0D]+", "")) == 0).alias("blank"),
        F.substring(F.regexp_replace("text", r"[\x20\x09-\x0D]+\z", ""), -1, 1).alias("end"),
    )
    seen = seen.withColumnsRenamed({"conv": "c", "part": "p", "number": "k"})
    same = F.col("conv").eqNullSafe(F.col("c")) & (F.col("part") == F.col("p")) & (F.col("number") == F.col("k"))
    light = light.join(seen, same, "left").select(*light.columns, F.coalesce("seen", F.lit(False)).alias("seen"))
    light = light.repartition("conv", "part").sortWithinPartitions("conv", "part", "number")
    ddl = f"conv {conv}, part long, codes string, step array<long>, {_SUMMARY_DDL}"
    schema = _arrow(spark, ddl)

    def pieces(batches):
        for (conv, part), turns in _groups(batches, 2):
            summary, codes = Summary(), []
            for _, _, _, turn, role, times, blank, end, seen in turns:
                if times:
                    again = "blank" if blank else "duplicate"
                    first = again if blank or seen else ("" if end in (".", "!", "?") else "truncated")
                    summary.add(turn, role, [(first, 1), (again, times - 1)])
                    codes.append(code(role, first) + "D" * (times - 1))
            codes = "".join(codes)
            yield _batch(schema, [(conv, part, codes, [c for row in passed(codes) for c in row], *summary.values())])

    table = stage(light.mapInArrow(pieces, ddl), "conversation_pieces")
    # at most two rows a range, of a few numbers each
    known: dict = {}
    for r in sorted(table.select("conv", "part", "step").collect(), key=lambda r: r.part):
        known.setdefault(r.conv, []).append((r.part, tuple(tuple(r.step[4 * q : 4 * q + 4]) for q in range(4))))
    after = {}
    for c, steps in known.items():
        ahead = _END
        for part, step in reversed(steps):
            after[c, part] = ahead
            ahead = before(step, ahead)

    def leads(batches):
        for batch in batches:
            out = []
            for c, part, codes in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                costs = afters(codes, after[c, part])
                # a state from which the conversation cannot end leads nowhere
                out.append((c, part, [follow(codes, costs, q)[2] for q in range(4)]))
            yield _batch(lead_schema, out)

    lead_ddl = f"conv {conv}, part long, leads array<int>"
    lead_schema = _arrow(spark, lead_ddl)
    led = {(r.conv, r.part): r.leads for r in table.select("conv", "part", "codes").mapInArrow(leads, lead_ddl).collect()}
    entry = {}
    for c, steps in known.items():
        state = 0
        for part, _ in steps:
            entry[c, part] = state
            state = led[c, part][state]
    # the turns of a piece follow its row with the codes
    turns = border.select("conv", "part", "number", "role", "text", "times", F.lit(None).cast("string").alias("codes"), *_nulls())
    heads = table.select(
        "conv", "part", F.lit(-1).cast("long").alias("number"), F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"),
        F.lit(None).cast("long").alias("times"), "codes", *Summary.FIELDS,
    )
    both = heads.unionByName(turns).repartition("conv", "part").sortWithinPartitions("conv", "part", "number")
    part_ddl = f"conv {conv}, part long, number long, cost long, audit string, lines long, text binary, {_SUMMARY_DDL}"
    part_schema = _arrow(spark, part_ddl)

    def parts(batches):
        for (c, part), rows in _groups(batches, 2):
            head = next(rows)
            codes = head[6]
            cost, audits, _ = follow(codes, afters(codes, after[c, part]), entry[c, part])
            audit = "".join(audits)
            kept = ((r[3], r[4]) for r in rows for _ in range(r[5]))
            lines, size, number = [], 0, 0
            yield _batch(part_schema, [(c, part, -1, cost, audit, 0, b"", *head[7:])])
            empty = (None,) * len(Summary.FIELDS)
            for line in repaired(audit, kept, entry[c, part]):
                lines.append(line)
                size += len(line)
                if size > _FLUSH:
                    yield _batch(part_schema, [(c, part, number, None, None, len(lines), "\n".join(lines).encode(), *empty)])
                    lines, size, number = [], 0, number + 1
            for _ in kept:
                pass
            if lines:
                yield _batch(part_schema, [(c, part, number, None, None, len(lines), "\n".join(lines).encode(), *empty)])

    ordered = both.mapInArrow(parts, part_ddl).repartition("conv").sortWithinPartitions("conv", "part", "number")
    end_ddl = f"conv {conv}, {_RESULT_DDL}"
    end_schema = _arrow(spark, end_ddl)

    def joined(batches):
        for (c,), rows in _groups(batches, 1):
            summary, cost, audit, sha, lines = Summary(), 0, [], hashlib.sha256(), 0
            for _, _, number, spent, edits, n, text, *values in rows:
                if number < 0:
                    summary.append(Summary.of(values))
                    cost += spent
                    audit.append(edits)
                else:
                    sha.update(b"\n" * (lines > 0) + text)
                    lines += n
            s = summary
            yield _batch(end_schema, [(c, s.gaps, s.blank, s.duplicate, s.truncated, s.illegal, cost, "".join(audit), sha.hexdigest())])

    return ordered.mapInArrow(joined, end_ddl)


def _nulls() -> list[Column]:
    kinds = dict(re.findall(r"(\w+) (\w+)", _SUMMARY_DDL))
    return [F.lit(None).cast(kinds[f]).alias(f) for f in Summary.FIELDS]


def damage(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Rows with planted faults, by crc32("conv:turn") % 20, and the column `times`: 0 drops a
    row, 1 empties its text, 2 takes .!? from it, 3 repeats it, 4 makes the role user. NULLs
    count as one blank."""

    def text(name: str) -> Column:
        return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(text(conv_col), F.lit(":"), text(turn_col)).cast("binary")) % 20
    return conversations.select(
        F.col(f"`{conv_col}`"), F.col(f"`{turn_col}`"),
        F.when(kind == 4, F.lit("user")).otherwise(text(role_col)).alias(role_col),
        F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace(text(text_col), "[.!?]", "")).otherwise(text(text_col)).alias(text_col),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("times"),
    )
