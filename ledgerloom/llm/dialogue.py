"""Repair of conversation structure at least cost, by Four-Russians block tables.

A conversation is a sequence of rows (role, text) by turn. A row's first fault counts: blank,
duplicate (role and text seen earlier in it), truncated (its last visible character ends no sentence). Edits
make the roles' initials match ``(s?(ua)+)?``: keep a row (0), give it the role user or assistant
(2), delete it (3; required for blank and duplicate ones), insert an empty user or assistant row
(2); an undeleted truncated row adds 1. Of the cheapest edits the audit, one letter each in
order (K, R, D, I), is the ASCII-least.

The cheapest way on from each of the four states of that pattern is a cost vector; less its least
entry it is one of few (``Tables.vectors``), since states reach each other at bounded cost. Rows are nine
symbols, and for every vector and every block of ``BLOCK`` symbols a table holds the vector in front of
the block, the cost between and the state in which each state leaves the block. A conversation is
passed from its end to its beginning by lookups, and then each block is expanded backward into
the vectors between its rows; from these the least letter that is still cheapest is taken row by row
from the front, so ties are settled exactly.

A conversation of any length: rows are sorted by range, so a long conversation lies in several
partitions. Each part of it is summed up for all vectors at once (a part is a function of the vector
behind it, and such functions follow each other); the parts' sums, one row each, are then walked once per
conversation, and every part is traced from its own state. Only what the result itself asks for goes by
conversation through one task: its audit, and its rows as a stream for the digest, in bounded
batches.

Nulls in role or text are one space (so a row without text is blank); null turns come first and
do not count for gaps; a null conversation id is a conversation. Rows of one turn are ordered by role, then
text (its first characters, then its digest). Repeated rows are duplicates. An empty table gives no
rows; very long texts are only ever held one at a time; other columns do not matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.shared import saved

KEEP, REROLE, DELETE, INSERT = 0, 2, 3, 2
BLOCK = 4
#: Classes of role initials; a code is class + 4 if truncated + 8 if the row has to go.
CLASSES = "sua"
OTHER, TRUNCATED, MUST_GO = 3, 4, 8
SYMBOLS = 9
START, SYSTEM, USER, ASSISTANT = range(4)
#: State after a kept row of each class, where the pattern allows it.
KEPT = {START: {0: SYSTEM, 1: USER}, SYSTEM: {1: USER}, USER: {2: ASSISTANT}, ASSISTANT: {1: USER}}
#: State after the only inserted or rewritten row that the pattern allows.
NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
ROLES = {USER: "user", ASSISTANT: "assistant"}
LEGAL = {(0, 1), (1, 2), (2, 1)}
BLANKS = r"\x20\x09-\x0D"


def _inserted(base: list[int]) -> list[int]:
    """The cheapest way on when rows may be inserted first; two in a row lead back, so three are never needed."""
    out = base
    for _ in range(3):
        out = [min(base[q], INSERT + out[NEXT[q]]) for q in range(4)]
    return out


def _options(symbol: int, q: int, behind: tuple[int, ...]) -> list[tuple[str, int, int]]:
    """(letter, cost on, next state) of what can be done with a row at state q."""
    out = [("D", DELETE + behind[q], q)]
    if symbol < SYMBOLS - 1:
        kind, extra = symbol % 4, int(symbol >= TRUNCATED)
        if kind in KEPT[q]:
            out.append(("K", KEEP + extra + behind[KEPT[q][kind]], KEPT[q][kind]))
        out.append(("R", REROLE + extra + behind[NEXT[q]], NEXT[q]))
    return out


class Tables:
    """Cost vectors and transitions of single symbols and of blocks."""

    def __init__(self, block: int = BLOCK):
        self.block = block
        # ways on when no row is left: inserts up to an accepted state
        end = tuple(_inserted([0, 1 << 20, 1 << 20, 0]))
        self.vectors = [end]
        known = {end: 0}
        step, cost, moves = [], [], []
        for vector in self.vectors:  # grows while it is walked
            row = []
            for symbol in range(SYMBOLS):
                options = [_options(symbol, q, vector) for q in range(4)]
                front = _inserted([min(c for _, c, _ in o) for o in options])
                least = min(front)
                normal = tuple(x - least for x in front)
                if normal not in known:
                    known[normal] = len(self.vectors)
                    self.vectors.append(normal)
                row.append((known[normal], least, [self._move(options, front, q) for q in range(4)]))
            step.append([x[0] for x in row])
            cost.append([x[1] for x in row])
            moves.append([x[2] for x in row])
        self.moves = moves  # [vector behind][symbol][state] -> (letters, next state)
        self.step, self.cost = np.array(step, np.int64), np.array(cost, np.int64)
        self.turn = np.array([[[q for _, q in m] for m in row] for row in moves], np.int8)
        self.end_letters = ["", "II", "I", ""]
        self.blocks = [self._empty()]
        for _ in range(block):
            self.blocks.append(self._longer(self.blocks[-1]))
        ids, costs, _ = self.blocks[block]
        self.block_step, self.block_cost = ids.tolist(), costs.tolist()

    @staticmethod
    def _move(options, front, q) -> tuple[str, int]:
        """Letters up to and with that of the row, the least of the cheapest ones each time, and the state then."""
        letters = ""
        while True:
            cheapest = [(letter, to) for letter, c, to in options[q] if c == front[q]]
            if INSERT + front[NEXT[q]] == front[q]:
                cheapest.append(("I", NEXT[q]))
            letter, q = min(cheapest)
            letters += letter
            if letter != "I":
                return letters, q

    def _empty(self):
        n = len(self.vectors)
        return np.arange(n)[:, None], np.zeros((n, 1), np.int64), np.tile(np.arange(4, dtype=np.int8), (n, 1, 1))

    def _longer(self, table):
        """Blocks with one symbol more in front: first digit of their number to the base ``SYMBOLS``."""
        ids, costs, states = table
        n, size = ids.shape
        symbol = np.arange(SYMBOLS)[None, :, None]
        behind = ids[:, None, :]
        step, cost = self.step[behind, symbol], self.cost[behind, symbol] + costs[:, None, :]
        turned = self.turn[behind, symbol]  # [vector, symbol, block, state]
        through = np.take_along_axis(np.broadcast_to(states[:, None], turned.shape), turned, axis=3)
        return step.reshape(n, -1), cost.reshape(n, -1), through.reshape(n, SYMBOLS * size, 4)

    def numbers(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbols in front that fill no block, and the numbers of the blocks."""
        odd = len(symbols) % self.block
        digits = symbols[odd:].reshape(-1, self.block).astype(np.int64)
        return symbols[:odd], digits @ (SYMBOLS ** np.arange(self.block - 1, -1, -1))

    def borders(self, symbols: np.ndarray, behind: int = 0) -> tuple[list[int], int, int]:
        """Vectors behind each block (last first), the one in front of all blocks, and the cost of blocks."""
        _, blocks = self.numbers(symbols)
        ids, total = [], 0
        for b in reversed(blocks.tolist()):
            ids.append(behind)
            total += self.block_cost[behind][b]
            behind = self.block_step[behind][b]
        return ids, behind, total

    def cost_of(self, symbols: np.ndarray) -> int:
        """Cost of the cheapest repair of a whole conversation, by lookups alone."""
        odd, _ = self.numbers(symbols)
        _, behind, total = self.borders(symbols)
        for s in reversed(odd.tolist()):
            total += int(self.cost[behind, s])
            behind = int(self.step[behind, s])
        return total + self.vectors[behind][START]

    def summary(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each vector behind a part: the vector in front of it, and the state to which each state is led."""
        odd, blocks = self.numbers(symbols)
        front, _, states = (x[:, 0] for x in self._empty())
        rows = np.arange(len(front))[:, None]
        for table, numbers in ((self.blocks[self.block], blocks), (self.blocks[1], odd)):
            for b in reversed(numbers.tolist()):
                states = states[rows, table[2][front, b]]
                front = table[0][front, b]
        return front, states

    def trace(self, symbols: np.ndarray, behind: int = 0, state: int = START) -> tuple[str, int]:
        """Letters of the cheapest edits from a state, given the vector behind, and the state in the end."""
        odd, _ = self.numbers(symbols)
        ids, front, _ = self.borders(symbols, behind)
        out = []
        edges = [0, *range(len(odd), len(symbols) + 1, self.block)] if len(odd) else list(range(0, len(symbols) + 1, self.block))
        for k, vector in enumerate([*([front] if len(odd) else []), *reversed(ids)]):
            inside = symbols[edges[k] : edges[k + 1]].tolist()
            vectors = [vector]
            for s in inside[:0:-1]:  # the block is expanded backward
                vectors.append(int(self.step[vectors[-1], s]))
            for s, v in zip(inside, reversed(vectors), strict=True):
                letters, state = self.moves[v][s][state]
                out.append(letters)
        return "".join(out), state


@lru_cache(maxsize=1)
def tables() -> Tables:
    return Tables()


def symbols_of(codes: np.ndarray) -> np.ndarray:
    return np.where(codes >= MUST_GO, SYMBOLS - 1, codes).astype(np.int64)


def _illegal(classes: list[int]) -> int:
    return sum(pair not in LEGAL for pair in zip(classes, classes[1:]))


def order_of(text) -> list:
    """Ordering of rows of a conversation; bounded keys that stand for the text."""
    return [F.col("turn").asc_nulls_first(), "role", F.substring(text, 1, 32), F.unhex(F.sha2(text, 256))]


def rows_of(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) with one space for a null role or text."""
    blank = F.lit(" ")
    return conversations.select(
        "conv_id", "turn", F.coalesce(F.col("role").cast("string"), blank).alias("role"),
        F.coalesce(F.col("text").cast("string"), blank).alias("text"),
    )


def _parts(rows: DataFrame, parts: int | None) -> tuple[DataFrame, DataFrame]:
    """The sorted rows without their texts, each with its place; and (conv_id, seg, codes): the rows
    of each conversation within one range partition, one byte each."""
    visible = F.col("text").rlike(f"[^{BLANKS}]")
    ended = F.col("text").rlike(rf"[.!?][{BLANKS}]*\z")
    initial = F.substring("role", 1, 1)
    kind = F.lit(OTHER)
    for i, letter in enumerate(CLASSES):
        kind = F.when(initial == letter, i).otherwise(kind)
    light = rows.select(
        "conv_id", "turn", "role", F.substring("text", 1, 32).alias("head"), F.unhex(F.sha2("text", 256)).alias("digest"),
        kind.alias("kind"), (~visible).alias("blank"), (~ended).alias("open"),
        # splits equal rows among partitions
        F.xxhash64(F.monotonically_increasing_id()).alias("at"),
    )
    order = ["conv_id", F.col("turn").asc_nulls_first(), "role", "head", "digest", "at"]
    if parts:
        light = light.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    else:
        light = light.orderBy(*order)
    placed = saved(light.drop("head", "at").withColumn("pos", F.monotonically_increasing_id()))
    first = placed.groupBy("conv_id", "role", "digest").agg(F.min("pos").alias("pos")).select("pos", F.lit(True).alias("first"))
    marked = placed.drop("digest", "role").join(first, "pos", "left").withColumn("again", F.col("first").isNull() & ~F.col("blank"))
    must = F.col("blank") | F.col("again")
    marked = marked.select(
        "conv_id", "turn", "pos", F.shiftright("pos", 33).alias("seg"),
        (F.col("kind") + F.when(F.col("open") & ~must, TRUNCATED).otherwise(0) + F.when(must, MUST_GO).otherwise(0)).cast("byte").alias("code"),
        "blank", "again", (F.col("open") & ~must).alias("cut"),
    )
    # a range partition's rows of one conversation: bounded by the partition
    grouped = marked.groupBy("conv_id", "seg").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("pos", "code"))), lambda x: x.code).alias("codes"),
        *(F.sum(F.col(c).cast("long")).alias(n) for c, n in (("blank", "blank"), ("again", "duplicate"), ("cut", "truncated"))),
    )
    return placed, grouped


def _codes(batch: pa.RecordBatch, name: str) -> list[np.ndarray]:
    column = batch.column(batch.schema.get_field_index(name))
    flat, off = column.flatten().to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    off = off - off[0]
    return [flat[i:j].astype(np.int64) for i, j in zip(off[:-1], off[1:], strict=True)]


def _summed(parts: DataFrame) -> DataFrame:
    """Each part of a split conversation as a function of the vector behind it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            front, states, ends = [], [], []
            for codes in _codes(batch, "codes"):
                f, s = tables().summary(symbols_of(codes))
                front.append(f.tolist())
                states.append(s.ravel().tolist())
                ends.append([int(codes[0]) % 4, int(codes[-1]) % 4])
            yield pa.RecordBatch.from_arrays(
                [pa.array(front, pa.list_(pa.int32())), pa.array(states, pa.list_(pa.int32())), pa.array(ends, pa.list_(pa.int32())),
                 batch.column(1), batch.column(0)],
                names=["front", "states", "ends", "seg", "conv"],
            )

    kind = parts.schema["conv_id"].dataType.simpleString()
    return parts.select("conv_id", "seg", "codes").mapInArrow(
        run, f"front array<int>, states array<int>, ends array<int>, seg long, conv {kind}"
    )


def _walked(summed: DataFrame) -> DataFrame:
    """The vector behind, the state in front and the illegal seams of each part: one small row a part and conversation."""

    def walk(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("seg")
        behind, vectors = 0, []
        for front in reversed(group["front"].tolist()):
            vectors.append(behind)
            behind = int(front[behind])
        vectors.reverse()
        state, in_front = START, []
        for table, vector in zip(group["states"].tolist(), vectors, strict=True):
            in_front.append(state)
            state = int(table[4 * vector + state])
        ends = group["ends"].tolist()
        seams = [0] + [int((int(a[1]), int(b[0])) not in LEGAL) for a, b in zip(ends, ends[1:])]
        last = [False] * (len(group) - 1) + [True]
        out = group[["conv", "seg"]].copy()
        return out.assign(behind=vectors, state=in_front, seams=seams, last=last)

    kind = summed.schema["conv"].dataType.simpleString()
    return summed.groupBy("conv").applyInPandas(walk, f"conv {kind}, seg long, behind long, state long, seams long, last boolean")


def _traced(parts: DataFrame) -> DataFrame:
    """(conv_id, seg, audit, cost, illegal) of parts with the vector behind and the state in front."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tables()
        for batch in batches:
            behind, state, seams, last = (batch.column(i).to_pylist() for i in range(3, 7))
            audits, costs, illegal = [], [], []
            for k, codes in enumerate(_codes(batch, "codes")):
                symbols = symbols_of(codes)
                letters, end = t.trace(symbols, behind[k], state[k])
                letters += t.end_letters[end] if last[k] else ""
                kept = np.frombuffer(letters.replace("I", "").encode(), np.uint8) != ord("D")
                extra = int(((symbols >= TRUNCATED) & (symbols < MUST_GO) & kept).sum())
                costs.append(DELETE * letters.count("D") + REROLE * letters.count("R") + INSERT * letters.count("I") + extra)
                audits.append(letters)
                illegal.append(_illegal((codes % 4).tolist()) + seams[k])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(audits, pa.string()), pa.array(costs, pa.int64()), pa.array(illegal, pa.int64())],
                names=["conv_id", "seg", "audit", "cost", "illegal"],
            )

    kind = parts.schema["conv_id"].dataType.simpleString()
    return parts.select("conv_id", "seg", "codes", "behind", "state", "seams", "last").mapInArrow(
        run, f"conv_id {kind}, seg long, audit string, cost long, illegal long"
    )


def audits(rows: DataFrame, parts: int | None = None) -> DataFrame:
    """``rows(conv_id, turn, role, text)`` without nulls in role and text -> one row for each conversation: (conv_id, gaps,
    blank, duplicate, truncated, illegal, cost, audit). ``parts``: number of range partitions."""
    placed, grouped = _parts(rows, parts)
    grouped = saved(grouped.withColumn("n", F.count("*").over(Window.partitionBy("conv_id"))))
    whole = grouped.filter("n = 1").select(
        "conv_id", "seg", "codes", F.lit(0).cast("long").alias("behind"), F.lit(START).cast("long").alias("state"),
        F.lit(0).cast("long").alias("seams"), F.lit(True).alias("last"),
    )
    split = grouped.filter("n > 1").select("conv_id", "seg", "codes")
    met = F.col("conv").eqNullSafe(F.col("conv_id")) & (F.col("walked") == F.col("seg"))
    walked = _walked(_summed(split)).withColumnRenamed("seg", "walked")
    traced = _traced(whole.unionByName(split.join(walked, met).drop("conv", "walked")))
    letters = traced.groupBy("conv_id").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("seg", "audit"))), lambda x: x.audit), "").alias("audit"),
        F.sum("cost").alias("cost"), F.sum("illegal").alias("illegal"),
    )
    faults = grouped.groupBy("conv_id").agg(*(F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")))
    turn = placed.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("long").alias("gaps")
    )
    for other in (faults, turn):
        other = other.withColumnRenamed("conv_id", "conv")
        letters = letters.join(other, F.col("conv_id").eqNullSafe(F.col("conv"))).drop("conv")
    return letters.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")


class _Replay:
    """Edits applied to the rows of a conversation as they come by."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state = audit, 0, START

    def inserted(self) -> Iterator[tuple[str, str]]:
        while self.audit[self.at : self.at + 1] == "I":
            self.at, self.state = self.at + 1, NEXT[self.state]
            yield ROLES[self.state], ""

    def row(self, role: str, text: str) -> Iterator[tuple[str, str]]:
        yield from self.inserted()
        letter = self.audit[self.at]
        self.at += 1
        if letter == "R":
            self.state = NEXT[self.state]
            yield ROLES[self.state], text
        elif letter == "K":
            self.state = KEPT[self.state][CLASSES.index(role[:1])]
            yield role, text


def _stream(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Rows of each conversation in order behind its audit, in one pass: (conv_id, kind, audit, role, text)."""
    one = found.select(
        "conv_id", F.lit(0).alias("kind"), "audit", F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"),
        F.lit(None).cast(rows.schema["turn"].dataType).alias("turn"),
    )
    each = rows.select("conv_id", F.lit(1).alias("kind"), F.lit(None).cast("string").alias("audit"), "role", "text", "turn")
    both = one.unionByName(each).repartition("conv_id").sortWithinPartitions("conv_id", "kind", *order_of(F.col("text")))
    return both.select("conv_id", "kind", "audit", "role", "text")


def repaired(rows: DataFrame, found: DataFrame) -> DataFrame:
    """The rows of the repaired conversations: (conv_id, place, role, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        replay, conv, place = None, None, 0
        for batch in batches:
            out: list[tuple] = []

            def put(items):
                nonlocal place
                for role, text in items:
                    out.append((conv, place, role, text))
                    place += 1

            for conv_id, kind, audit, role, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if kind == 0:
                    if replay is not None:
                        put(replay.inserted())
                    replay, conv, place = _Replay(audit), conv_id, 0
                else:
                    put(replay.row(role, text))
            if out:
                columns = list(zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[0], batch.column(0).type), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.string()),
                     pa.array(columns[3], pa.string())], names=["conv_id", "place", "role", "text"],
                )
        if replay is not None and (rest := list(replay.inserted())):
            yield pa.RecordBatch.from_arrays(
                [pa.array([conv] * len(rest), batch.column(0).type), pa.array(range(place, place + len(rest)), pa.int64()),
                 pa.array([r for r, _ in rest], pa.string()), pa.array([t for _, t in rest], pa.string())],
                names=["conv_id", "place", "role", "text"],
            )

    kind = rows.schema["conv_id"].dataType.simpleString()
    return _stream(rows, found).mapInArrow(run, f"conv_id {kind}, place long, role string, text string")


def repaired_digests(rows: DataFrame, found: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256): the repaired ``role:text`` joined by line ends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        replay, conv, sha, any_row = None, None, None, False

        def put(items):
            nonlocal any_row
            for role, text in items:
                sha.update(("\n" if any_row else "").encode() + f"{role}:{text}".encode())
                any_row = True

        for batch in batches:
            ids, digests = [], []
            for conv_id, kind, audit, role, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if kind == 0:
                    if replay is not None:
                        put(replay.inserted())
                        ids.append(conv)
                        digests.append(sha.hexdigest())
                    replay, conv, sha, any_row = _Replay(audit), conv_id, hashlib.sha256(), False
                else:
                    put(replay.row(role, text))
            yield pa.RecordBatch.from_arrays([pa.array(ids, batch.column(0).type), pa.array(digests, pa.string())], names=["conv", "repaired_sha256"])
        if replay is not None:
            put(replay.inserted())
            yield pa.RecordBatch.from_arrays(
                [pa.array([conv], batch.column(0).type), pa.array([sha.hexdigest()])], names=["conv", "repaired_sha256"]
            )

    kind = rows.schema["conv_id"].dataType.simpleString()
    return _stream(rows, found).mapInArrow(run, f"conv {kind}, repaired_sha256 string")


def damage(conversations: DataFrame) -> DataFrame:
    """A known damage of a fourth of the rows, by crc32 of conversation and turn modulo 20: 0 drops a row, 1 empties its
    text, 2 takes its sentence ends, 3 repeats it, 4 makes it a user's."""
    written = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    hit = F.crc32(F.concat(written[0], F.lit(":"), written[1])) % 20
    rows = rows_of(conversations).withColumn("hit", hit).filter("hit <> 0")
    copies = F.explode(F.when(F.col("hit") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.select(
        "conv_id", "turn", F.when(F.col("hit") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("hit") == 1, "").when(F.col("hit") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        copies.alias("copy"),
    ).drop("copy")


def repair_report(conversations: DataFrame, rows: DataFrame, parts: int | None = None) -> DataFrame:
    """One row for each id in ``conversations``: its audit over ``rows`` (none: empty), and the digest of the repair."""
    found = saved(audits(rows, parts))
    digests = repaired_digests(rows, found)
    ids = conversations.select(F.col("conv_id").alias("id")).distinct()
    out = ids.join(found, F.col("id").eqNullSafe(F.col("conv_id")), "left").drop("conv_id")
    out = out.join(digests, F.col("id").eqNullSafe(F.col("conv")), "left")
    return out.select(
        F.col("id").alias("conv_id"),
        *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"),
    )
