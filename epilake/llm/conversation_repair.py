"""Conversation structure repair: the cheapest edits to ``(s?(ua)+)?``.

Rows are repartitioned by conversation (the only shuffle that carries text)
and sorted within partitions; ``mapInPandas`` then streams each conversation
from its last row to its first. A dynamic program over the four states of
the pattern (nothing yet, after a system, user, assistant turn) carries the
cheapest cost from each state to the end of the conversation across Arrow
batches. For each row it keeps one byte, the best edit from each of the
four states; that and the texts spill to an unnamed file of the worker above
``SPOOL`` bytes, so memory doesn't grow with a conversation. When its first
row is reached the edits are read off forwards, and among equally cheap
sequences the one with the least initials in ASCII order is taken.

Edits: Keep costs 0, Rerole to user or assistant 1, Delete 2 (required for
blank and duplicate rows), Insert an empty user or assistant turn anywhere
5; an undeleted truncated row adds 5. A row's first fault counts: blank (no
character but white space), duplicate (role and text seen earlier in the
conversation), truncated (the last such character is none of ``.!?``).

Null role and text count as one space. Rows go by turn, nulls first; of rows
with one turn, by role and text. Rows with a null conversation id are one
conversation; an empty role has no initial and fits nowhere. A conversation
with all its rows dropped has zeros, no edits and the hash of the empty
string. Repeated rows are duplicates; empty and very long texts need no
special case; an empty table gives no rows. Extra columns aren't read, and
helper columns live in a selection of their own, so no name clashes.
``gaps`` beyond a long is the largest long.

A conversation is read by one task, as its state passes from row to row;
that task sorts and spills like any other, and holds one Arrow batch.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ship

SPACES = " \t\n\x0b\x0c\r"
ENDS = ".!?"
SPOOL = 4_000_000

FINE, BLANK, DUPLICATE, TRUNCATED = range(4)
# edits in the ASCII order of their initials
DELETE, INSERT, KEEP, REROLE = range(4)
INITIALS = b"DIKR"
COST = {DELETE: 2, INSERT: 5, KEEP: 0, REROLE: 1}
TRUNCATED_COST = 5

# states: 0 nothing yet, 1 after s, 2 after u, 3 after a; ends in 0 or 3
WANTED = ("u", "u", "a", "u")                   # the role that can be inserted or given
AFTER = (2, 2, 3, 2)                            # the state after it
FOLLOWS = {"s": (1, None, None, None), "u": (2, 2, None, 2), "a": (None, None, 3, None)}
ROLES = {"u": b"user", "a": b"assistant"}
NEVER = float("inf")

SCHEMA = ("conv string, gaps long, blank long, duplicate long, truncated long, illegal long, "
          "cost long, audit string, repaired_sha256 string")


def _with_inserts(cost: list[float], best: list[int]) -> tuple[tuple[float, ...], int]:
    """Costs from each state, and the best edits in one byte, once inserted
    turns are weighed too. Two rounds do: a third insertion comes back to a state."""
    cost, best = list(cost), list(best)
    for _ in range(2):
        for s in range(4):
            c = cost[AFTER[s]] + COST[INSERT]
            if c < cost[s] or (c == cost[s] and INSERT < best[s]):
                cost[s], best[s] = c, INSERT
    return tuple(cost), best[0] | best[1] << 2 | best[2] << 4 | best[3] << 6


@lru_cache(maxsize=4096)
def _step(ahead: tuple[float, ...], initial: str, fault: int) -> tuple[tuple[float, ...], int, int]:
    """One row in front of what lies ahead: costs from each state above the
    least, best edits, and the least. There are few distinct steps, since
    the costs lie within a few edits of each other."""
    cost, best = [], []
    late = TRUNCATED_COST if fault == TRUNCATED else 0
    for s in range(4):
        options = [(ahead[s] + COST[DELETE], DELETE)]
        if fault not in (BLANK, DUPLICATE):
            to = FOLLOWS.get(initial, (None,) * 4)[s]
            if to is not None:
                options.append((ahead[to] + late, KEEP))
            options.append((ahead[AFTER[s]] + late + COST[REROLE], REROLE))
        c, e = min(options)
        cost.append(c)
        best.append(e)
    cost, byte = _with_inserts(cost, best)
    least = min(cost)
    return tuple(c - least for c in cost), byte, least


_END = _with_inserts([0, NEVER, NEVER, 0], [KEEP] * 4)


class _Backwards:
    """Bytes kept record by record and read back last record first."""

    def __init__(self):
        self.file = tempfile.SpooledTemporaryFile(max_size=SPOOL)

    def add(self, record: bytes) -> None:
        self.file.write(record)
        self.file.write(len(record).to_bytes(8, "little"))

    def records(self) -> Iterator[bytes]:
        at = self.file.tell()
        while at:
            self.file.seek(at - 8)
            n = int.from_bytes(self.file.read(8), "little")
            at -= 8 + n
            self.file.seek(at)
            yield self.file.read(n)


class _Conversation:
    """Rows from the last to the first; ``row()`` is the result."""

    def __init__(self, conv: str):
        self.conv = conv
        self.ahead, self.end = _END
        self.cost = 0
        self.kept = _Backwards()
        self.faults = [0, 0, 0, 0]
        self.illegal = self.turns = 0
        self.high = self.low = self.next = None

    def add(self, turn: int | None, role: bytes, initial: str, text: bytes, fault: int) -> None:
        if turn is not None:
            if self.high is None:
                self.high = turn
            self.turns += turn != self.low
            self.low = turn
        self.faults[fault] += 1
        if self.next is not None:
            self.illegal += initial + self.next not in ("su", "ua", "au")
        self.next = initial
        self.ahead, best, least = _step(self.ahead, initial, fault)
        self.cost += least
        self.kept.add(bytes((best,)) + initial.encode()[:4].ljust(4, b"\0") + len(role).to_bytes(4, "little") + role + text)

    def row(self) -> tuple:
        state, audit = 0, bytearray()
        sha, first = hashlib.sha256(), True

        def say(role: bytes, text: bytes) -> None:
            nonlocal first
            sha.update((b"" if first else b"\n") + role + b":" + text)
            first = False

        def inserted(state: int, best: int) -> int:
            while best >> 2 * state & 3 == INSERT:
                audit.append(INITIALS[INSERT])
                say(ROLES[WANTED[state]], b"")
                state = AFTER[state]
            return state

        cost = self.cost + self.ahead[0]
        for record in self.kept.records():
            best = record[0]
            state = inserted(state, best)
            edit = best >> 2 * state & 3
            audit.append(INITIALS[edit])
            if edit == DELETE:
                continue
            n = int.from_bytes(record[5:9], "little")
            role, text = record[9:9 + n], record[9 + n:]
            if edit == KEEP:
                say(role, text)
                state = FOLLOWS[record[1:5].rstrip(b"\0").decode()][state]
            else:
                say(ROLES[WANTED[state]], text)
                state = AFTER[state]
        inserted(state, self.end)
        self.kept.file.close()
        gaps = 0 if self.high is None else min(self.high - self.low + 1 - self.turns, 2**63 - 1)
        return (self.conv, gaps, *self.faults[1:], self.illegal, int(cost), audit.decode(), sha.hexdigest())


def _stream(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Results of the conversations that lie one after the other in ``parts``."""
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    now: _Conversation | None = None
    for part in parts:
        done = []
        for conv, gone, no_turn, turn, role, initial, text, fault in zip(*(part[c].tolist() for c in part.columns)):
            if now is None or now.conv != conv:
                if now is not None:
                    done.append(now.row())
                now = _Conversation(conv)
            if not gone:
                now.add(None if no_turn else turn, bytes(role), initial, bytes(text), fault)
        if done:
            yield pd.DataFrame(done, columns=names)
    if now is not None:
        yield pd.DataFrame([now.row()], columns=names)


def conversation_key(conv_id: Column) -> Column:
    """Text that names the conversation; empty for a null id."""
    return F.coalesce(F.concat(F.lit("="), conv_id.cast("string")), F.lit(""))


def damaged(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
            text_col: str = "text") -> DataFrame:
    """Rows (conv, turn, role, text, gone) after faults are put in, by crc32
    of ``conv_id:turn`` modulo 20: 0 drops a row (``gone``), 1 empties its
    text, 2 takes its ``.!?`` away, 3 repeats it, 4 makes its role user.
    Nulls count as one space."""
    def said(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(said(conv_col), F.lit(":"), said(turn_col)).cast("binary")) % 20
    rows = df.select(conversation_key(F.col(conv_col)).alias("conv"), F.col(turn_col).cast("long").alias("turn"),
                     said(role_col).alias("role"), said(text_col).alias("text"), kind.alias("kind"))
    rows = rows.withColumn("copies", F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1)))
                                               .otherwise(F.array(F.lit(0)))))
    return rows.select(
        "conv", "turn",
        F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ENDS, ""))
        .otherwise(F.col("text")).alias("text"),
        (F.col("kind") == 0).alias("gone"))


def plain_rows(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
               text_col: str = "text") -> DataFrame:
    """Rows (conv, turn, role, text, gone) as they are, for ``repair``."""
    def said(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    return df.select(conversation_key(F.col(conv_col)).alias("conv"), F.col(turn_col).cast("long").alias("turn"),
                     said(role_col).alias("role"), said(text_col).alias("text"), F.lit(False).alias("gone"))


def repair(rows: DataFrame, id_type: str = "long", conv_col: str = "conv_id") -> DataFrame:
    """A row per conversation of ``rows`` (conv, turn, role, text, gone):
    counts of faults, ``cost`` and ``audit`` of the cheapest edits, and the
    hash of the repaired ``role:text`` lines. A row that is ``gone`` only
    names its conversation."""
    ship(rows.sparkSession)
    body = F.rtrim(F.col("text"), F.lit(SPACES))
    # ranked within the conversation's partition: no further shuffle. Equal
    # texts of a conversation are told by their digest
    seen = F.row_number().over(Window.partitionBy("conv", "gone", "role", "look")
                               .orderBy(F.col("turn").asc_nulls_first()))
    ranked = (rows.repartition("conv")
              .withColumn("look", F.unhex(F.sha2(F.col("text"), 256)))
              .withColumn("seen", seen))
    fault = (F.when(body == "", BLANK).when(F.col("seen") > 1, DUPLICATE)
             .when(~F.right(body, F.lit(1)).isin(*ENDS), TRUNCATED).otherwise(FINE))
    ordered = ranked.sortWithinPartitions(
        "conv", F.col("turn").desc_nulls_last(), F.col("role").desc(), F.col("text").desc(), F.col("seen").desc())
    sent = ordered.select(
        "conv", "gone", F.col("turn").isNull().alias("no_turn"), F.coalesce("turn", F.lit(0)).alias("turn"),
        F.col("role").cast("binary").alias("role"), F.left("role", F.lit(1)).alias("initial"),
        F.col("text").cast("binary").alias("text"), fault.alias("fault"))
    found = sent.mapInPandas(_stream, SCHEMA)
    # NULL for the empty key, which only a null id has
    conv_id = F.expr("substr(nullif(conv, ''), 2)").cast(id_type).alias(conv_col)
    return found.select(conv_id, *[c for c in found.columns if c != "conv"])
