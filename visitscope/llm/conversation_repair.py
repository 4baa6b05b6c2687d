"""Repair of conversation structure by a secondary-sorted stream.

A well-formed conversation has the role initials `(s?(ua)+)?`: an optional
system turn, then user and assistant in turn. Rows are repartitioned by
conversation, sorted by turn, and streamed through `mapInPandas`. The stream
carries, from one Arrow batch to the next, the state of a dynamic programme
over four automaton states (nothing yet, after s, after u, after a): the least
cost of reaching each, how their edit strings compare, a running hash of the
text each would leave, and one byte of back-pointer for each row and state.
Nothing else of a conversation is kept, so a conversation of any length needs
the same memory. Back-pointers beyond `CHUNK` rows are spilled: the chunk is
resolved for each of its four possible last states into a first state and an
edit string, and written out as a row. The end picks the chain of chunks.

Edits: Keep costs 0 (the initial must fit), Rerole to user or assistant 2,
Delete 3 (the only edit of a blank or repeated row), Insert an empty user or
assistant turn 2; a truncated row that stays costs 1 more. Among cheapest
repairs the one with the ASCII-least string of edit initials counts.

Defined results. A null role or text reads as one space. Turns are sorted with
nulls first; rows of one turn by role, then text, a repeated row beside its
copy. A null conversation id is a conversation of its own. A conversation of
which no row is left has zeros, an empty edit string and the hash of the
empty text. An empty table gives an empty table. Other columns are ignored.

A conversation is one stream in one task, as the method asks and the hash of
its repaired text needs (SHA-256 cannot be joined from parts); its memory does
not grow, its time does.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import small_batches, staged

CHUNK = 1 << 20  # rows of a conversation whose back-pointers are held
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
BLANK = r"[^\x20\x09-\x0D]"

START, AFTER_S, AFTER_U, AFTER_A = range(4)
# State after a turn the state may be followed by when turns are made up, and that turn's role.
MADE = {START: (AFTER_U, "user"), AFTER_S: (AFTER_U, "user"), AFTER_U: (AFTER_A, "assistant"), AFTER_A: (AFTER_U, "user")}
FITS = {(START, "s"): AFTER_S, (START, "u"): AFTER_U, (AFTER_S, "u"): AFTER_U, (AFTER_U, "a"): AFTER_A, (AFTER_A, "u"): AFTER_U}
LEGAL = {("s", "u"), ("u", "a"), ("a", "u")}
FAR = 1 << 60
TOKENS = [k * "I" + e for e in "DKR" for k in range(3)]

ROWS = T.StructType([T.StructField(n, t) for n, t in (
    ("conv_id", T.StringType()), ("part", T.LongType()), ("first_states", T.ArrayType(T.IntegerType())),
    ("edits", T.ArrayType(T.StringType())), ("state", T.IntegerType()), ("gaps", T.LongType()), ("blank", T.LongType()),
    ("duplicate", T.LongType()), ("truncated", T.LongType()), ("illegal", T.LongType()), ("cost", T.LongType()),
    ("repaired_sha256", T.StringType()))])


def damage(conversations: DataFrame) -> DataFrame:
    """The rows with the faults that crc32(`conv_id:turn`) % 20 plants.

    (conv_id, turn, role, text, copy, dropped): nulls of role and text read as
    one space; a dropped row stays as a row that only names its conversation.
    """
    def shown(name: str):
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), shown("role").alias("role"),
        shown("text").alias("text"), (F.crc32(F.concat_ws(":", shown("conv_id"), shown("turn"))) % 20).alias("fault"))
    rows = rows.withColumns({
        "text": F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")),
        "role": F.when(F.col("fault") == 4, "user").otherwise(F.col("role"))})
    copies = F.explode(F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.select("conv_id", "turn", "role", "text", copies.alias("copy"), (F.col("fault") == 0).alias("dropped"))


def as_rows(conversations: DataFrame) -> DataFrame:
    """The rows as they are, in the form that `damage` returns."""
    def shown(name: str):
        return F.coalesce(F.col(name).cast("string"), F.lit(" ")).alias(name)

    return conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                shown("role"), shown("text"), F.lit(0).alias("copy"), F.lit(False).alias("dropped"))


def in_order(rows: DataFrame) -> DataFrame:
    """Rows repartitioned by conversation and sorted by turn, with their first fault.

    One shuffle: the window that finds repeated texts groups within a
    conversation, so the partitioning by conversation serves it too. Both
    sorts spill.
    """
    same = Window.partitionBy("conv_id", "dropped", "role", F.sha2("text", 256)).orderBy(F.col("turn").asc_nulls_first(), "copy")
    fault = (F.when(~F.col("text").rlike(BLANK), "blank").when(F.col("nth") > 1, "duplicate")
             .when(~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z"), "truncated").otherwise("none"))
    return (rows.repartition("conv_id").withColumn("nth", F.row_number().over(same)).withColumn("fault", fault)
            .sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text", "nth"))


def _moves(initial: str, fault: str) -> list[tuple[int, str, int, int]]:
    """(state before, edits, state after, cost) of every way to pass a row."""
    late = TRUNCATED if fault == "truncated" else 0
    found = []
    for begin in range(4):
        at = begin
        for k in range(3):  # a third made-up turn would only repeat a state
            paid, edits = INSERT * k, "I" * k
            found.append((begin, edits + "D", at, paid + DELETE))
            if fault not in ("blank", "duplicate"):
                if (at, initial) in FITS:
                    found.append((begin, edits + "K", FITS[at, initial], paid + KEEP + late))
                found.append((begin, edits + "R", MADE[at][0], paid + REROLE + late))
            at = MADE[at][0]
    return found


MOVES = {(i, f): _moves(i, f) for i in "sua-" for f in ("blank", "duplicate", "truncated", "none")}


class Stream:
    """State of the conversation that is being read."""

    def __init__(self, conv_id: str | None) -> None:
        self.conv_id = conv_id
        self.counts = dict.fromkeys(("blank", "duplicate", "truncated", "none"), 0)
        self.illegal = self.turns = self.part = 0
        self.low = self.high = self.last = None
        self.costs = [0, FAR, FAR, FAR]
        # Edit strings end with a row's edit and hold one such edit a row, so that no
        # string begins another one and their order never depends on what follows.
        self.order = [0, 1, 2, 3]
        self.hashes = [hashlib.sha256() for _ in range(4)]
        self.begun = [False] * 4
        self.back = bytearray()

    def row(self, turn: int | None, role: str, text: str, fault: str) -> None:
        initial = role[:1]
        if self.last is not None and (self.last, initial) not in LEGAL:
            self.illegal += 1
        self.last = initial
        self.counts[fault] += 1
        if turn is not None and turn != self.high:
            self.low = turn if self.low is None else self.low
            self.high = turn
            self.turns += 1
        best: list[tuple | None] = [None] * 4
        for begin, edits, end, cost in MOVES[initial if initial in ("s", "u", "a") else "-", fault]:
            if self.costs[begin] < FAR:
                offer = (self.costs[begin] + cost, self.order[begin], edits, begin)
                if best[end] is None or offer < best[end]:
                    best[end] = offer
        hashes, begun = [], []
        for state in range(4):
            if best[state] is None:
                hashes.append(None)
                begun.append(False)
                self.back.append(0)
                continue
            _, _, edits, begin = best[state]
            digest, some, at = self.hashes[begin].copy(), self.begun[begin], begin
            for edit in edits:
                if edit == "D":
                    continue
                turn_role = role if edit == "K" else MADE[at][1]
                digest.update((("\n" if some else "") + turn_role + ":").encode("utf-8"))
                if edit != "I":
                    digest.update(text.encode("utf-8"))
                some = True
                at = MADE[at][0] if edit != "K" else at
            hashes.append(digest)
            begun.append(some)
            self.back.append(begin + 4 * TOKENS.index(edits))
        ranks = sorted((b[1:3], s) for s, b in enumerate(best) if b is not None)
        self.order = [0] * 4
        for rank, (_, state) in enumerate(ranks):
            self.order[state] = rank
        self.costs = [FAR if b is None else b[0] for b in best]
        self.hashes, self.begun = hashes, begun

    def spill(self) -> dict:
        """The held back-pointers as one chunk: for each last state its first state and edits."""
        first, edits = [], []
        for state in range(4):
            at, found = state, []
            for row in range(len(self.back) - 4, -1, -4):
                code = self.back[row + at]
                found.append(TOKENS[code >> 2])
                at = code & 3
            first.append(at)
            edits.append("".join(reversed(found)))
        chunk = {"conv_id": self.conv_id, "part": self.part, "first_states": first, "edits": edits}
        self.part += 1
        self.back = bytearray()
        return chunk

    def end(self) -> dict:
        """The last chunk with the counts, the least cost and the state it is reached in."""
        ends = []
        for state, made in ((START, 0), (AFTER_A, 0), (AFTER_U, 1), (AFTER_S, 2)):
            if self.costs[state] < FAR:
                ends.append((self.costs[state] + INSERT * made, self.order[state], made, state))
        cost, _, made, state = min(ends)
        digest, some, at = self.hashes[state].copy(), self.begun[state], state
        for _ in range(made):
            digest.update((("\n" if some else "") + MADE[at][1] + ":").encode("utf-8"))
            some, at = True, MADE[at][0]
        chunk = self.spill()
        chunk["edits"] = [e + "I" * made for e in chunk["edits"]]
        gaps = self.high - self.low + 1 - self.turns if self.turns else 0
        return chunk | {"state": state, "gaps": gaps, "blank": self.counts["blank"], "duplicate": self.counts["duplicate"],
                        "truncated": self.counts["truncated"], "illegal": self.illegal, "cost": cost,
                        "repaired_sha256": digest.hexdigest()}


def _stream(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    held, out = None, []
    for frame in frames:
        fields = [frame[c].tolist() for c in ("conv_id", "turn", "role", "text", "fault", "dropped")]
        for conv_id, rows in groupby(zip(*fields, strict=True), key=lambda r: r[0]):
            if held is None or held.conv_id != conv_id:
                if held is not None:
                    out.append(held.end())
                held = Stream(conv_id)
            for _, turn, role, text, fault, dropped in rows:
                if not dropped:
                    held.row(None if turn is None else int(turn), role, text, fault)
                    if len(held.back) >= 4 * CHUNK:
                        out.append(held.spill())
                        if len(out[-1]["edits"][0]) > 1000:
                            yield _frame(out)
                            out = []
        if len(out) >= 500:
            yield _frame(out)
            out = []
    if held is not None:
        out.append(held.end())
    if out:
        yield _frame(out)


def _frame(rows: list[dict]) -> pd.DataFrame:
    return pd.DataFrame({f.name: pd.Series([r.get(f.name) for r in rows], dtype=object) for f in ROWS.fields})


def _chain(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
    """Last state of each chunk of a conversation, from its last chunk to its first."""
    frame = frame.sort_values("part", ascending=False)
    state, states = None, []
    for last, first in zip(frame["state"], frame["first_states"], strict=True):
        state = int(last) if state is None else state
        states.append(state)
        state = int(first[state])
    return pd.DataFrame({"conv_id": frame["conv_id"].tolist(), "part": frame["part"].tolist(), "chosen": states})


def repair(rows: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of every conversation.

    `rows` as `damage` or `as_rows` returns them.
    """
    small_batches(rows.sparkSession)
    sent = in_order(rows).select(F.col("conv_id").cast("string").alias("conv_id"), F.col("turn").cast("string").alias("turn"),
                                 "role", "text", "fault", "dropped")
    chunks = staged(sent.mapInPandas(_stream, ROWS), "repair")
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    whole = (chunks.where("state is not null and part = 0")
             .select("conv_id", *counts, F.col("edits")[F.col("state")].alias("audit"), "repaired_sha256"))
    # Conversations of several chunks: a chunk takes a few bytes of the chain, its edits join by its state.
    ends = chunks.where("state is not null and part > 0")
    long_ones = chunks.join(ends.select(F.col("conv_id").alias("long_id")), F.col("conv_id").eqNullSafe(F.col("long_id")), "left_semi")
    chain = (long_ones.select("conv_id", "part", "state", "first_states").groupBy("conv_id")
             .applyInPandas(_chain, "conv_id string, part long, chosen int")
             .withColumnsRenamed({"conv_id": "chain_id", "part": "chain_part"}))
    at_part = F.col("conv_id").eqNullSafe(F.col("chain_id")) & (F.col("part") == F.col("chain_part"))
    joined = (long_ones.join(chain, at_part).groupBy("conv_id").agg(
        *(F.max(c).alias(c) for c in counts),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", F.col("edits")[F.col("chosen")].alias("e")))),
                                 lambda p: p["e"]), "").alias("audit"),
        F.max("repaired_sha256").alias("repaired_sha256")))
    return whole.unionByName(joined).withColumn("conv_id", F.col("conv_id").cast("long"))
