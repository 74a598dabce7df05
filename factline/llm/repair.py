"""Conversation structure repair: the cheapest edits that give a conversation the role order (s?(ua)+)?, by a run-length DP.

A row becomes a symbol of its role's initial and its fault. Rows pass through four states (nothing yet, after s, after u, after a);
a symbol is a 4 x 4 matrix of least costs from state to state, rows in a row are their min-plus product, and a run
of equal symbols is read off the cached powers M, M^2, M^4, ... of its matrix. Going back over the runs gives the cost to go at
every boundary; going forward, each run is unrolled into its edits by halving: the edits of 2^k equal rows, from a state and
towards given costs, are those of 2^(k-1) rows twice, and are cached, too.

Products can be grouped at will, so a conversation of any length is cut into segments: the rows are range-partitioned by
conversation and place, each task turns its stretch of rows into segments of bounded size, one record a segment goes through
the conversation's chain of matrices, and the segments are unrolled apart from each other.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACES, cut, shuffle_partitions, with_row_id

FAR = 1 << 60  # no way
#: States: nothing yet, after system, after user, after assistant.
START, AFTER_S, AFTER_U, AFTER_A = range(4)
_STEP = {START: {"s": AFTER_S, "u": AFTER_U}, AFTER_S: {"u": AFTER_U}, AFTER_U: {"a": AFTER_A}, AFTER_A: {"u": AFTER_U}}
#: The role that fits in a state and may be written there by an edit.
FITTING = ("user", "user", "assistant", "user")
_NEXT = (AFTER_U, AFTER_U, AFTER_A, AFTER_U)
#: Costs of the edits.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: Faults, as parts of a symbol.
SOUND, GONE, SHORT = range(3)
_INITIALS = "sua?"
#: Cost to go after the last row: what must still be inserted.
END = (0, 2 * INSERT, INSERT, 0)

Matrix = tuple  # 4 tuples of 4 costs


def symbol(initial: str, fault: int) -> int:
    return 3 * (_INITIALS.find(initial) if initial in ("s", "u", "a") else 3) + fault


def edits(sym: int, state: int) -> list[tuple[str, int, int]]:
    """(edit, cost, next state) of what may become of one row, in the edits' ASCII order."""
    initial, fault = _INITIALS[sym // 3], sym % 3
    out = [("D", DELETE, state)]
    if fault != GONE:
        more = TRUNCATED if fault == SHORT else 0
        if initial in _STEP[state]:
            out.append(("K", more, _STEP[state][initial]))
        out.append(("R", REROLE + more, _NEXT[state]))
    return out


def product(a: Matrix, b: Matrix) -> Matrix:
    return tuple(tuple(min(FAR, *(row[k] + b[k][j] for k in range(4))) for j in range(4)) for row in a)


def towards(m: Matrix, costs: tuple) -> tuple:
    """Costs to go before the rows of ``m``, from those after them."""
    return tuple(min(row[k] + costs[k] for k in range(4)) for row in m)


def _inserted() -> Matrix:
    """Least costs of insertions alone; two are the most that can lead anywhere new."""
    out = []
    for s in range(4):
        row, at = [FAR] * 4, s
        for n in range(3):
            row[at] = min(row[at], n * INSERT)
            at = _NEXT[at]
        out.append(tuple(row))
    return tuple(out)


@lru_cache(maxsize=None)
def power(sym: int, k: int) -> Matrix:
    """Matrix of 2^k rows of one symbol, each with the insertions before it; 12 symbols, k at most 20 or so."""
    if k:
        half = power(sym, k - 1)
        return product(half, half)
    row = [[FAR] * 4 for _ in range(4)]
    for s in range(4):
        for _, cost, t in edits(sym, s):
            row[s][t] = min(row[s][t], cost)
    return product(_inserted(), tuple(map(tuple, row)))


IDENTITY = tuple(tuple(0 if i == j else FAR for j in range(4)) for i in range(4))


def run_matrix(sym: int, n: int) -> Matrix:
    out, k = IDENTITY, 0
    while n >> k:
        if n >> k & 1:
            out = product(out, power(sym, k))
        k += 1
    return out


@lru_cache(maxsize=1 << 14)
def _unroll(sym: int, k: int, state: int, costs: tuple) -> tuple[str, int]:
    """(edits, state after them) of 2^k rows of one symbol: the cheapest towards ``costs``, the ASCII-least of these."""
    if k:
        half = power(sym, k - 1)
        first, mid = _unroll(sym, k - 1, state, _level(towards(half, costs)))
        second, end = _unroll(sym, k - 1, mid, costs)
        return first + second, end
    out, want = "", towards(power(sym, 0), costs)
    while True:
        ways = edits(sym, state)
        ways.insert(1, ("I", INSERT, None))  # D < I < K < R
        for edit, cost, t in ways:
            if edit == "I" and cost + want[_NEXT[state]] == want[state]:
                out, state = out + "I", _NEXT[state]
                break
            if edit != "I" and cost + costs[t] == want[state]:
                return out + edit, t


def _level(costs: tuple) -> tuple:
    """The costs less the least of them: choices depend on no more, and few such vectors occur."""
    low = min(costs)
    return tuple(c - low for c in costs)


def collapse(symbols: np.ndarray) -> list[tuple[int, int]]:
    """Runs (symbol, length) of equal symbols."""
    at = np.flatnonzero(np.diff(symbols, prepend=-1))
    return list(zip(symbols[at].tolist(), np.diff(at, append=len(symbols)).tolist()))


def segment_matrix(runs: list[tuple[int, int]]) -> Matrix:
    out = IDENTITY
    for sym, n in runs:
        out = product(out, run_matrix(sym, n))
    return out


def unroll(runs: list[tuple[int, int]], state: int, costs: tuple) -> tuple[str, int]:
    """(edits, state after them) of a segment from ``state`` towards the costs to go after it."""
    after = [costs]
    for sym, n in reversed(runs[1:]):
        after.append(_level(towards(run_matrix(sym, n), after[-1])))
    out = []
    for (sym, n), end in zip(runs, reversed(after)):
        powers = [k for k in range(n.bit_length()) if n >> k & 1]
        ends = [_level(end)]
        for k in powers[:0:-1]:
            ends.append(_level(towards(power(sym, k), ends[-1])))
        for k, costs_then in zip(powers, reversed(ends)):
            part, state = _unroll(sym, k, state, costs_then)
            out.append(part)
    return "".join(out), state


def tail(state: int) -> str:
    """Insertions after the last row."""
    return {AFTER_S: "II", AFTER_U: "I"}.get(state, "")


# ---------------------------------------------------------------- rows

def damage(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, turn, role, text, _row, _copy): the rows after a damage that their crc32 picks; nulls stand as one blank."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = with_row_id(conversations.select(
        F.col(id_col).alias("conv_id"), F.col(turn_col).cast("long").alias("turn"), text(role_col).alias("role"), text(text_col).alias("text"),
        F.pmod(F.crc32(F.concat(text(id_col), F.lit(":"), text(turn_col)).cast("binary")), F.lit(20)).alias("kind")))
    copies = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.filter("kind != 0").select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        "_row", F.explode(copies).alias("_copy"))


def conversation_key(c) -> F.Column:
    """A string that is never null: grouping by it sets null ids apart from all others."""
    return F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit(""))


#: A row's place: its conversation, turn (nulls first), role and content; of equal rows, in the table's order.
PLACE = ["conv", "turn", "role", "digest", "_row", "_copy"]


def _marked(rows: DataFrame) -> DataFrame:
    """The rows without their texts: place, initial, and what is wrong with each one by itself."""
    digest = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256)
    words = F.translate("text", SPACES, "")
    ends = F.length(F.rtrim(F.translate("text", SPACES[1:], " " * (len(SPACES) - 1))))
    last = F.substring(F.rtrim(F.translate("text", SPACES[1:], " " * (len(SPACES) - 1))), -1, 1)
    return rows.select(conversation_key(F.col("conv_id")).alias("conv"), "turn", "role", F.substring(digest, 1, 32).alias("digest"), "_row", "_copy",
                       (F.length(words) == 0).alias("blank"), ((ends > 0) & ~last.isin(".", "!", "?")).alias("short"))


def _faults(marked: DataFrame) -> DataFrame:
    """Adds ``fault``: 0 none, 1 blank, 2 duplicate, 3 truncated.

    First rows are aggregated before the shuffle and written, so that the join splits a content that many rows of one conversation share.
    """
    place = F.struct(F.col("turn").isNotNull().alias("known"), "turn", "_row", "_copy")
    firsts = marked.groupBy("conv", "digest").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    firsts = cut(firsts.select("conv", "digest", F.col("first._row").alias("_first"), F.col("first._copy").alias("_first_copy")), "repair-firsts")
    again = F.col("_first").isNotNull() & ((F.col("_row") != F.col("_first")) | (F.col("_copy") != F.col("_first_copy")))
    return marked.join(firsts, ["conv", "digest"], "left").select(
        *PLACE, F.when(F.col("blank"), 1).when(again, 2).when(F.col("short"), 3).otherwise(0).alias("fault"))


_SEGMENT = ("conv string, seg long, n long, symbols binary, matrix array<long>, blank long, duplicate long, truncated long, illegal long, first string, last string, "
            "turn long, role string, digest string, _row long, _copy int")


def _segments(ranged: DataFrame, rows_per_segment: int) -> DataFrame:
    """One record per stretch of at most ``rows_per_segment`` rows of a conversation, with the place of its first row."""
    kinds = (SOUND, GONE, GONE, SHORT)

    def run(batches):
        from pyspark import TaskContext
        seg, conv, head, initials, faults = TaskContext.get().partitionId() << 32, None, None, [], []

        def record():
            nonlocal seg, head, initials, faults
            symbols = np.fromiter((symbol(i, kinds[f]) for i, f in zip(initials, faults)), np.uint8, len(faults))
            matrix = [x for row in segment_matrix(collapse(symbols.astype(np.int64))) for x in row]
            illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
            out = (conv, seg, len(faults), symbols.tobytes(), matrix, *[faults.count(k) for k in (1, 2, 3)], illegal, initials[0], initials[-1], *head)
            seg, head, initials, faults = seg + 1, None, [], []
            return out

        for pdf in batches:
            out = []
            for c, turn, role, digest, row, copy, fault in zip(*[pdf[c].tolist() for c in [*PLACE, "fault"]]):
                if faults and (c != conv or len(faults) == rows_per_segment):
                    out.append(record())
                if not faults:
                    conv, head = c, (None if pd.isna(turn) else int(turn), role, digest, row, copy)
                initials.append(role[:1])
                faults.append(fault)
            yield _frame(out, _SEGMENT)
        if faults:
            yield _frame([record()], _SEGMENT)

    # a null turn would turn the column into doubles on its way to pandas
    return ranged.withColumn("turn", F.col("turn").cast("string")).mapInPandas(run, _SEGMENT)


def _frame(rows: list[tuple], schema: str) -> pd.DataFrame:
    names = [f.split()[0] for f in schema.split(", ")]
    frame = pd.DataFrame(rows, columns=names)
    return frame.astype({"turn": "Int64"}) if "turn" in names else frame


def _chain(segments: DataFrame) -> DataFrame:
    """(conv, seg, costs after the segment, cost of the whole, illegal pairs across the segment's end); one record a segment passes, from the last to the first."""
    schema = "conv string, seg long, after array<long>, cost long, across long, final boolean"

    def run(batches):
        conv, costs, first = None, None, None
        for pdf in batches:
            out = []
            for c, seg, matrix, begin, end in zip(pdf["conv"], pdf["seg"].tolist(), pdf["matrix"], pdf["first"], pdf["last"]):
                final = c != conv
                if final:
                    conv, costs, first = c, END, None
                m = tuple(tuple(int(x) for x in matrix[i:i + 4]) for i in range(0, 16, 4))
                before = towards(m, costs)
                out.append((c, seg, list(_level(costs)), before[START], int(not final and end + first not in ("su", "ua", "au")), final))
                costs, first = before, begin
            yield pd.DataFrame(out, columns=["conv", "seg", "after", "cost", "across", "final"])

    narrow = segments.select("conv", "seg", "matrix", "first", "last").repartition("conv").sortWithinPartitions("conv", F.desc("seg"))
    return narrow.mapInPandas(run, schema)


def _unrolled(segments: DataFrame) -> DataFrame:
    """Adds ``ways``: for each state before the segment, its edits and the state after it (the first segment of a conversation starts at START)."""
    @F.pandas_udf("array<struct<audit:string,state:int>>")
    def run(symbols: pd.Series, after: pd.Series, whole: pd.Series) -> pd.Series:
        out = []
        for s, a, w in zip(symbols, after, whole):
            runs, costs = collapse(np.frombuffer(s, np.uint8).astype(np.int64)), tuple(int(x) for x in a)
            ways = [unroll(runs, state, costs) for state in ([START] if w else range(4))]
            out.append([{"audit": audit, "state": state} for audit, state in ways])
        return pd.Series(out)

    return segments.withColumn("ways", run("symbols", "after", "whole"))


def repair(rows: DataFrame, rows_per_segment: int = 1 << 16) -> DataFrame:
    """Segments of the conversations of ``rows`` (conv_id, turn, role, text, _row, _copy) with their cheapest edits.

    Columns: conv, seg (ascending within a conversation), n, blank, duplicate, truncated, illegal, cost (of the whole conversation, in its first
    segment), audit, state (before the segment), and the place of the first row. Rows stand by turn (nulls first), then role, then
    content, so that ties have one order wherever they lie. A role whose initial is none of s, u, a can't be kept; an empty role has no initial.
    """
    marked = cut(_marked(rows), "repair-rows")
    ranged = _faults(marked).repartitionByRange(shuffle_partitions(rows.sparkSession), *PLACE).sortWithinPartitions(*PLACE)
    segments = cut(_segments(ranged, rows_per_segment), "repair-segments")
    chain = _chain(segments)
    firsts = segments.groupBy("conv").agg(F.min("seg").alias("_first"))
    told = segments.drop("matrix", "first", "last").join(chain, ["conv", "seg"]).join(firsts, "conv").withColumn("whole", F.col("seg") == F.col("_first"))
    told = cut(_unrolled(told).drop("symbols", "after", "_first"), "repair-ways")

    def follow(batches):
        conv, state = None, START
        for pdf in batches:
            audits, states = [], []
            for c, ways, final, whole in zip(*[pdf[x].tolist() for x in ("conv", "ways", "final", "whole")]):
                state = START if c != conv else state
                conv = c
                way = ways[0 if whole else state]
                states.append(state)
                state = int(way["state"])
                audits.append(way["audit"] + (tail(state) if final else ""))
            yield pdf.drop(columns=["ways", "final"]).assign(audit=audits, state=states)

    schema = ("conv string, seg long, n long, blank long, duplicate long, truncated long, illegal long, turn long, role string, digest string, _row long, "
              "_copy int, cost long, across long, whole boolean, audit string, state int")
    ordered = told.repartition("conv").sortWithinPartitions("conv", "seg")
    done = ordered.select("conv", "seg", "n", "blank", "duplicate", "truncated", "illegal", "turn", "role", "digest", "_row", "_copy", "cost", "across", "whole", "final", "ways")
    done = done.withColumn("turn", F.col("turn").cast("string")).mapInPandas(follow, schema.replace("turn long", "turn string")).withColumn("turn", F.col("turn").cast("long"))
    return done.withColumn("illegal", F.col("illegal") + F.col("across")).withColumn("cost", F.when(F.col("whole"), F.col("cost"))).drop("across", "whole")


def repaired_rows(rows: DataFrame, segments: DataFrame, digest_only: bool = False) -> DataFrame:
    """The conversations after the edits: (conv, place, edit, role, text) per row that stays or is inserted; or (conv, repaired_sha256) of them.

    Each segment's edits travel before its rows, which pass one by one: a task holds a batch, whatever a conversation's length.
    """
    texts = rows.select(conversation_key(F.col("conv_id")).alias("conv"), "turn", "role",
                        F.substring(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256), 1, 32).alias("digest"),
                        "_row", "_copy", F.lit(1).alias("_kind"), "text", F.lit(None).cast("string").alias("audit"), F.lit(None).cast("int").alias("state"), F.lit(None).cast("long").alias("n"))
    heads = segments.select("conv", "turn", "role", "digest", "_row", "_copy", F.lit(0).alias("_kind"), F.lit(None).cast("string").alias("text"), "audit", "state", "n")
    both = texts.unionByName(heads).repartition("conv").sortWithinPartitions(*PLACE, "_kind").select("conv", "_kind", "role", "text", "audit", "state", "n")

    def steps(batches):
        """(conv, edit, role, text) in order."""
        audit, at, state, left = "", 0, START, 0
        for pdf in batches:
            out = []
            for conv, kind, role, text, new, before, n in zip(*[pdf[c].tolist() for c in pdf.columns]):
                if kind == 0:
                    audit, at, state, left = new, 0, int(before), int(n)
                    continue
                while audit[at] == "I":
                    out.append((conv, "I", FITTING[state], ""))
                    state, at = _NEXT[state], at + 1
                edit, at = audit[at], at + 1
                if edit == "K":
                    out.append((conv, edit, role, text))
                    state = _STEP[state][role[:1]]
                elif edit == "R":
                    out.append((conv, edit, FITTING[state], text))
                    state = _NEXT[state]
                left -= 1
                while not left and at < len(audit):  # after the last row
                    out.append((conv, "I", FITTING[state], ""))
                    state, at = _NEXT[state], at + 1
            yield out

    def listed(batches):
        place, last = 0, None
        for out in steps(batches):
            places = []
            for step in out:
                place = place + 1 if step[0] == last else 0
                last = step[0]
                places.append(place)
            frame = pd.DataFrame(out, columns=["conv", "edit", "role", "text"])
            yield frame.assign(place=places)[["conv", "place", "edit", "role", "text"]]

    def hashed(batches):
        conv, digest = None, None
        for out in steps(batches):
            done = []
            for c, _, role, text in out:
                if c != conv:
                    if digest is not None:
                        done.append((conv, digest.hexdigest()))
                    conv, digest = c, hashlib.sha256()
                else:
                    digest.update(b"\n")
                digest.update(f"{role}:{text}".encode("utf-8", "surrogatepass"))
            yield pd.DataFrame(done, columns=["conv", "repaired_sha256"])
        if digest is not None:
            yield pd.DataFrame([(conv, digest.hexdigest())], columns=["conv", "repaired_sha256"])

    if digest_only:
        return both.mapInPandas(hashed, "conv string, repaired_sha256 string")
    return both.mapInPandas(listed, "conv string, place long, edit string, role string, text string")


def report(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
           rows_per_segment: int = 1 << 16) -> DataFrame:
    """One row per conv_id of ``conversations`` after :func:`damage` and :func:`repair`: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    A null conv_id is a conversation of its own; null turns come first and count for no gap; null roles and texts are one blank. Rows that tie in
    their turn stand by role, then by SHA-256 of role and text; repeated rows are duplicates of each other. A conversation that keeps no row has zeros, an empty audit and the hash
    of nothing. Other columns aren't read. An empty table gives an empty result. Counts are aggregated before the shuffle and
    edits found per segment; the audit and the digest, one value per conversation, are put together in one task each, streaming.
    """
    ids = conversations.select(F.col(id_col).alias("conv_id"), conversation_key(F.col(id_col)).alias("conv")).distinct()
    rows = cut(damage(conversations, id_col, turn_col, role_col, text_col), "repair-damaged")
    segments = cut(repair(rows, rows_per_segment), "repair-audits")
    turns = rows.filter("turn is not null").select(conversation_key(F.col("conv_id")).alias("conv"), "turn").groupBy("conv", "turn").agg(F.count(F.lit(1)))
    gaps = turns.groupBy("conv").agg((F.max("turn") - F.min("turn") + 1 - F.count(F.lit(1))).alias("gaps"))
    counts = ["blank", "duplicate", "truncated", "illegal", "cost"]
    whole = segments.groupBy("conv").agg(*[F.sum(c).alias(c) for c in counts], F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("seg", "audit"))), lambda x: x["audit"]), "").alias("audit"))
    out = ids.join(gaps, "conv", "left").join(whole, "conv", "left").join(repaired_rows(rows, segments, digest_only=True), "conv", "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    return out.select("conv_id", *[zero(c) for c in ["gaps", *counts]], F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))
