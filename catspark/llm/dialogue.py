"""Conversation structure repair (operator 12): square-root checkpointed dynamic program.

The rows of all conversations are ranked in one distributed sort and cut into
blocks of consecutive ranks, so a conversation of any length is many blocks.
A row is one letter of a block: its role initial and its fault.  The program
has four states (nothing yet, after system, after user, after assistant):

1. every block gives, for each state that it may end in, the cost vector over
   the states that it may start in (a min-plus matrix);
2. the matrices of a conversation, last block first, give the vector at the
   end of each of its blocks;
3. every block stores the vectors of each sqrt(n)-th row only, and walks
   forward: the vectors of one stretch are computed again from its stored one,
   and of the edits that keep the cost tight the ASCII-least is taken;
4. a block other than the first walks from each of the four states, and the
   states at which the blocks really begin follow from first to last.

Costs relative to a vector's least entry take few values, so a step is looked
up by (letter, relative vector) after it was computed once.
"""

from __future__ import annotations

from functools import lru_cache
from math import isqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.ranking import global_rank
from ..session import materialise
from .common import ship

#: fixed values of the task: edit costs and legal pairs of role initials
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
LEGAL = ("su", "ua", "au")
ROLES = {"u": "user", "a": "assistant"}

NEVER = 1 << 40
START, SYSTEM, USER, ASSISTANT = range(4)
INITIALS = "sua"                       # any other initial is the fourth
NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
ROLE_OF = {USER: "u", ASSISTANT: "a"}
FINE, BLANK, DUPLICATE, CUT = range(4)
FIRST_LETTER = ord("A")
#: cost to go after the last row: nothing or complete pairs, else what has to be inserted
FINAL = (0, 2 * INSERT, INSERT, 0)
#: consecutive rows of one block
BLOCK_ROWS = 1 << 18


def letter(initial: Column, fault: Column) -> Column:
    """A row of the program as one character."""
    known = F.when(initial != "", F.nullif(F.instr(F.lit(INITIALS), initial), F.lit(0)))
    kind = F.coalesce(known - 1, F.lit(len(INITIALS)))
    return F.char(F.lit(FIRST_LETTER) + kind * 4 + fault)


def decode(char: str) -> tuple[str, int]:
    kind, fault = divmod(ord(char) - FIRST_LETTER, 4)
    return (INITIALS + "?")[kind], fault


def consume(char: str) -> list[list[tuple[str, int, int]]]:
    """By state: (edit, cost, next state) for every edit that uses up the row, by edit."""
    initial, fault = decode(char)
    out = []
    for state in range(4):
        edits = [("D", DELETE, state)]
        if fault not in (BLANK, DUPLICATE):
            more = TRUNCATED if fault == CUT else 0
            to = NEXT[state]
            if initial == ROLE_OF[to]:
                edits.append(("K", more, to))
            elif initial == "s" and state == START:
                edits.append(("K", more, SYSTEM))
            edits.append(("R", REROLE + more, to))
        out.append(edits)
    return out


TABLE = {chr(FIRST_LETTER + i): consume(chr(FIRST_LETTER + i)) for i in range(16)}


def with_insertions(base) -> tuple:
    """Cost to go where rows may be inserted first."""
    user = min(base[USER], INSERT + base[ASSISTANT])
    assistant = min(base[ASSISTANT], INSERT + base[USER])
    return (min(base[START], INSERT + user), min(base[SYSTEM], INSERT + user), user, assistant)


@lru_cache(maxsize=1 << 16)
def _step(char: str, relative: tuple) -> tuple[int, tuple]:
    base = [min(cost + relative[to] for _, cost, to in edits) for edits in TABLE[char]]
    return relative_of(with_insertions([min(c, NEVER) for c in base]))


def back(char: str, total: int, relative: tuple) -> tuple[int, tuple]:
    """Cost vector before a row from that after it, as (least, rest)."""
    least, before = _step(char, relative)
    return total + least, before


def relative_of(costs) -> tuple[int, tuple]:
    least = min(costs)
    return least, tuple(NEVER if c >= NEVER else c - least for c in costs)


def block_matrix(codes: str) -> list[int]:
    """Costs [start state, end state] of a block, row by row of the matrix."""
    columns = []
    for end in range(4):
        total, rel = 0, tuple(0 if s == end else NEVER for s in range(4))
        for char in reversed(codes):
            total, rel = back(char, total, rel)
        columns.append([NEVER if r >= NEVER else total + r for r in rel])
    return [columns[end][start] for start in range(4) for end in range(4)]


def checkpoints(codes: str, end_costs) -> tuple[int, dict[int, tuple]]:
    """(stride, vectors after rows stride, 2 stride, ...) of a block with costs at its end."""
    stride = isqrt(len(codes)) + 1
    total, rel = relative_of(end_costs)
    stored = {len(codes): (total, rel)}
    for i in range(len(codes) - 1, 0, -1):
        total, rel = back(codes[i], total, rel)
        if i % stride == 0:
            stored[i] = (total, rel)
    return stride, stored


def walk(codes: str, end_costs, state: int, last: bool) -> tuple[str, int]:
    """(edits, state after them): the ASCII-least tight edits from ``state``.

    Rows may be inserted before any row of the block and, in the ``last``
    block of a conversation, after all of them.
    """
    stride, stored = checkpoints(codes, end_costs)
    edits: list[str] = []
    for begin in range(0, len(codes), stride):
        stop = min(begin + stride, len(codes))
        vectors = [stored[stop]]
        for i in range(stop - 1, begin - 1, -1):  # the stretch, computed again
            vectors.append(back(codes[i], *vectors[-1]))
        vectors.reverse()
        for i in range(begin, stop):
            (here, rel), (after, rel_after) = vectors[i - begin], vectors[i - begin + 1]
            while True:
                cost = here + rel[state]
                tight = [(e, to) for e, c, to in TABLE[codes[i]][state]
                         if c + after + rel_after[to] == cost and rel_after[to] < NEVER]
                if INSERT + here + rel[NEXT[state]] == cost:
                    tight.append(("I", NEXT[state]))
                edit, state = min(tight)
                edits.append(edit)
                if edit != "I":
                    break
    if last:
        while end_costs[state]:
            edits.append("I")
            state = NEXT[state]
    return "".join(edits), state


# ---------------------------------------------------------------------------
# Rows
# ---------------------------------------------------------------------------

def _space(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(" "))


def damage(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
           text: str = "text") -> DataFrame:
    """(conv, turn, role, text, copy): rows dropped, emptied, cut, repeated or given to the user.

    What happens to a row follows from crc32 of ``conv:turn`` modulo 20; nulls
    of any column count as one space there and in role and text.
    """
    r = F.crc32(F.concat(_space(F.col(conv)), F.lit(":"), _space(F.col(turn))).cast("binary")) % 20
    rows = df.select(F.col(conv).cast("long").alias("conv"), F.col(turn).cast("long").alias("turn"),
                     _space(F.col(role)).alias("role"), _space(F.col(text)).alias("text"),
                     r.alias("_r")).where("_r <> 0")
    return (rows.withColumn("role", F.when(F.col("_r") == 4, F.lit("user")).otherwise(F.col("role")))
            .withColumn("text", F.when(F.col("_r") == 1, F.lit(""))
                        .when(F.col("_r") == 2, F.regexp_replace("text", "[.!?]", ""))
                        .otherwise(F.col("text")))
            .withColumn("copy", F.explode(F.when(F.col("_r") == 3, F.array(F.lit(0), F.lit(1)))
                                          .otherwise(F.array(F.lit(0)))))
            .drop("_r"))


def ranked_rows(rows: DataFrame) -> DataFrame:
    """``rows(conv, turn, role, text)`` with their rank: 1, 2, ... over the whole table.

    Within a conversation: null turns first, then turn, role, text.
    """
    order = [F.col("conv").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role"),
             F.col("text"), F.col("_row")]
    numbered = rows.withColumn("_row", F.monotonically_increasing_id())
    return global_rank(numbered, order, "rank").drop("_row")


def coded(ranked: DataFrame) -> DataFrame:
    """(conv, turn, rank, fault, code): the first fault and the letter of every ranked row."""
    ranked = ranked.withColumn("_same", F.sha2(F.concat_ws(
        ":", F.length("role").cast("string"), "role", "text"), 256))
    # one row per text that a conversation holds twice or more
    first = materialise(
        ranked.groupBy("conv", "_same").agg(F.min("rank").alias("_first"),
                                            F.count(F.lit(1)).alias("_n"))
        .where("_n > 1").select(F.col("conv").alias("_c"), F.col("_same").alias("_s"), "_first"),
        "repeated_turns")
    last = F.right(F.regexp_replace("text", r"[\x20\x09-\x0D]+\z", ""), F.lit(1))
    fault = (F.when(last == "", F.lit(BLANK)).when(F.col("rank") > F.col("_first"), F.lit(DUPLICATE))
             .when(~last.isin(".", "!", "?"), F.lit(CUT)).otherwise(F.lit(FINE)))
    return (ranked.join(first, ranked["conv"].eqNullSafe(first["_c"])
                        & (ranked["_same"] == first["_s"]), "left")
            .withColumn("fault", fault)
            .withColumn("code", letter(F.left("role", F.lit(1)), F.col("fault")))
            .select("conv", "turn", "rank", "fault", "code"))


def repair(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
           text: str = "text", block_rows: int = BLOCK_ROWS) -> tuple[DataFrame, DataFrame]:
    """Cheapest edits that make every conversation ``(s?(ua)+)?`` by its role initials.

    Keep costs 0, rerole to user or assistant 3, delete 4 (blank rows and rows
    whose role and text came earlier have to go), an inserted empty row 3; a
    row that stays and whose last character does not end a sentence costs 3
    more.  Of the cheapest edits the ASCII-least string of initials is taken.

    Returns (report, turns).  ``report(conv, gaps, blank, duplicate, truncated,
    illegal, cost, audit)`` has a row per conversation with rows.
    ``turns(conv, seq, edit, rank, role, text)`` are the repaired rows; ``seq``
    ascends within a conversation.

    Null ids are one conversation; null turns come first; null role and text
    are one space (a blank text, no known initial); an empty role has no
    known initial either.  Rows of one turn are ordered by role and text.
    Repeated rows are duplicates.  Very long texts stay whole.  Empty table:
    two empty tables.  Other columns are ignored.
    """
    ranked = ranked_rows(df.select(
        F.col(conv).cast("long").alias("conv"), F.col(turn).cast("long").alias("turn"),
        _space(F.col(role)).alias("role"), _space(F.col(text)).alias("text")))
    rows = materialise(coded(ranked), "coded")
    ship(df.sparkSession)
    walked = walks(rows, block_rows)
    edits = edit_rows(walked)
    turns = (edits.where("edit <> 'D'")
             .join(ranked.select("rank", F.col("role").alias("_role"), "text"), "rank", "left")
             .select("conv", "seq", "edit", "rank",
                     F.when(F.col("edit") == "K", F.col("_role")).otherwise(F.col("role")).alias("role"),
                     F.coalesce("text", F.lit("")).alias("text")))
    return report(rows, walked), turns


def blocks(rows: DataFrame, block_rows: int) -> DataFrame:
    """(conv, start, codes): the letters of consecutive rows of one conversation."""
    piece = F.floor(F.col("rank") / F.lit(block_rows)).alias("_piece")
    listed = F.array_sort(F.collect_list(F.struct("rank", "code")))
    return (rows.groupBy("conv", piece)  # at most block_rows rows a group
            .agg(F.min("rank").alias("start"), listed.alias("r"))
            .select("conv", "start", F.array_join(F.col("r.code"), "").alias("codes")))


def walks(rows: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(conv, start, codes, n_illegal, cost, audit) of every block, written once."""
    cut = materialise(blocks(rows, block_rows), "blocks")

    def matrices(frames):
        for pdf in frames:
            yield pdf[["conv", "start"]].assign(  # ids as strings: pandas has no null integer
                first=pdf["codes"].str[0], last=pdf["codes"].str[-1],
                illegal=[illegal_pairs(c) for c in pdf["codes"]],
                matrix=[block_matrix(c) for c in pdf["codes"]])

    cut = cut.withColumn("conv", F.col("conv").cast("string"))
    per_block = cut.mapInPandas(
        matrices, "conv string, start long, first string, last string, illegal long, "
                  "matrix array<long>")

    def ends(frames):
        import pandas as pd
        for pdf in frames:
            out = []
            for parts in pdf["parts"]:
                parts = sorted(parts, key=lambda p: p["start"])
                costs, before = list(FINAL), None
                for p in reversed(parts):
                    lead = before is not None and illegal_pairs(p["last"] + before["first"])
                    m = p["matrix"]
                    start = [min(int(m[4 * s + e]) + costs[e] for e in range(4)) for s in range(4)]
                    first = p is parts[0]
                    out.append((p["start"], costs, before is None, first,
                                p["illegal"] + int(lead), start[START] if first else 0))
                    costs, before = [min(c, NEVER) for c in start], p
            yield pd.DataFrame(out, columns=["start", "ends", "is_last", "is_first", "illegal",
                                             "cost"])

    listed = per_block.groupBy("conv").agg(F.collect_list(F.struct(
        "start", "first", "last", "illegal", "matrix")).alias("parts"))  # 200 bytes a block
    at_ends = listed.select("parts").mapInPandas(
        ends, "start long, ends array<long>, is_last boolean, is_first boolean, illegal long, "
              "cost long")

    def forward(frames):
        for pdf in frames:
            edits, states = [], []
            for codes, costs, last, first in zip(pdf["codes"], pdf["ends"], pdf["is_last"],
                                                 pdf["is_first"], strict=True):
                costs = [int(c) for c in costs]
                done = [walk(codes, costs, s, last) if s == START or not first else ("", -1)
                        for s in range(4)]
                edits.append([e for e, _ in done])
                states.append([s for _, s in done])
            yield pdf[["conv", "start", "codes", "is_first", "illegal", "cost"]].assign(
                audits=edits, states=states)

    tried = materialise(cut.join(at_ends, "start").mapInPandas(
        forward, "conv string, start long, codes string, is_first boolean, illegal long, cost long, "
                 "audits array<string>, states array<int>"), "tried")

    def begins(frames):
        import pandas as pd
        for pdf in frames:
            out = []
            for parts in pdf["parts"]:
                state = START
                for p in sorted(parts, key=lambda p: p["start"]):
                    out.append((p["start"], state))
                    state = p["states"][state]
            yield pd.DataFrame(out, columns=["start", "state"])

    entered = (tried.groupBy("conv").agg(F.collect_list(F.struct("start", "states")).alias("parts"))
               .select("parts").mapInPandas(begins, "start long, state int"))
    return materialise(tried.join(entered, "start").select(
        F.col("conv").cast("long").alias("conv"), "start", "codes", "illegal", "cost", "state",
        F.element_at("audits", F.col("state") + 1).alias("audit")), "walks")


def illegal_pairs(codes: str) -> int:
    roles = [decode(c)[0] for c in codes]
    return sum(a + b not in LEGAL for a, b in zip(roles, roles[1:]))  # noqa: B905


def edit_rows(walked: DataFrame) -> DataFrame:
    """(conv, seq, edit, rank, role): one row per edit; rank names the row it uses up (0: none).

    ``seq`` is the rank at which the edit comes and its number among the
    insertions there, packed into one ascending number.
    """
    def flat(frames):
        import pandas as pd
        for pdf in frames:
            out = []
            for conv, start, codes, state, audit in zip(
                    pdf["conv"], pdf["start"], pdf["codes"], pdf["state"], pdf["audit"],
                    strict=True):
                rank, at = start, 0
                for edit in audit:
                    if edit == "D":
                        to = state
                    elif edit == "K" and decode(codes[rank - start])[0] == "s":
                        to = SYSTEM
                    else:
                        to = NEXT[state]
                    out.append((conv, (rank << 8) + at, edit, 0 if edit == "I" else rank,
                                ROLES.get(ROLE_OF.get(to))))
                    state, at = to, at + 1
                    if edit != "I":
                        rank, at = rank + 1, 0
            yield pd.DataFrame(out, columns=["conv", "seq", "edit", "rank", "role"])

    flats = walked.select(F.col("conv").cast("string").alias("conv"), "start", "codes", "state",
                          "audit").mapInPandas(
        flat, "conv string, seq long, edit string, rank long, role string")
    return flats.withColumn("conv", F.col("conv").cast("long"))


def report(rows: DataFrame, walked: DataFrame) -> DataFrame:
    """Counts, cost and audit per conversation."""
    kinds = {"blank": BLANK, "duplicate": DUPLICATE, "truncated": CUT}
    per_turn = rows.groupBy("conv", "turn").agg(
        *[F.sum((F.col("fault") == v).cast("long")).alias(k) for k, v in kinds.items()])
    counts = per_turn.groupBy("conv").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0).cast("long"))
        .alias("gaps"), *[F.sum(k).alias(k) for k in kinds])
    pieces = F.array_sort(F.collect_list(F.struct("start", "audit")))
    whole = walked.groupBy(F.col("conv").alias("_c")).agg(
        F.sum("illegal").alias("illegal"), F.max("cost").alias("cost"),
        F.array_join(pieces["audit"], "").alias("audit"))
    return (counts.join(whole, counts["conv"].eqNullSafe(whole["_c"]))
            .select("conv", "gaps", *kinds, "illegal", "cost", "audit"))


def digests(turns: DataFrame) -> DataFrame:
    """(conv, repaired_sha256): hash of the ``role:text`` rows, joined by newlines.

    A hash runs through its conversation from first to last row: a task
    streams the sorted rows and holds one batch of them.
    """
    def hashes(frames):
        import hashlib

        import pandas as pd
        names = ["conv", "repaired_sha256"]
        now, state = None, None
        for pdf in frames:
            out = []
            for conv, line in zip(pdf["conv"], pdf["line"], strict=True):
                if state is None or conv != now:
                    if state is not None:
                        out.append((now, state.hexdigest()))
                    now, state = conv, hashlib.sha256(line.encode())
                else:
                    state.update(b"\n" + line.encode())
            yield pd.DataFrame(out, columns=names)
        if state is not None:
            yield pd.DataFrame([(now, state.hexdigest())], columns=names)

    lines = turns.select(F.col("conv").cast("string").alias("conv"), "seq",
                         F.concat("role", F.lit(":"), "text").alias("line"))
    hashed = (lines.repartition("conv").sortWithinPartitions("conv", "seq").select("conv", "line")
              .mapInPandas(hashes, "conv string, repaired_sha256 string"))
    return hashed.withColumn("conv", F.col("conv").cast("long"))


def repair_digest(df: DataFrame) -> DataFrame:
    """The damaged table's report, with a row for every original conversation."""
    broken = damage(df)
    found, turns = repair(broken, "conv", "turn", "role", "text")
    found = found.withColumnRenamed("conv", "_conv")
    hashed = digests(turns).withColumnRenamed("conv", "_turns_conv")
    ids = df.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    out = (ids.join(found, ids["conv_id"].eqNullSafe(found["_conv"]), "left")
           .join(hashed, F.col("conv_id").eqNullSafe(F.col("_turns_conv")), "left"))
    zero = [F.coalesce(c, F.lit(0).cast("long")).alias(c)
            for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select("conv_id", *zero, F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
