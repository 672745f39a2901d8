import hashlib
import random
import re
import zlib

from pyspark.sql import functions as F

from catspark.llm import dialogue
from catspark.llm.dialogue import ASSISTANT, NEXT, START, SYSTEM

COLS = "conv_id long, turn long, role string, text string"


def cheapest(rows):
    """(cost, audit, repaired) by a forward table of (cost, audit) per state; rows (initial, fault)."""
    def insert(best):
        for _ in range(2):
            for s, (c, a, out) in list(best.items()):
                offer(best, NEXT[s], c + 3, a + "I", [*out, ("I", NEXT[s])])

    def offer(best, s, c, a, out):
        if s not in best or (c, a) < best[s][:2]:
            best[s] = (c, a, out)

    best = {START: (0, "", [])}
    insert(best)
    for i, (initial, fault) in enumerate(rows):
        after = {}
        for s, (c, a, out) in best.items():
            offer(after, s, c + 4, a + "D", out)
            if fault in ("blank", "duplicate"):
                continue
            more = 3 * (fault == "truncated")
            role = {2: "u", 3: "a"}[NEXT[s]]
            offer(after, NEXT[s], c + 3 + more, a + "R", [*out, ("R", i, NEXT[s])])
            if initial == role:
                offer(after, NEXT[s], c + more, a + "K", [*out, ("K", i)])
            if initial == "s" and s == START:
                offer(after, SYSTEM, c + more, a + "K", [*out, ("K", i)])
        best = after
        insert(best)
    return min(best[s] for s in (START, ASSISTANT) if s in best)


def test_walk_equals_forward_table():
    r = random.Random(5)
    names = {dialogue.FINE: "", dialogue.BLANK: "blank", dialogue.DUPLICATE: "duplicate",
             dialogue.CUT: "truncated"}
    for n in [*range(9)] * 30 + [50, 333]:
        codes = "".join(chr(65 + r.choice([r.randrange(16), 4, 8])) for _ in range(n))
        rows = [(dialogue.decode(c)[0], names[dialogue.decode(c)[1]]) for c in codes]
        cost, audit, _ = cheapest(rows)
        if codes:
            got, state = dialogue.walk(codes, dialogue.FINAL, START, True)
            assert got == audit and state in (START, ASSISTANT)
            matrix = dialogue.block_matrix(codes)
            assert min(matrix[e] + dialogue.FINAL[e] for e in range(4)) == cost
        else:
            assert (cost, audit) == (0, "")


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        say = lambda x: " " if x is None else str(x)
        role, text = say(role), say(text)
        k = zlib.crc32(f"{say(conv)}:{say(turn)}".encode()) % 20
        if k == 0:
            continue
        if k == 1:
            text = ""
        if k == 2:
            text = re.sub("[.!?]", "", text)
        if k == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (2 if k == 3 else 1)
    return out


def brute(rows):
    by, out = {r[0]: [] for r in rows}, {}
    for r in damaged(rows):
        by[r[0]].append(r[1:])
    for conv, mine in by.items():
        mine.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2]))
        seen, faults = set(), []
        for _, role, text in mine:
            inner = text.strip(" \t\n\v\f\r")
            if not inner:
                faults.append("blank")
            elif (role, text) in seen:
                faults.append("duplicate")
            else:
                faults.append("" if inner[-1] in ".!?" else "truncated")
            seen.add((role, text))
        initials = [role[:1] if role[:1] in ("s", "u", "a") else "?" for _, role, _ in mine]
        cost, audit, body = cheapest(list(zip(initials, faults, strict=True)))
        lines, named = [], {2: "user", 3: "assistant"}
        for e in body:
            role = named[e[-1]] if e[0] != "K" else mine[e[1]][1]
            lines.append(f"{role}:{'' if e[0] == 'I' else mine[e[1]][2]}")
        turns = {t for t, _, _ in mine if t is not None}
        out[conv] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0,
                     *(faults.count(k) for k in ("blank", "duplicate", "truncated")),
                     sum(a + b not in ("su", "ua", "au")
                         for a, b in zip(initials, initials[1:], strict=False)),
                     cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def conversations(seed, n=60, most=12):
    r = random.Random(seed)
    texts = ["Hello there.", "What?", "no end", "", " \n", None, "é ü!", "Trailing. \t", "a", "Yes!"]
    rows = []
    for c in range(n):
        for t in range(r.randint(1, most)):
            role = r.choice(["user", "assistant", "user", "assistant", "system", "tool", None, ""])
            turn = r.choice([t, t, t, t, t + 3, None])
            rows.append((c * 7, turn, role, r.choice([f"said {c} {t}.", r.choice(texts)])))
    rows += [(None, 0, "user", "Null id."), (None, None, "assistant", "Null turn."), rows[3], rows[3]]
    rows += [(5, 2 ** 40, "user", "word. " * 30_000), (5, 2 ** 40 + 1, "assistant", "Far apart.")]
    r.shuffle(rows)
    return rows


def rows_of(df):
    return {r["conv_id"]: tuple(r)[1:] for r in df.collect()}


def test_repair_equals_brute_force(spark, monkeypatch):
    rows = conversations(1)
    df = (spark.createDataFrame(rows, COLS).withColumn("rank", F.lit(1)).withColumn("conv", F.lit("x"))
          .withColumn("start", F.lit(2)).repartition(3))
    got = rows_of(dialogue.repair_digest(df))
    assert got == brute(rows) and len(got) == df.select("conv_id").distinct().count()
    empty = dialogue.repair_digest(spark.createDataFrame([], COLS))
    assert empty.count() == 0


def test_long_conversations_are_cut_into_blocks(spark):
    rows = conversations(2, n=6, most=300)
    broken = dialogue.damage(spark.createDataFrame(rows, COLS))
    report, turns = dialogue.repair(broken, "conv", "turn", "role", "text", block_rows=7)
    hashed = {r["conv"]: r["repaired_sha256"] for r in dialogue.digests(turns).collect()}
    want = brute(rows)
    none = hashlib.sha256(b"").hexdigest()
    for r in report.collect():
        assert (*tuple(r)[1:], hashed.get(r["conv"], none)) == want[r["conv"]]
    # the repaired rows have the form that the edits are to reach
    kept = turns.orderBy("seq").groupBy("conv").agg(F.collect_list("role").alias("r"))
    for r in turns.select("conv", "seq", "role").toPandas().sort_values("seq").groupby(
            "conv", dropna=False)["role"]:
        assert re.fullmatch("(s?(ua)+)?", "".join(x[:1] for x in r[1]))
    assert kept.count() > 0
