import hashlib
import random
import zlib

import pytest

from listwise.llm import repair as rp

SPACES = " \t\n\x0b\x0c\r"
ALLOWED = {"su", "ua", "au"}


def brute(rows):
    """Counts and the cheapest repair of (turn, role, text) rows by a program over all turns and states."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    seen, faults = set(), []
    for _, role, text in rows:
        bare = text.rstrip(SPACES)
        faults.append("blank" if not bare.strip(SPACES) else "duplicate" if (role, text) in seen
                      else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    illegal = sum(a[1][:1] + b[1][:1] not in ALLOWED for a, b in zip(rows, rows[1:]))
    turns = [r[0] for r in rows if r[0] is not None]
    takes = {0: 2, 1: 2, 2: 3, 3: 2}
    keeps = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}
    names = {2: "user:", 3: "assistant:"}
    best = {0: (0, "", []), 3: (0, "", [])}
    best[2] = (3, "I", ["assistant:"])
    best[1] = (6, "II", ["user:", "assistant:"])
    for (_, role, text), fault in zip(rows[::-1], faults[::-1]):
        cut, now = 3 * (fault == "truncated"), {}
        for q in range(4):
            options = [(best[q][0] + 4, "D" + best[q][1], best[q][2])]
            if fault not in ("blank", "duplicate"):
                to = takes[q]
                options.append((best[to][0] + 3 + cut, "R" + best[to][1], [names[to] + text, *best[to][2]]))
                to = keeps.get((role[:1], q))
                if to:
                    options.append((best[to][0] + cut, "K" + best[to][1], [role + ":" + text, *best[to][2]]))
            now[q] = min(options)
        for _ in range(3):
            now = {q: min(now[q], (now[takes[q]][0] + 3, "I" + now[takes[q]][1], [names[takes[q]], *now[takes[q]][2]])) for q in range(4)}
        best = now
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    cost, audit, left = best[0]
    return (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit,
            hashlib.sha256("\n".join(left).encode()).hexdigest())


def damaged(rows):
    out = {}
    for conv, turn, role, text in rows:
        role, text = (" " if v is None else v for v in (role, text))
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        kept = out.setdefault(conv, [])
        text = "" if fault == 1 else "".join(c for c in text if c not in ".!?") if fault == 2 else text
        kept += [(turn, "user" if fault == 4 else role, text)] * {0: 0, 3: 2}.get(fault, 1)
    return out


def random_rows(n, seed):
    rng = random.Random(seed)
    rows = []
    for conv in [*range(n), None]:
        for turn in range(rng.randint(1, 12)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "User", "", "a", None])
            text = rng.choice(["Yes.", "No", "ok!", " ", "", None, "Well?\n", "x. y", f"é {turn}.", " "])
            rows.append((conv, rng.choice([turn, turn, turn, turn + 5, None, 0]), role, text))
    return rows


@pytest.mark.parametrize("turns", [1024, 3])
def test_against_brute_force(spark, monkeypatch, turns):
    """Whole conversations, and the same cut into parts of three turns."""
    monkeypatch.setattr(rp, "PART_TURNS", turns)
    rows = random_rows(400, turns)
    df = spark.createDataFrame([(*r, "key", 1) for r in rows], "conv_id long, turn long, role string, text string, key string, part int")
    got = {r[0]: tuple(r)[1:] for r in rp.repair_damaged(df.repartition(6)).collect()}
    want = {conv: brute(kept) for conv, kept in damaged(rows).items()}
    assert got == want
    assert any("I" in w[6] and "R" in w[6] and "D" in w[6] for w in want.values()) and any(not w[6] for w in want.values())


def test_runs_by_powers():
    rng = random.Random(4)
    for _ in range(300):
        marks = [(rng.choice("suaSUAx?!"), rng.choice([1, 1, 2, 5, 37])) for _ in range(rng.randint(1, 8))]
        runs = rp._collapsed(marks)
        single = [(s, 1) for s, n in marks for _ in range(n)]
        cost, edits = rp.applied(rp.transition(tuple(runs)), rp.END)[0], rp.edits_of(runs, 0, rp.END)
        assert edits == rp.edits_of(single, 0, rp.END)
        v = rp.END
        for s, _ in reversed(single):
            v = rp.applied(rp.power(s, 0), v)
        assert v[0] == cost


def test_long_run_and_long_texts(spark):
    """Two hundred thousand copies of a turn are one run; a text of a million words is one turn."""
    long = "word " * 10 ** 6 + "end."
    rows = [(1, 0, "user", long), (1, 1, "assistant", "fine."), (2, None, "assistant", "so")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    many = spark.range(200000).selectExpr("3 AS conv_id", "0 AS turn", "'user' AS role", "'Hello.' AS text")
    parts = rp.repair(df.unionByName(many))
    got = {r.conv_id: r for r in rp.digests(parts).collect()}
    assert got[1].audit == "KK" and got[1].repaired_sha256 == hashlib.sha256(f"user:{long}\nassistant:fine.".encode()).hexdigest()
    assert got[2].audit == "D" and got[2].cost == 4 and got[2].truncated == 1
    assert got[3].audit == "K" + "D" * 199999 + "I" and (got[3].duplicate, got[3].cost, got[3].illegal) == (199999, 799999, 199999)


def test_parts_are_whole_turns(spark):
    rows = [(7, t, "user" if t % 2 == 0 else "assistant", f"turn {t}.") for t in range(3000)]
    parts = rp.repair(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).orderBy("part").collect()
    assert len(parts) > 2 and [t.text for p in parts for t in p.repaired] == [f"turn {t}." for t in range(3000)]
    assert sum(p.cost for p in parts) == 0


def test_empty(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert rp.repair_damaged(empty).collect() == [] and rp.repair(empty).collect() == []
    # Every row of the only conversation is dropped by the damage.
    conv = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    gone = spark.createDataFrame([(conv, 0, "user", "Hi.")], empty.schema)
    assert [tuple(r) for r in rp.repair_damaged(gone).collect()] == [(conv, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
