"""Repair of conversation structure by a run-length dynamic program.

A conversation is well formed if its role initials read ``(s?(ua)+)?``. Turns may be kept (K, free),
given the role user or assistant (R, 3), deleted (D, 4; blank turns and repeats must be), and empty
turns may be put in (I, 3); a cut-off turn that is not deleted adds 3. The repair is the cheapest, and of
equally cheap ones that with the least string of edits.

Each turn is a symbol (its role initial and its fault), each symbol a 4 x 4 transition in min-plus
algebra over the states of the pattern. Equal neighbours collapse to a run; a run of n turns takes the
costs across by the cached powers 1, 2, 4, ... of its transition, and is unrolled for the edits by
halving, so a run needs memory for its depth only.

Transitions compose in any grouping, which is what spreads a conversation of any length over tasks:
turns are dealt by range and cut into parts; each part states its transition; costs pass backwards and
states forwards over the parts without their texts; then every part is repaired on its own.
"""

import hashlib
from functools import lru_cache
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from listwise.llm.common import written

#: Turns and characters of text of one part at most, but for one longer turn.
PART_TURNS = 1024
PART_CHARS = 4_000_000
SPACE = " \t\n\u000b\f\r"
NEVER = 1 << 60
DELETE, INSERT, REROLE, CUT = 4, 3, 3, 3
#: States: nothing yet, after s, after u, after a. The role that an inserted or re-roled turn takes on.
TAKES = (2, 2, 3, 2)
KEEPS = {"s": (1, None, None, None), "u": (2, 2, None, 2), "a": (None, None, 3, None), "?": (None,) * 4}
ROLE = {2: "user", 3: "assistant"}
GONE = "x"
_GREATEST_LONG = (1 << 63) - 1

Matrix = tuple[tuple[int, ...], ...]


def product(a: Matrix, b: Matrix) -> Matrix:
    return tuple(tuple(min(NEVER, min(x + b[k][j] for k, x in enumerate(row))) for j in range(4)) for row in a)


def applied(a: Matrix, v: tuple) -> tuple:
    return tuple(min(NEVER, min(x + y for x, y in zip(row, v))) for row in a)


NOTHING: Matrix = tuple(tuple(0 if i == j else NEVER for j in range(4)) for i in range(4))
#: What insertions reach; more than two in a row are never cheapest.
INSERTS: Matrix = tuple(tuple(0 if i == j else INSERT if j == TAKES[i] else 2 * INSERT if j == TAKES[TAKES[i]] else NEVER
                              for j in range(4)) for i in range(4))
#: Costs left after the last turn, by state.
END = applied(INSERTS, (0, NEVER, NEVER, 0))


def choices(symbol: str, state: int):
    """(edit, cost, next state) of one turn in the order of their letters, without insertions."""
    yield "D", DELETE, state
    if symbol != GONE:
        cut = CUT if symbol.isupper() or symbol == "!" else 0
        kept = KEEPS["?" if symbol == "!" else symbol.lower()][state]
        if kept is not None:
            yield "K", cut, kept
        yield "R", REROLE + cut, TAKES[state]


@lru_cache(maxsize=None)
def power(symbol: str, k: int) -> Matrix:
    """The transition of ``2 ** k`` turns of one symbol."""
    if k:
        return product(power(symbol, k - 1), power(symbol, k - 1))
    one = [[NEVER] * 4 for _ in range(4)]
    for state in range(4):
        for _, cost, after in choices(symbol, state):
            one[state][after] = min(one[state][after], cost)
    return product(INSERTS, one)


def across(symbol: str, n: int, after: tuple) -> tuple:
    """Costs before a run, from those after it."""
    k = 0
    while n:
        if n & 1:
            after = applied(power(symbol, k), after)
        n, k = n >> 1, k + 1
    return after


@lru_cache(maxsize=1 << 16)
def _turn(symbol: str, state: int, after: tuple) -> tuple[str, int]:
    before, edits = applied(power(symbol, 0), after), ""
    while True:
        options = [*choices(symbol, state), ("I", INSERT, TAKES[state])]
        edit, _, state = min(o for o in options if o[1] + (before if o[0] == "I" else after)[o[2]] == before[state])
        edits += edit
        if edit != "I":
            return edits, state


def unrolled(symbol: str, n: int, state: int, after: tuple) -> tuple[str, int]:
    """The edits of a run from a state on, and the state behind it."""
    if n == 1:
        least = min(after)
        return _turn(symbol, state, tuple(min(NEVER, x - least) if x < NEVER else NEVER for x in after))
    k = (n - 1).bit_length() - 1
    head, state = unrolled(symbol, n - (1 << k), state, applied(power(symbol, k), after))
    tail, state = unrolled(symbol, 1 << k, state, after)
    return head + tail, state


@lru_cache(maxsize=1 << 14)
def transition(runs: tuple) -> Matrix:
    """The transition of a row of runs."""
    columns = []
    for state in range(4):
        v = NOTHING[state]
        for symbol, n in reversed(runs):
            v = across(symbol, n, v)
        columns.append(v)
    return tuple(zip(*columns))


def edits_of(runs: list, state: int, after: tuple) -> tuple[str, int]:
    """The edits of a row of runs, given the costs behind it, and the state behind it."""
    behind = [after]
    for symbol, n in reversed(runs):
        behind.append(across(symbol, n, behind[-1]))
    out = []
    for (symbol, n), costs in zip(runs, behind[-2::-1]):
        edits, state = unrolled(symbol, n, state, costs)
        out.append(edits)
    return "".join(out), state


def closing(state: int) -> str:
    """Insertions after the last turn."""
    return "I" * (END[state] // INSERT)


def _collapsed(symbols) -> list:
    return [(s, sum(n for _, n in run)) for s, run in groupby(symbols, key=lambda x: x[0])]


def _rows(batches, names):
    for batch in batches:
        yield from zip(*(batch.column(batch.schema.get_field_index(n)).to_pylist() for n in names))


def _batches(rows, schema, size=512):
    """Arrow batches of dicts; ``size`` rows or some MB of text each."""
    held, weight = [], 0
    for row, w in rows:
        held.append(row)
        weight += w
        if len(held) >= size or weight >= PART_CHARS:
            yield pa.RecordBatch.from_pylist(held, schema)
            held, weight = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def _arrow(key, *fields):
    kinds = {"long": pa.int64(), "string": pa.string(), "longs": pa.list_(pa.int64()), "strings": pa.list_(pa.string()),
             "turns": pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))}
    return pa.schema([("key", key), *((n, kinds[k]) for n, k in fields)])


def _ddl(kind, fields):
    shown = {"longs": "array<long>", "strings": "array<string>", "turns": "array<struct<role: string, text: string>>"}
    return f"key struct<v: {kind}>, " + ", ".join(f"{n} {shown.get(k, k)}" for n, k in fields)


PART = [("part", "long"), ("symbols", "strings"), ("lengths", "longs"), ("roles", "strings"), ("texts", "strings"), ("copies", "longs"),
        ("blank", "long"), ("duplicate", "long"), ("truncated", "long"), ("illegal", "long"), ("first", "string"), ("last", "string"),
        ("low", "long"), ("high", "long"), ("turns", "long"), ("first_turn", "long"), ("last_turn", "long")]


def _cut(batches):
    """Sorted turns into parts; a part is a stretch of one conversation in one partition."""
    names = ("key", "turn", "role", "text", "n", "fault")
    task = TaskContext.get().partitionId() << 33

    def parts(rows):
        part = None
        for key, turn, role, text, n, fault in rows:
            if part and (part["key"] != key or len(part["roles"]) >= PART_TURNS or part["_chars"] + len(text) > PART_CHARS):
                yield part
                seq, part = part["part"] + 1, None
            elif not part:
                seq = task
            if part is None:
                part = {"key": key, "part": seq, "_marks": [], "roles": [], "texts": [], "copies": [], "_chars": 0, "blank": 0, "duplicate": 0,
                        "truncated": 0, "illegal": 0, "first": role[:1], "last": None, "low": turn, "high": turn, "turns": 0, "first_turn": turn}
            initial = role[:1]
            symbol = GONE if fault in ("blank", "duplicate") else initial if initial in ("s", "u", "a") else "?"
            if fault == "truncated":
                symbol = "!" if symbol == "?" else symbol.upper()
                part["truncated"] += 1
            part["_marks"] += [(symbol, 1), (GONE, n - 1)] if n > 1 else [(symbol, 1)]
            part["blank" if fault == "blank" else "duplicate"] += n if symbol == GONE else n - 1
            part["illegal"] += n - 1 + (part["last"] is not None and part["last"] + initial not in ("su", "ua", "au"))
            if turn is not None:
                part["low"] = turn if part["low"] is None else part["low"]
                part["turns"] += not part["roles"] or turn != part["last_turn"]
                part["high"] = turn
            part["last"], part["last_turn"] = initial, turn
            part["roles"].append(role)
            part["texts"].append(text)
            part["copies"].append(n)
            part["_chars"] += len(text)
        if part:
            yield part

    def sealed(part):
        runs = _collapsed(part.pop("_marks"))
        part["symbols"], part["lengths"] = [s for s, _ in runs], [n for _, n in runs]
        return part, part.pop("_chars")

    batches = iter(batches)
    head = next(batches, None)
    if head is None:
        return
    yield from _batches(map(sealed, parts(_rows(_again(head, batches), names))), _arrow(head.schema.field("key").type, *PART), 64)


def _again(head, batches):
    yield head
    yield from batches


def _stream(step, names, fields):
    """A pass over rows of (key, part) order that hands a state from one part of a conversation to the next."""
    def run(batches):
        batches = iter(batches)
        head = next(batches, None)
        if head is None:
            return

        def rows():
            key, state = None, None
            for row in _rows(_again(head, batches), names):
                if key is None or row[0] != key:
                    key, state = row[0], None
                out, state = step(state, *row)
                yield out, sum(len(x) for x in out.values() if isinstance(x, str))
        yield from _batches(rows(), _arrow(head.schema.field("key").type, *fields))
    return run


def _back(after, key, part, symbols, lengths):
    is_last, after = after is None, after or END
    before = applied(transition(tuple(zip(symbols, lengths))), after)
    return {"key": key, "part": part, "symbols": symbols, "lengths": lengths, "after": after, "is_last": int(is_last)}, before


def _forth(state, key, part, symbols, lengths, after, is_last):
    state, after, runs = state or 0, tuple(after), list(zip(symbols, lengths))
    before = applied(transition(tuple(runs)), after)[state]
    edits, behind = edits_of(runs, state, after)
    end = closing(behind) if is_last else ""
    return {"key": key, "part": part, "state": state, "edits": edits + end, "cost": before - after[behind] + INSERT * len(end)}, behind


def apply_edits(edits: str, state: int, roles: list, texts: list, copies: list) -> list:
    """The turns that the edits leave, from a state on."""
    out, rows = [], ((r, t) for r, t, n in zip(roles, texts, copies) for _ in range(n))
    for edit in edits:
        role, text = next(rows) if edit != "I" else (None, "")
        if edit == "D":
            continue
        state = KEEPS[role[0]][state] if edit == "K" else TAKES[state]
        out.append({"role": role if edit == "K" else ROLE[state], "text": text})
    return out


def repair(turns: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Repaired conversations in parts: one row per part of a conversation, by ``part`` in order.

    Columns: ``key``; part; state (before the part), edits (letters), repaired (role and text of each turn
    that is left); cost; blank, duplicate, truncated, illegal (counts inside the part); first and last
    (role initials), low, high, turns, first_turn and last_turn (of the turn numbers inside the part).

    Turns of a conversation are taken by number (nulls first), then role, then text. Rows with a null key
    are one conversation; a null role or text is one space; repeated rows are repeats; an empty table
    has no parts. Equal rows are counted before they meet, so no number of copies fills a task.
    Columns not named are not read.
    """
    kind = turns.schema[key].dataType.simpleString()
    rows = turns.select(F.struct(F.col(key).alias("v")).alias("key"), F.col(turn).cast("long").alias("turn"),
                        F.coalesce(F.col(role).cast("string"), F.lit(" ")).alias("role"),
                        F.coalesce(F.col(text).cast("string"), F.lit(" ")).alias("text"))
    rows = rows.groupBy("key", "turn", "role", "text").agg(F.count("*").alias("n"))
    said = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256)
    rows = rows.withColumn("said", said)
    firsts = (rows.groupBy("key", "said").agg(F.min(F.struct("turn")).alias("first_at"), F.count("*").alias("places")).where("places > 1")
              .select(F.col("key").alias("k"), F.col("said").alias("s"), "first_at"))
    rows = rows.join(firsts, (F.col("key") == F.col("k")) & (F.col("said") == F.col("s")), "left")
    bare = F.rtrim("text", F.lit(SPACE))
    fault = (F.when(bare == "", "blank").when(F.struct("turn") > F.col("first_at"), "duplicate")
             .when(~F.right(bare, F.lit(1)).isin(".", "!", "?"), "truncated").otherwise(""))
    rows = rows.select("key", "turn", "role", "text", "n", fault.alias("fault"))
    order = ["key", "turn", "role", "text"]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    parts = written(rows.mapInArrow(_cut, _ddl(kind, PART)), "conversation-parts")

    runs = parts.select("key", "part", "symbols", "lengths")
    fields = [("part", "long"), ("symbols", "strings"), ("lengths", "longs"), ("after", "longs"), ("is_last", "long")]
    behind = (runs.repartition("key").sortWithinPartitions("key", F.desc("part"))
              .mapInArrow(_stream(_back, ("key", "part", "symbols", "lengths"), fields), _ddl(kind, fields)))
    names, fields = ("key", *(n for n, _ in fields)), [("part", "long"), ("state", "long"), ("edits", "string"), ("cost", "long")]
    edits = (behind.repartition("key").sortWithinPartitions("key", "part")
             .mapInArrow(_stream(_forth, names, fields), _ddl(kind, fields)).withColumnsRenamed({"key": "k", "part": "p"}))
    whole = parts.join(edits, (F.col("key") == F.col("k")) & (F.col("part") == F.col("p")))

    keep = [f for f in PART if f[0] not in ("symbols", "lengths", "roles", "texts", "copies")]
    out = [("state", "long"), ("edits", "string"), ("repaired", "turns"), ("cost", "long")]

    def run(batches):
        for batch in batches:
            done = []
            for row in batch.to_pylist():
                left = apply_edits(row["edits"], row["state"], row["roles"], row["texts"], row["copies"])
                done.append(({n: row[n] for n in ("key", *(n for n, _ in keep), "state", "edits", "cost")} | {"repaired": left},
                             sum(len(t["text"]) for t in left)))
            yield from _batches(done, _arrow(batch.schema.field("key").type, *keep, *out))

    whole = whole.select("key", *(n for n, _ in PART if n not in ("symbols", "lengths")), "state", "edits", "cost")
    whole = whole.mapInArrow(run, _ddl(kind, keep + out))
    return whole.select(F.col("key.v").alias(key), *(F.col(n) for n, _ in keep + out))


def digests(parts: DataFrame, key: str = "conv_id") -> DataFrame:
    """One row per conversation of ``repair``'s parts: gaps, counts, cost, audit and the hash of the repaired turns.

    A hash over a conversation is sequential: its parts pass one task in order, one at a time. A gap count
    beyond the range of a long is the greatest long.
    """
    kind = parts.schema[key].dataType.simpleString()
    counts = ("blank", "duplicate", "truncated", "illegal", "cost")
    names = ("key", "edits", "repaired", *counts, "first", "last", "low", "high", "turns", "first_turn", "last_turn")
    fields = [("gaps", "long"), *((c, "long") for c in counts), ("audit", "string"), ("repaired_sha256", "string")]
    rows = parts.withColumn("key", F.struct(F.col(key).alias("v")))

    def closed(h):
        gaps = min(_GREATEST_LONG, h["high"] - h["low"] + 1 - h["turns"]) if h["turns"] else 0
        audit = "".join(h["edits"])
        return {"key": h["key"], "gaps": gaps, **{c: h[c] for c in counts}, "audit": audit, "repaired_sha256": h["digest"].hexdigest()}, len(audit)

    def conversations(rows):
        held = None
        for row in rows:
            now = dict(zip(names, row))
            if held is None or held["key"] != now["key"]:
                if held:
                    yield closed(held)
                held = {"key": now["key"], "edits": [], "digest": hashlib.sha256(), "any": False, "low": None, "high": None, "turns": 0,
                        "last": None, "last_turn": None, **dict.fromkeys(counts, 0)}
            for t in now["repaired"]:
                held["digest"].update((("\n" if held["any"] else "") + t["role"] + ":" + t["text"]).encode("utf-8", "surrogatepass"))
                held["any"] = True
            held["edits"].append(now["edits"])
            for c in counts:
                held[c] += now[c]
            held["illegal"] += held["last"] is not None and held["last"] + now["first"] not in ("su", "ua", "au")
            # A turn number on both sides of a cut counts once.
            held["turns"] += now["turns"] - (now["first_turn"] is not None and held["last_turn"] == now["first_turn"])
            held["low"] = now["low"] if held["low"] is None else held["low"]
            held["high"] = now["high"] if now["high"] is not None else held["high"]
            held["last"], held["last_turn"] = now["last"], now["last_turn"]
        if held:
            yield closed(held)

    def run(batches):
        batches = iter(batches)
        head = next(batches, None)
        if head is not None:
            yield from _batches(conversations(_rows(_again(head, batches), names)), _arrow(head.schema.field("key").type, *fields))

    out = (rows.select("part", *names).repartition("key").sortWithinPartitions("key", "part").drop("part")
           .mapInArrow(run, _ddl(kind, fields)))
    return out.select(F.col("key.v").alias(key), *(n for n, _ in fields))


def damaged(conversations: DataFrame) -> DataFrame:
    """``conversations`` with faults by crc32(``conv_id:turn``) mod 20: 0 drops a row, 1 empties its text, 2 removes
    its sentence ends, 3 repeats it, 4 sets its role to user; nulls read as one space."""
    def shown(c):
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), shown("role").alias("role"), shown("text").alias("text"),
                                (F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn"))) % 20).alias("fault")).where("fault <> 0")
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return rows.select("conv_id", "turn", F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
                       F.explode(F.sequence(F.lit(1), F.when(F.col("fault") == 3, 2).otherwise(1))).alias("copy")).drop("copy")


def repair_damaged(conversations: DataFrame) -> DataFrame:
    """The repair of every damaged conversation; one whose turns are all gone has zeros, no audit and the hash of nothing."""
    done = digests(repair(damaged(conversations))).withColumnRenamed("conv_id", "_done")
    out = conversations.select("conv_id").distinct().join(done, F.col("conv_id").eqNullSafe(F.col("_done")), "left")
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return out.select("conv_id", *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts), F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
