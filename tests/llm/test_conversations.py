"""Conversation repair against a search over (cost, audit) pairs row by row."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from martloom.llm import conversation_repair as cr
from martloom.llm.queries import QUERIES

BLANK = re.compile(r"[^\x20\x09-\x0D]")


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (2 if kind == 3 else 1)
    return out


def faults_of(rows):
    seen, out = set(), []
    for _, role, text in rows:
        solid = BLANK.findall(text)
        out.append("blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(rows, faults):
    """Least (cost, audit) by recursion over rows and role initials so far; inserts come at most twice in a row."""
    n = len(rows)

    def legal(last, role):
        return (role == "s" and last == "") or (role == "u" and last != "u") or (role == "a" and last == "u")

    table = {}
    for i in range(n, -1, -1):
        for inserts in (2, 1, 0):
            for last in ("", "s", "u", "a"):
                options = []
                if i == n and last in ("", "a"):
                    options.append((0, ""))
                if inserts < 2:
                    for role in "ua":
                        if legal(last, role):
                            c, a = table[i, inserts + 1, role]
                            options.append((c + 5, "I" + a))
                if i < n:
                    c, a = table[i + 1, 0, last]
                    options.append((c + 2, "D" + a))
                    if faults[i] not in ("blank", "duplicate"):
                        extra = 5 if faults[i] == "truncated" else 0
                        role = rows[i][1][:1]
                        if legal(last, role):
                            c, a = table[i + 1, 0, role]
                            options.append((c + extra, "K" + a))
                        for role in "ua":
                            if legal(last, role):
                                c, a = table[i + 1, 0, role]
                                options.append((c + extra + 1, "R" + a))
                table[i, inserts, last] = min(options, default=(10**9, ""))
    return table[0, 0, ""]


def repaired_of(rows, audit):
    out, last, i = [], "", 0
    for letter in audit:
        need = "assistant" if last == "u" else "user"
        if letter == "I":
            out.append((None, need, ""))
        else:
            if letter != "D":
                out.append((rows[i][0], need if letter == "R" else rows[i][1], rows[i][2]))
            i += 1
        last = out[-1][1][0] if out else ""
    return out


def by_rule(rows, everyone):
    """All rows must have different turns or equal content within a turn."""
    found = {}
    for conv in everyone:
        mine = sorted(((t, r, x) for c, t, r, x in rows if c == conv), key=lambda x: (x[0] is not None, x[0] or 0))
        faults = faults_of(mine)
        turns = [t for t, _, _ in mine if t is not None]
        cost, audit = cheapest(mine, faults)
        fixed = repaired_of(mine, audit)
        initials = [r[:1] for _, r, _ in mine]
        assert re.fullmatch("(s?(ua)+)?", "".join(r[0] for _, r, _ in fixed))
        found[conv] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
            cost,
            audit,
            hashlib.sha256("\n".join(f"{r}:{x}" for _, r, x in fixed).encode()).hexdigest(),
        )
    return found


def got(df):
    names = [c.split()[0] for c in cr.SUMMARY_ROW.split(", ")]
    rows = df.select(*names).collect()
    assert len({r.conv_id for r in rows}) == len(rows)
    return {r.conv_id: tuple(r)[1:] for r in rows}


SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def conversations(seed, lengths):
    draw = random.Random(seed)
    rows = []
    for conv, length in enumerate(lengths):
        for turn in range(length):
            role = draw.choice(["system", "user", "assistant", "assistant", "user", "tool", "User", "umpire", " "])
            text = draw.choice(["Yes.", "No!", "Why", "What? ", "", " \n", f"Number {turn}.", f"cut {turn}", f"Is it {draw.random()}?"])
            rows.append((conv, turn * 3 + draw.choice([0, 0, 1]), role, text))
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize("rows_a_part", [cr.ROWS_A_PART, 7])
def test_random_conversations(spark, rows_a_part):
    rows = conversations(5, [1, 2, 3, 4, 5, 6, 7, 8, 9] * 12 + [250])
    df = spark.createDataFrame(rows, SCHEMA)
    assert got(cr.summaries(df, rows_a_part=rows_a_part)) == by_rule(rows, {r[0] for r in rows})


def test_a_conversation_over_many_parts(spark):
    rows = conversations(11, [1500, 3, 0, 2])
    df = spark.createDataFrame(rows, SCHEMA)
    assert got(cr.summaries(df, rows_a_part=40)) == by_rule(rows, {r[0] for r in rows})


def test_repaired_rows(spark):
    rows = conversations(3, [6, 1, 9, 40])
    df = spark.createDataFrame(rows, SCHEMA)
    wanted = {}
    for conv in {r[0] for r in rows}:
        mine = sorted((t, r, x) for c, t, r, x in rows if c == conv)
        wanted[conv] = repaired_of(mine, cheapest(mine, faults_of(mine))[1])
    found = {}
    for r in cr.repaired(df).orderBy("conv_id", "place").collect():
        assert r.place == len(found.setdefault(r.conv_id, []))
        found[r.conv_id].append((r.turn, r.role, r.text))
    assert found == {c: x for c, x in wanted.items() if x}


def test_nulls_ties_and_clashing_columns(spark):
    long = "A very long text. " * 40_000
    rows = [
        (1, None, "user", "Before all."), (1, 0, None, "Without a role."), (1, 1, "assistant", None), (1, 2, "", "No role."), (1, 3, "user", long),
        (None, 0, "user", "Nobody's."), (None, None, "system", "Rules."), (None, 1, "assistant", "Fine."),
        (2, None, "user", "Same."), (2, None, "user", "Same."), (2, 4, "assistant", "Same."), (2, 4, "assistant", "Same."),
        (3, -(1 << 63), "user", "First."), (4, 1, "system", "Alone."),
    ]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in ("pos", "part", "code", "fault", "kind", "letter", "copy", "high", "conv_key")})
    asked = [tuple(" " if v is None and k > 1 else (v or " ") if k == 2 else v for k, v in enumerate(r)) for r in rows]
    for size in (cr.ROWS_A_PART, 2):
        assert got(cr.summaries(df, rows_a_part=size)) == by_rule(asked, {r[0] for r in rows})
    hurt = cr.damaged(df)
    assert hurt.columns == ["conv_id", "turn", "role", "text"]
    assert got(cr.summaries(hurt, df)) == by_rule([(c, t, r or " ", x) for c, t, r, x in damage(rows)], {r[0] for r in rows})


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert got(cr.summaries(cr.damaged(df), df)) == {}
    assert cr.repaired(df).count() == 0
    gone = spark.createDataFrame([(7, 1, "user", "Hi.")], SCHEMA)
    assert got(cr.summaries(gone.where("false"), gone)) == {7: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


@pytest.mark.parametrize("size", ["0.001", "0.01"])
def test_query(spark, size):
    sf_dir = f"/root/testdata/sf{size}"
    table = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert got(QUERIES["op13_conversation_repair"](spark, sf_dir)) == by_rule(damage(table), {r[0] for r in table})
