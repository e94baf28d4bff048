import hashlib
import itertools
import random
import re
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from mergeloom.llm import repair, sqls

SPACES = " \t\n\x0b\x0c\r"
SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def order(row):
    conv, turn, role, text = row
    return (turn is not None, turn or 0, role, hashlib.md5(text.encode()).hexdigest(), text)


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        key = ":".join(" " if x is None else str(x) for x in (conv, turn))
        kind = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        row = (conv, turn, "user" if kind == 4 else role, text)
        out += [] if kind == 0 else [row, row] if kind == 3 else [row]
    return out


def cheapest(rows, faults):
    """Least (cost, audit, lines) over all edit scripts, by dynamic programming over what the result ends in."""
    ends = {"": {"u": "u", "s": "s"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    best = {"": (0, "", ())}

    def keep(table, state, value):
        if state not in table or value < table[state]:
            table[state] = value

    def insert(table):
        for _ in range(3):
            for state, (cost, audit, lines) in list(table.items()):
                for c in "ua":
                    if c in ends[state]:
                        keep(table, c, (cost + 5, audit + "I", (*lines, {"u": "user:", "a": "assistant:"}[c])))

    for (_, _, role, text), fault in zip(rows, faults):
        insert(best)
        after = {}
        for state, (cost, audit, lines) in best.items():
            keep(after, state, (cost + 2, audit + "D", lines))
            if fault in ("blank", "duplicate"):
                continue
            more = 5 if fault == "truncated" else 0
            if role[:1] in ends[state]:
                keep(after, role[:1], (cost + more, audit + "K", (*lines, role + ":" + text)))
            for new in ("user", "assistant"):
                if new[0] in ends[state] and new[0] != role[:1]:
                    keep(after, new[0], (cost + more + 1, audit + "R", (*lines, new + ":" + text)))
        best = after
    insert(best)
    return min(v for k, v in best.items() if k in ("", "a"))


def model(original):
    rows, out = damage(original), []
    for conv in {r[0] for r in original}:
        mine = sorted((r for r in rows if r[0] == conv), key=order)
        seen, faults = set(), []
        for _, _, role, text in mine:
            bare = text.strip(SPACES)
            faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
            seen.add((role, text))
        turns = {r[1] for r in mine} - {None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(mine, mine[1:]))
        cost, audit, lines = cheapest(mine, faults)
        sha = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out.append((conv, gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, sha))
    return sorted(out, key=str)


def awkward():
    r = random.Random(3)
    texts = ["Yes.", "No", "  \n", "", "Why?", "a: b\nc.", "Très bien!", None, "Yes.", "x" * 50000 + "."]
    roles = ["user", "assistant", "system", "user", "assistant", "user", "assistant", "tool", "Person", "", None]
    rows = []
    for conv in [*range(60), None]:
        for i in range(r.choice([1, 2, 4, 6, 9, 14])):
            turn = r.choice([i, i, i, i, i + 2, 0, None])
            good = ["system", "user", "assistant"][i if i < 1 and r.random() < 0.3 else 1 + i % 2]
            rows.append((conv, turn, good if r.random() < 0.7 else r.choice(roles), r.choice(texts) if r.random() < 0.4 else f"Turn {i} of {conv}."))
    rows += rows[:7]  # repeated rows
    rows += [(1000, None, "user", "Hm."), (1000, None, None, None), (1001, -(2**62), "user", "a."), (1001, 2**62, "assistant", "b.")]
    dropped = next(i for i in range(2000, 3000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    return rows + [(dropped, 0, "user", "Gone.")]


def frame(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("cost", "audit", "damage", "digest", "n", "part", "at", "row", "same", "salt", "first", "initial"):
        df = df.withColumn(name, F.lit("clash"))
    return df


def test_against_the_model(spark):
    rows = awkward()
    got = repair.decide(frame(spark, rows))
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    found, want = sorted(map(tuple, got.collect()), key=str), model(rows)
    for a, b in zip(found, want):
        assert a == b
    assert len(found) == len(want) and len({w[6] for w in want}) > 5
    assert repair.decide(frame(spark, [])).count() == 0


def test_sql_says_the_same(spark, sf):
    con = duckdb.connect()
    rows = [r for r in awkward() if r[0] != 1001]
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    assert sorted(con.execute(sqls.sql()["op12_conversation_repair"]).fetchall(), key=str) == model(rows)
    given = spark.read.parquet(f"{sf}/conversations.parquet")
    rows = [tuple(r) for r in given.select("conv_id", "turn", "role", "text").collect()]
    assert sorted(map(tuple, repair.decide(given).collect()), key=str) == model(rows)


@pytest.mark.parametrize("parts", [1, 7])
def test_a_long_conversation_is_split(spark, monkeypatch, parts):
    """Segments and ranges of one conversation join to what the whole would give."""
    r = random.Random(parts)
    rows = [(5, i, r.choice(["user", "assistant", "user", "assistant", "system"]), f"Turn {i}" + r.choice([".", ".", ".", ""])) for i in range(700)]
    rows += [(5, 3000 + i, "user", "Again.") for i in range(40)] + [(6, i, ["user", "assistant"][i % 2], f"{i}.") for i in range(9)]
    monkeypatch.setattr(repair, "SEGMENT", 16)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        small = spark.newSession()
        small.conf.set("spark.sql.shuffle.partitions", str(parts))
        assert sorted(map(tuple, repair.decide(small.createDataFrame(rows, SCHEMA)).collect()), key=str) == model(rows)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_all_edit_scripts_of_short_conversations():
    """The parse equals the least over every script, enumerated."""
    parser = repair.Parser()

    def scripts(initials, faults):
        choices = []
        for x, fault in zip(initials, faults):
            more = 5 if fault == repair.TRUNCATION else 0
            mine = [("D", 2, "")]
            if fault < repair.BLANK:
                mine += [("K", more, x)] + [("R", 1 + more, y) for y in "ua" if y != x]
            choices.append(mine)
        gaps = ["", "u", "a", "ua", "au"]
        for edits in itertools.product(*choices):
            for ins in itertools.product(gaps, repeat=len(initials) + 1):
                word = ins[0] + "".join(e[2] + i for e, i in zip(edits, ins[1:]))
                if re.fullmatch("(s?(ua)+)?", word):
                    yield sum(e[1] for e in edits) + 5 * sum(map(len, ins)), "I" * len(ins[0]) + "".join(e[0] + "I" * len(i) for e, i in zip(edits, ins[1:]))

    for n in (0, 1, 2, 3):
        for initials in itertools.product("suat", repeat=n):
            for faults in itertools.product(*[(repair.OK, repair.TRUNCATION, repair.BLANK)[: 3 if n < 3 else 2]] * n):
                tops = {parser.bottom: (0, "")}
                for x, fault in zip(initials, faults):
                    tops = parser.row(tops, x, fault)
                assert parser.best(tops) == min(scripts(initials, faults)), (initials, faults)
    assert parser.row({parser.bottom: (0, "")}, "P", repair.OK)[parser.bottom] == (2, "D")


def test_repaired_rows(spark):
    rows = awkward()
    given = frame(spark, rows)
    made = repair.repaired_rows(repair.damaged(given), given).collect()
    for conv, *_, sha in model(rows):
        mine = sorted((r for r in made if r.conv_id == conv), key=lambda r: r.position)
        assert [r.position for r in mine] == list(range(len(mine)))
        assert hashlib.sha256("\n".join(f"{r.role}:{r.text}" for r in mine).encode()).hexdigest() == sha
        assert re.fullmatch("(s?(ua)+)?", "".join(r.role[:1] for r in mine))
