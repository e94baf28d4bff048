"""Conversation structure repair by generalised LR parsing with weighted edits.

The role initials of a repaired conversation are a word of `ROLES`, the grammar
C -> empty | P | s P,  P -> u a | P u a. Its LR automaton is built from the rules. All parses of a
conversation are kept at once in a graph-structured stack: a stack is a node (automaton state, node below), and equal
stacks are one node, whatever edits led to them. A row may be kept (its initial is shifted), reroled
to user or assistant, or deleted; a user or assistant may be inserted anywhere. Equal stack tops are
merged by minimum (cost, audit), where the audit holds the edits' initials in order. That is exact: of
two edit scripts of equal cost over the same rows neither is a prefix of the other, so what follows doesn't change their order.

Spark's part:

1. Rows are reduced to (conversation, turn, role, digest of the text, fault), equal rows to one with a
   count. A row is a duplicate if an equal role and text stood at an earlier turn, or beside it.
2. These lines are ranged by conversation and order, so a long conversation is shared out to many tasks, and parsed in
   segments of at most SEGMENT rows. A segment that may begin inside a conversation is parsed
   from every stack the grammar has; the result is a small table, stack before to stack after.
3. Segments are chained per conversation (sorted, streamed): what is held is an audit per stack.
4. The audits meet the texts, sorted by conversation and order and streamed through SHA-256. A digest of a
   whole conversation is one sequential computation; its task reads the rows, and holds the audit and one batch.

Order: by turn (nulls first); rows of one turn by role, then MD5 of the text, then text.

Edge cases: null conv_id is one conversation. Null role, text and (in the damage key) ids count as one space; a null
turn stays null in the order. Roles other than user, assistant and system have their first
character as initial, and an empty role has none; such rows are deleted or reroled. Very long texts are only
hashed. Repeated rows are duplicates of each other. `gaps` wraps at 64 bits. Extra columns are ignored. An empty table
gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import cut_lineage

#: The role grammar; the first rule's left side is the start symbol.
ROLES = (("C", ""), ("C", "P"), ("C", "sP"), ("P", "ua"), ("P", "Pua"))
NAMES = {"u": "user", "a": "assistant"}
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: Rows to a segment; bounds the audits that a segment's table holds.
SEGMENT = 4096
OK, TRUNCATION, BLANK, DUPLICATE = range(4)

Cost = tuple[int, str]


class Automaton:
    """LR(0) states of a grammar, with shifts and reductions."""

    def __init__(self, rules: Iterable[tuple[str, str]]) -> None:
        self.rules = tuple(rules)
        self.start = self.rules[0][0]
        self.heads = {head for head, _ in self.rules}
        first = self._closure({(i, 0) for i, (head, _) in enumerate(self.rules) if head == self.start})
        self.states, self.go = [first], [{}]
        for at, state in enumerate(self.states):  # grows while it is walked
            for symbol in sorted({self.rules[i][1][dot] for i, dot in state if dot < len(self.rules[i][1])}):
                moved = {(i, dot + 1) for i, dot in state if self.rules[i][1][dot : dot + 1] == symbol}
                target = self._closure(moved)
                if target not in self.states:
                    self.states.append(target)
                    self.go.append({})
                self.go[at][symbol] = self.states.index(target)
        done = [[self.rules[i] for i, dot in sorted(state) if dot == len(self.rules[i][1])] for state in self.states]
        self.reductions = [[r for r in rules if r[0] != self.start] for rules in done]
        self.accepting = [any(r[0] == self.start for r in rules) for rules in done]

    def _closure(self, items: set[tuple[int, int]]) -> frozenset[tuple[int, int]]:
        items, waiting = set(items), list(items)
        while waiting:
            i, dot = waiting.pop()
            symbol = self.rules[i][1][dot : dot + 1]
            for k, (head, _) in enumerate(self.rules):
                if head == symbol and (k, 0) not in items:
                    items.add((k, 0))
                    waiting.append((k, 0))
        return frozenset(items)


class Parser:
    """Stacks as shared nodes, numbered; `tops` maps a node's number to its (cost, audit)."""

    def __init__(self, rules=ROLES) -> None:
        self.lr = Automaton(rules)
        self.nodes: list[tuple[int | None, int]] = []
        self.numbers: dict[tuple[int | None, int], int] = {}
        self.bottom = self._node(None, 0)
        self.shifted: dict[tuple[int, str], tuple[int, ...]] = {}
        # Numbered before any parse, so that every task gives a stack the same number.
        self.stacks = self._stacks()

    def _node(self, below: int | None, state: int) -> int:
        key = (below, state)
        if key not in self.numbers:
            self.numbers[key] = len(self.nodes)
            self.nodes.append(key)
        return self.numbers[key]

    def shift(self, top: int, symbol: str) -> tuple[int, ...]:
        """The stacks after shifting the terminal `symbol` and all reductions that complete."""
        if (top, symbol) not in self.shifted:
            state = None if symbol in self.lr.heads else self.lr.go[self.nodes[top][1]].get(symbol)
            self.shifted[top, symbol] = () if state is None else tuple(self._reduced(self._node(top, state)))
        return self.shifted[top, symbol]

    def _reduced(self, top: int) -> list[int]:
        rules, state = self.lr.reductions[self.nodes[top][1]], self.lr.states[self.nodes[top][1]]
        out = []
        for head, body in rules:
            under = top
            for _ in body:
                under = self.nodes[under][0]
            out += self._reduced(self._node(under, self.lr.go[self.nodes[under][1]][head]))
        # A state whose items are all complete has nothing else to offer.
        return out if rules and len(rules) == len(state) else [top, *out]

    def _stacks(self) -> list[int]:
        """Every stack that some row of roles leads to; the grammar has finitely many."""
        found = [self.bottom]
        for top in found:
            for symbol in sorted({c for _, body in self.lr.rules for c in body} - self.lr.heads):
                found += [s for s in self.shift(top, symbol) if s not in found]
        return found

    def inserted(self, tops: dict[int, Cost]) -> dict[int, Cost]:
        """With any number of insertions."""
        out, waiting = dict(tops), list(tops)
        while waiting:
            top = waiting.pop()
            cost, audit = out[top]
            for symbol in NAMES:
                for after in self.shift(top, symbol):
                    merged = (cost + INSERT, audit + "I")
                    if after not in out or merged < out[after]:
                        out[after] = merged
                        waiting.append(after)
        return out

    def row(self, tops: dict[int, Cost], initial: str, fault: int) -> dict[int, Cost]:
        out: dict[int, Cost] = {}

        def merge(after: int, cost: int, audit: str) -> None:
            if after not in out or (cost, audit) < out[after]:
                out[after] = (cost, audit)

        for top, (cost, audit) in self.inserted(tops).items():
            merge(top, cost + DELETE, audit + "D")
            if fault >= BLANK:
                continue
            stays = cost + (TRUNCATED if fault == TRUNCATION else 0)
            for after in self.shift(top, initial):
                merge(after, stays, audit + "K")
            for symbol in NAMES:
                if symbol != initial:
                    for after in self.shift(top, symbol):
                        merge(after, stays + REROLE, audit + "R")
        return out

    def best(self, tops: dict[int, Cost]) -> Cost:
        return min(c for top, c in self.inserted(tops).items() if self.lr.accepting[self.nodes[top][1]])


@dataclass
class Segment:
    """What a run of a conversation's rows adds up to; turns and initials at its edges join it to its neighbours."""

    tables: list[tuple[int, int, int, str]]  # stack before, stack after, cost, audit
    first: str | None = None
    last: str | None = None
    low: int | None = None
    high: int | None = None
    turns: int = 0
    blank: int = 0
    duplicate: int = 0
    truncated: int = 0
    illegal: int = 0


_PAIRS = {"su", "ua", "au"}
_PARTS = (
    "at bigint, tables array<struct<before:int,after:int,cost:bigint,audit:string>>, first string, last string, low bigint, high bigint, "
    "turns bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint"
)
_FIELDS = [f.split()[0] for f in "first,last,low,high,turns,blank,duplicate,truncated,illegal".split(",")]
_LINE = ["conv_id", "turn", "initial", "fault", "n"]


class _Builder:
    """Rows in order, gathered into a Segment."""

    def __init__(self, parser: Parser, befores: list[int]) -> None:
        self.parser, self.found, self.rows = parser, Segment([]), 0
        self.tops = {b: {b: (0, "")} for b in befores}

    def add(self, turn: int | None, initial: str, fault: int) -> None:
        s = self.found
        if self.rows:
            s.illegal += s.last + initial not in _PAIRS
        else:
            s.first = initial
        s.last = initial
        if turn is not None:
            s.turns += s.high is None or turn != s.high
            s.low, s.high = turn if s.low is None else s.low, turn
        s.blank += fault == BLANK
        s.duplicate += fault == DUPLICATE
        s.truncated += fault == TRUNCATION
        self.tops = {b: self.parser.row(t, initial, fault) for b, t in self.tops.items()}
        self.rows += 1

    def segment(self) -> Segment:
        self.found.tables = [(b, a, c, text) for b, t in self.tops.items() for a, (c, text) in t.items()]
        return self.found


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments of ordered lines. The first conversation of a partition may have begun in an earlier one."""
    parser, builder, conv, seen, ready, at = Parser(), None, None, False, [], 0

    def cut() -> None:
        nonlocal builder, at
        if builder and builder.rows:
            ready.append((conv, at, builder.segment()))
            at += 1
        builder = None

    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in _LINE]
        for name, turn, initial, fault, n in zip(*columns):
            if not seen or name != conv:
                cut()
                # A conversation that starts inside this partition starts with an empty stack.
                builder = _Builder(parser, parser.stacks if not seen else [parser.bottom])
                conv, seen = name, True
            for i in range(n):
                if builder is None or builder.rows >= SEGMENT:
                    cut()
                    builder = _Builder(parser, parser.stacks)
                builder.add(turn, initial, fault if i == 0 or fault == BLANK else DUPLICATE)
        if len(ready) >= 256:
            yield _segments(ready)
            ready.clear()
    cut()
    if ready:
        yield _segments(ready)


def _segments(found: list[tuple[int | None, int, Segment]]) -> pa.RecordBatch:
    tables = pa.array(
        [[dict(zip(("before", "after", "cost", "audit"), t)) for t in s.tables] for _, _, s in found],
        pa.list_(pa.struct([("before", pa.int32()), ("after", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])),
    )
    kinds = [pa.string(), pa.string()] + [pa.int64()] * 7
    columns = [pa.array([getattr(s, f) for _, _, s in found], k) for f, k in zip(_FIELDS, kinds)]
    return pa.RecordBatch.from_arrays(
        [pa.array([c for c, _, _ in found], pa.int64()), pa.array([a for _, a, _ in found], pa.int64()), tables, *columns],
        ["conv_id", "at", "tables", *_FIELDS],
    )


_SUMS = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string"
_SUM_NAMES = [f.split()[0] for f in _SUMS.split(", ")]


class _Chain:
    """A conversation's segments, joined in order."""

    def __init__(self, parser: Parser) -> None:
        self.parser, self.total, self.tops = parser, Segment([]), {parser.bottom: (0, "")}

    def add(self, s: dict) -> None:
        t = self.total
        if t.last is not None:
            t.illegal += t.last + s["first"] not in _PAIRS
        t.last = s["last"]
        if s["low"] is not None:
            t.turns += s["turns"] - (t.high == s["low"])
            t.low, t.high = s["low"] if t.low is None else t.low, s["high"]
        for f in ("blank", "duplicate", "truncated", "illegal"):
            setattr(t, f, getattr(t, f) + s[f])
        after: dict[int, Cost] = {}
        for step in s["tables"]:
            if step["before"] in self.tops:
                cost, audit = self.tops[step["before"]]
                merged = (cost + step["cost"], audit + step["audit"])
                if step["after"] not in after or merged < after[step["after"]]:
                    after[step["after"]] = merged
        self.tops = after

    def sums(self) -> list:
        t = self.total
        gaps = 0 if t.low is None else (t.high - t.low + 1 - t.turns + 2**63) % 2**64 - 2**63
        return [gaps, t.blank, t.duplicate, t.truncated, t.illegal, *self.parser.best(self.tops)]


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums and audits of conversations from their segments in order; a null `at` only names a conversation."""
    parser, chain, conv, ready = Parser(), None, None, []

    def batch() -> pa.RecordBatch:
        kinds = [pa.int64()] * 7 + [pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*ready), kinds)], ["conv_id", *_SUM_NAMES])

    for found in batches:
        for s in found.to_pylist():
            if chain is None or s["conv_id"] != conv:
                if chain:
                    ready.append([conv, *chain.sums()])
                chain, conv = _Chain(parser), s["conv_id"]
            if s["at"] is not None:
                chain.add(s)
        if ready:
            yield batch()
            ready.clear()
    if chain:
        ready.append([conv, *chain.sums()])
        yield batch()


class Repaired:
    """The repaired role:text lines of one conversation, from its rows in order and its audit."""

    def __init__(self, audit: str) -> None:
        self.edits, self.role = iter(audit), ""

    def _next(self, role: str | None) -> str:
        self.role = role if role is not None else NAMES["a" if self.role[:1] == "u" else "u"]
        return self.role

    def lines(self, role: str, text: str) -> Iterator[str]:
        """The lines up to and with this row."""
        for edit in self.edits:
            if edit == "I":
                yield self._next(None) + ":"
                continue
            if edit != "D":
                yield self._next(role if edit == "K" else None) + ":" + text
            return

    def rest(self) -> Iterator[str]:
        for _ in self.edits:  # only insertions are left
            yield self._next(None) + ":"


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The result's rows: each conversation's sums come first, then its rows in order."""
    sums, repaired, sha, begun, ready = None, None, None, False, []

    def feed(lines: Iterable[str]) -> None:
        nonlocal begun
        for line in lines:
            sha.update((("\n" if begun else "") + line).encode())
            begun = True

    def close() -> None:
        feed(repaired.rest())
        ready.append([*sums, sha.hexdigest()])

    def batch() -> pa.RecordBatch:
        kinds = [pa.int64()] * 7 + [pa.string()] * 2
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*ready), kinds)], ["conv_id", *_SUM_NAMES, "repaired_sha256"])

    for found in batches:
        head = [found.column(c).to_pylist() for c in ("conv_id", *_SUM_NAMES)]
        for i, (row, role, text) in enumerate(zip(found.column("row").to_pylist(), found.column("role"), found.column("text"))):
            if not row:
                if sums is not None:
                    close()
                sums = [c[i] for c in head]
                repaired, sha, begun = Repaired(sums[-1]), hashlib.sha256(), False
            else:
                feed(repaired.lines(role.as_py(), text.as_py()))
        if ready:
            yield batch()
            ready.clear()
    if sums is not None:
        close()
        yield batch()


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text after the damage that crc32('conv_id:turn') % 20 asks for:
    0 drops a row, 1 empties its text, 2 removes its .!?, 3 repeats it, 4 makes its role user."""
    c = conversations
    space = F.lit(" ")
    conv, turn = c["conv_id"].cast("bigint"), c["turn"].cast("bigint")
    key = F.concat_ws(":", F.coalesce(conv.cast("string"), space), F.coalesce(turn.cast("string"), space))
    rows = c.select(
        conv.alias("conv_id"), turn.alias("turn"), F.coalesce(c["role"].cast("string"), space).alias("role"),
        F.coalesce(c["text"].cast("string"), space).alias("text"), (F.crc32(key.cast("binary")) % 20).alias("damage"),
    ).where("damage <> 0")
    text = F.when(F.col("damage") == 1, "").when(F.col("damage") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("damage") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.when(F.col("damage") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copy")).drop("copy")


def _order() -> list[Column]:
    return [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest")]


def lines(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, digest, initial, fault, n: equal rows of a turn as one. Stored."""
    kept = F.rtrim(F.translate("text", "\t\n\x0b\x0c\r", "     "))
    fault = F.when(kept == "", BLANK).when(F.substring(kept, -1, 1).isin(".", "!", "?"), OK).otherwise(TRUNCATION)
    digest = F.md5(F.col("text").cast("binary"))
    narrow = rows.select("conv_id", "turn", "role", digest.alias("digest"), fault.alias("own"))
    merged = narrow.groupBy("conv_id", "turn", "role", "digest").agg(F.min("own").alias("own"), F.count(F.lit(1)).alias("n"))
    # What conversation, role and text are equal; the parts' lengths keep them apart.
    same = F.md5(F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), F.lit("")), F.length("role").cast("string"), "role", "digest").cast("binary"))
    merged = cut_lineage(merged.withColumn("same", same), "turns")
    place = F.struct(F.col("turn").isNotNull().alias("p"), F.col("turn").alias("t"))
    # Only what occurs at several turns has later ones; the rest needs no join.
    first = merged.groupBy("same").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("turns")).where("turns > 1")
    first = cut_lineage(first.select("same", "first"), "first-turns")
    # A text that fills a conversation has many rows with one key: the firsts are repeated for each salt.
    salts = 16
    spread = first.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    salt = F.pmod(F.xxhash64("conv_id", "turn", "role", "digest"), F.lit(salts)).cast("int")
    joined = merged.withColumn("salt", salt).join(spread, ["same", "salt"], "left")
    later = F.coalesce(place > F.col("first"), F.lit(False))
    fault = F.when(F.col("own") == BLANK, BLANK).when(later, DUPLICATE).otherwise(F.col("own"))
    return joined.select("conv_id", "turn", "role", "digest", F.substring("role", 1, 1).alias("initial"), fault.alias("fault"), "n")


def audits(rows: DataFrame, conversations: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit of every original conversation. Stored."""
    ordered = lines(rows).repartitionByRange(*_order()).sortWithinPartitions(*_order())
    segments = ordered.select(*_LINE).mapInArrow(_parsed, "conv_id bigint, " + _PARTS)
    segments = segments.withColumn("part", F.spark_partition_id())
    names = conversations.select(conversations["conv_id"].cast("bigint").alias("conv_id")).distinct()
    both = segments.unionByName(names.withColumn("part", F.lit(-1)), allowMissingColumns=True)
    chained = both.repartition("conv_id").sortWithinPartitions(F.col("conv_id").asc_nulls_first(), "part", "at")
    return cut_lineage(chained.drop("part").mapInArrow(_chained, "conv_id bigint, " + _SUMS), "audits")


def decide(conversations: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 of every
    original conv_id, after `damaged`."""
    return repair(damaged(conversations), conversations)


def repair(rows: DataFrame, conversations: DataFrame) -> DataFrame:
    """The same for given rows (conv_id, turn, role, text without nulls but in ids and turns)."""
    sums = audits(rows, conversations).withColumn("row", F.lit(False))
    texts = rows.select("conv_id", "turn", "role", "text", F.md5(F.col("text").cast("binary")).alias("digest"), F.lit(True).alias("row"))
    both = sums.unionByName(texts, allowMissingColumns=True).repartition("conv_id")
    ordered = both.sortWithinPartitions(F.col("conv_id").asc_nulls_first(), "row", F.col("turn").asc_nulls_first(), "role", "digest")
    return ordered.select("conv_id", *_SUM_NAMES, "row", "role", "text").mapInArrow(_hashed, "conv_id bigint, " + _SUMS + ", repaired_sha256 string")


def repaired_rows(rows: DataFrame, conversations: DataFrame) -> DataFrame:
    """conv_id, position, role, text of the repaired conversations."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, repaired, position, out = None, None, 0, []

        def feed(made: Iterable[str]) -> None:
            nonlocal position
            for line in made:
                # Roles and texts may hold colons: split by the role's length.
                out.append((conv, position, repaired.role, line[len(repaired.role) + 1 :]))
                position += 1

        for found in batches:
            for r in found.to_pylist():
                if r["row"]:
                    feed(repaired.lines(r["role"], r["text"]))
                    continue
                if repaired:
                    feed(repaired.rest())
                conv, repaired, position = r["conv_id"], Repaired(r["audit"]), 0
            yield _rows(out)
            out.clear()
        if repaired:
            feed(repaired.rest())
            yield _rows(out)

    sums = audits(rows, conversations).select("conv_id", "audit", F.lit(False).alias("row"))
    texts = rows.select("conv_id", "turn", "role", "text", F.md5(F.col("text").cast("binary")).alias("digest"), F.lit(True).alias("row"))
    both = sums.unionByName(texts, allowMissingColumns=True).repartition("conv_id")
    ordered = both.sortWithinPartitions(F.col("conv_id").asc_nulls_first(), "row", F.col("turn").asc_nulls_first(), "role", "digest")
    return ordered.select("conv_id", "audit", "row", "role", "text").mapInArrow(run, "conv_id bigint, position bigint, role string, text string")


def _rows(out: list[tuple]) -> pa.RecordBatch:
    kinds = [("conv_id", pa.int64()), ("position", pa.int64()), ("role", pa.string()), ("text", pa.string())]
    columns = list(zip(*out)) if out else [[]] * 4
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, (_, k) in zip(columns, kinds)], [n for n, _ in kinds])
