"""Conversations repaired by generalised LR parsing.

A role grammar says which orders of roles are legal. Its SLR tables are built here; where
an action is ambiguous all of them are followed. Stacks share their tails: a stack is a
state on top of another stack, and equal stacks are one. For each stack the cheapest
edits that lead to it are kept, the least audit among equally cheap ones; so a row costs
a bounded number of steps, as a left-recursive grammar has few stacks.

Edits of a row: Keep, Rerole, Delete; between rows: Insert. Faulty rows (blank, or equal
in role and text to an earlier row of the conversation) must be deleted; truncated ones
cost more if they stay.

How it is spread: faults are found on slim rows (a digest for the text), equal rows of a
turn counted before they are shuffled. The parser reads a conversation's slim rows in
order and holds its stacks and their audits, one letter a row. Texts are shuffled
once, to be read in order beside their audit; none is held. A conversation is read by one
task, as its order, and the digest of its repaired text, are sequential, but in bounded
memory but for the audit.

Defined results: a null role or text is one space; a null conv_id is a conversation; null
turns come first, and rows of one turn are ordered by role and digest of the text.
Repeated rows are duplicates. Roles are known by their first character; an empty role is
legal nowhere. Equal digests (SHA-256) count as equal texts. An empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import materialize

SPACES = " \t\n\x0b\f\r"
ENDS = (".", "!", "?")
ROLES = ("user", "assistant")  # for rows that are inserted or get another role
GRAMMAR = (("talk", ()), ("talk", ("s", "turns")), ("talk", ("turns",)), ("turns", ("turns", "u", "a")), ("turns", ("u", "a")))
FOLLOWING = ("su", "ua", "au")
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
CHUNK = 1 << 11


class Grammar:
    """SLR tables of a grammar whose first rule's left side is the start."""

    END = "$"

    def __init__(self, rules: tuple[tuple[str, tuple[str, ...]], ...]):
        self.rules = [("", (rules[0][0],)), *rules]
        self.heads = {head for head, _ in self.rules}
        follow = self._follow()
        index: dict[frozenset, int] = {}
        states: list[frozenset] = []
        self.moves: list[dict[str, int]] = []
        self.reduces: list[dict[str, list[int]]] = []

        def state(items: frozenset) -> int:
            if items not in index:
                index[items] = len(states)
                states.append(items)
            return index[items]

        state(self._closure({(0, 0)}))
        for at in range(1 << 20):
            if at == len(states):
                break
            by_symbol: dict[str, set] = {}
            reduces: dict[str, list[int]] = {}
            for rule, dot in states[at]:
                head, body = self.rules[rule]
                if dot < len(body):
                    by_symbol.setdefault(body[dot], set()).add((rule, dot + 1))
                else:
                    for symbol in follow[head]:
                        reduces.setdefault(symbol, []).append(rule)
            self.moves.append({symbol: state(self._closure(items)) for symbol, items in sorted(by_symbol.items())})
            self.reduces.append(reduces)
        # stacks: a state and the stack below; number 0 is the start alone
        self.state, self.below, self.number = [0], [-1], {(0, -1): 0}
        self.known: dict[tuple[int, str], tuple[int, ...]] = {}

    def _closure(self, items: set) -> frozenset:
        work, out = list(items), set(items)
        while work:
            rule, dot = work.pop()
            body = self.rules[rule][1]
            if dot < len(body) and body[dot] in self.heads:
                for k, (head, _) in enumerate(self.rules):
                    if head == body[dot] and (k, 0) not in out:
                        out.add((k, 0))
                        work.append((k, 0))
        return frozenset(out)

    def _follow(self) -> dict[str, set[str]]:
        empty: set[str] = set()
        first: dict[str, set[str]] = {head: set() for head in self.heads}
        follow: dict[str, set[str]] = {head: set() for head in self.heads}
        follow[""] = {self.END}
        size = -1
        while size != (size := len(empty) + sum(map(len, first.values())) + sum(map(len, follow.values()))):
            for head, body in self.rules:
                if all(x in empty for x in body):
                    empty.add(head)
                for x in body:
                    first[head] |= first.get(x, {x})
                    if x not in empty:
                        break
                for k, x in enumerate(body):
                    if x in self.heads:
                        for y in body[k + 1 :]:
                            follow[x] |= first.get(y, {y})
                            if y not in empty:
                                break
                        else:
                            follow[x] |= follow[head]
        return follow

    def _push(self, state: int, below: int) -> int:
        if (state, below) not in self.number:
            self.number[state, below] = len(self.state)
            self.state.append(state)
            self.below.append(below)
        return self.number[state, below]

    def after(self, stack: int, symbol: str) -> tuple[int, ...]:
        """Stacks reached by the symbol, after any reductions that it allows; at the end, those that accept."""
        if (stack, symbol) not in self.known:
            work, seen, out = [stack], {stack}, []
            while work:
                top = work.pop()
                state = self.state[top]
                if symbol in self.moves[state] and symbol not in self.heads:
                    out.append(self._push(self.moves[state][symbol], top))
                for rule in self.reduces[state].get(symbol, ()):
                    head, body = self.rules[rule]
                    if rule == 0:
                        out.append(top)
                        continue
                    below = top
                    for _ in body:
                        below = self.below[below]
                    reduced = self._push(self.moves[self.state[below]][head], below)
                    if reduced not in seen:
                        seen.add(reduced)
                        work.append(reduced)
            self.known[stack, symbol] = tuple(out)
        return self.known[stack, symbol]


class Audit:
    """Letters of edits; long ones share what is older than their last chunk."""

    __slots__ = ("older", "last", "roles")

    def __init__(self, older=None, last: str = "", roles=None):
        self.older, self.last, self.roles = older, last, roles

    def then(self, letter: str, role: str = "") -> "Audit":
        """``roles`` are those given by Rerole and Insert, newest first."""
        roles = (self.roles, role) if role else self.roles
        if len(self.last) < CHUNK:
            return Audit(self.older, self.last + letter, roles)
        return Audit((self.older, self.last), letter, roles)

    def text(self) -> str:
        parts, older = [self.last], self.older
        while older is not None:
            older, part = older
            parts.append(part)
        return "".join(reversed(parts))

    def given(self) -> str:
        out, rest = [], self.roles
        while rest is not None:
            rest, role = rest
            out.append(role)
        return "".join(reversed(out))

    def before(self, other: "Audit") -> bool:
        if self.older is other.older:
            a, b = self.last, other.last
        else:
            a, b = self.text(), other.text()
        return a < b or a == b and self.given() < other.given()


class Parser:
    """The cheapest edits of a conversation, a row at a time."""

    def __init__(self, grammar: Grammar, roles: tuple[str, ...] = ROLES):
        self.grammar, self.initials = grammar, [r[:1] for r in roles]
        self.tops: dict[int, tuple[int, Audit]] = {0: (0, Audit())}
        self._insert()

    @staticmethod
    def _offer(tops: dict, stack: int, cost: int, old: Audit, letter: str, role: str = "") -> bool:
        now = tops.get(stack)
        if now is not None and now[0] < cost:
            return False
        audit = old.then(letter, role)
        if now is not None and now[0] == cost and not audit.before(now[1]):
            return False
        tops[stack] = cost, audit
        return True

    def _insert(self) -> None:
        work = list(self.tops)
        while work:
            changed = {}
            for stack in work:
                cost, audit = self.tops[stack]
                for role in self.initials:
                    for after in self.grammar.after(stack, role):
                        if self._offer(self.tops, after, cost + INSERT, audit, "I", role):
                            changed[after] = True
            work = list(changed)

    def row(self, initial: str, faulty: bool, truncated: bool) -> None:
        tops: dict[int, tuple[int, Audit]] = {}
        extra = TRUNCATED * truncated
        for stack, (cost, audit) in self.tops.items():
            self._offer(tops, stack, cost + DELETE, audit, "D")
            if faulty:
                continue
            for after in self.grammar.after(stack, initial):
                self._offer(tops, after, cost + extra, audit, "K")
            for role in self.initials:
                if role != initial:
                    for after in self.grammar.after(stack, role):
                        self._offer(tops, after, cost + extra + REROLE, audit, "R", role)
        self.tops = tops
        self._insert()

    def end(self) -> tuple[int, str, str]:
        """Cost, audit, and the initials given to reroled and inserted rows in order."""
        best = None
        for stack, (cost, audit) in self.tops.items():
            if self.grammar.after(stack, Grammar.END):
                if best is None or cost < best[0] or cost == best[0] and audit.before(best[1]):
                    best = cost, audit
        return best[0], best[1].text(), best[1].given()


# Damage, as given


def damaged(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, copies: rows damaged by the remainder of a checksum; lost rows have 0 copies."""
    named = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(named("conv_id"), F.lit(":"), named("turn")).cast("binary")) % 20
    coded = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), named("role").alias("role"), named("text").alias("text"), kind.alias("kind")
    )
    return coded.select(
        "conv_id",
        "turn",
        F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind").isin(0, 1), "").when(F.col("kind") == 2, F.translate("text", "".join(ENDS), "")).otherwise(F.col("text")).alias("text"),
        F.when(F.col("kind") == 0, 0).when(F.col("kind") == 3, 2).otherwise(1).cast("long").alias("copies"),
    )


# Repair


def _last_character(text: str) -> Column:
    return F.substring(F.rtrim(text, F.lit(SPACES)), -1, 1)


def _code(text: str) -> Column:
    return F.sha2(F.col(text).cast("binary"), 256)


def slim(rows: DataFrame) -> DataFrame:
    """One row per conversation, turn, role and text, how often it comes, and its faults."""
    last = _last_character("text")
    # a lost row stands for its conversation only
    coded = rows.select("conv_id", "turn", "role", _code("text").alias("code"), last.alias("last"), "copies")
    counted = coded.groupBy("conv_id", "turn", "role", "code", "last").agg(F.sum("copies").alias("copies"))
    seen = Window.partitionBy("conv_id", "role", "code").orderBy(F.col("turn").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    return counted.select(
        "conv_id",
        "turn",
        "role",
        "code",
        "copies",
        (F.col("last") == "").alias("blank"),
        (F.coalesce(F.sum("copies").over(seen), F.lit(0)) > 0).alias("again"),
        (~F.col("last").isin(*ENDS)).alias("cut"),
    )


_PARSED = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, given string"


def _parse(grammar: Grammar, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = _PARSED.replace(" long", "").replace(" string", "").split(", ")
    now, begun, out = None, False, []

    class Conversation:
        def __init__(self, conv_id):
            self.conv_id, self.parser, self.before = conv_id, Parser(grammar), None
            self.low = self.high = None
            self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0

        def add(self, turn, role, copies, blank, again, cut):
            initial = role[:1]
            if turn is not None and turn != self.high:  # sorted
                self.low = turn if self.low is None else self.low
                self.high, self.turns = turn, self.turns + 1
            for k in range(copies):
                if self.before is not None and self.before + initial not in FOLLOWING:
                    self.illegal += 1
                self.before = initial
                twice = again or k > 0
                self.blank += blank
                self.duplicate += twice and not blank
                self.truncated += cut and not twice and not blank
                self.parser.row(initial, blank or twice, cut)

        def result(self):
            gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
            return (self.conv_id, gaps, self.blank, self.duplicate, self.truncated, self.illegal, *self.parser.end())

    def flushed():
        return pa.RecordBatch.from_arrays([pa.array(c, pa.string() if k > 6 else pa.int64()) for k, c in enumerate(zip(*out))], names=names)

    for batch in batches:
        for conv_id, *rest in zip(*(batch.column(k).to_pylist() for k in range(batch.num_columns))):
            if not begun or conv_id != now.conv_id:
                if begun:
                    out.append(now.result())
                now, begun = Conversation(conv_id), True
            if rest[2]:
                now.add(*rest)
        if len(out) > 1000:
            yield flushed()
            out = []
    if begun:
        out.append(now.result())
    if out:
        yield flushed()


def parse(rows: DataFrame, rules=GRAMMAR) -> DataFrame:
    """One row per conversation of ``rows`` (as from ``damaged``): its faults, and cost, audit and given roles of its repair."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _parse(Grammar(rules), batches)

    ordered = slim(rows).repartition("conv_id").sortWithinPartitions(
        F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "code"
    )
    return ordered.select("conv_id", "turn", "role", "copies", "blank", "again", "cut").mapInArrow(run, _PARSED)


def repaired(rows: DataFrame, parsed: DataFrame, roles: tuple[str, ...] = ROLES) -> DataFrame:
    """conv_id, place, role, text of the repaired conversations; each is in one partition, in order."""
    full = {r[:1]: r for r in roles}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters, given, at, used, place = "", "", 0, 0, 0
        conv, begun = None, False

        def inserted():
            nonlocal at, used, place
            while at < len(letters) and letters[at] == "I":
                out.append((conv, place, full[given[used]], ""))
                at, used, place = at + 1, used + 1, place + 1

        for batch in batches:
            out = []
            for conv_id, copies, role, text, audit, some in zip(*(batch.column(k).to_pylist() for k in range(6))):
                if audit is not None:  # comes before the rows of its conversation
                    conv, begun, letters, given, at, used, place = conv_id, True, audit, some, 0, 0, 0
                    inserted()
                    continue
                for _ in range(copies):
                    letter, at = letters[at], at + 1
                    if letter != "D":
                        if letter == "R":
                            role, used = full[given[used]], used + 1
                        out.append((conv_id, place, role, text))
                        place += 1
                    inserted()
            if out:
                columns = zip(("conv_id", "place", "role", "text"), (pa.int64(), pa.int64(), pa.string(), pa.string()), zip(*out))
                yield pa.RecordBatch.from_pydict({name: pa.array(c, kind) for name, kind, c in columns})

    null = F.lit(None).cast("string")
    texts = rows.where("copies > 0").select(
        "conv_id", "turn", "copies", "role", "text", _code("text").alias("code"), null.alias("audit"), null.alias("given")
    )
    audits = parsed.select(
        "conv_id", F.lit(None).cast("long").alias("turn"), F.lit(0).cast("long").alias("copies"), null.alias("role"), null.alias("text"), null.alias("code"), "audit", "given"
    )
    ordered = texts.unionByName(audits).repartition("conv_id").sortWithinPartitions(
        F.col("conv_id").asc_nulls_first(), F.col("audit").asc_nulls_last(), F.col("turn").asc_nulls_first(), "role", "code"
    )
    return ordered.select("conv_id", "copies", "role", "text", "audit", "given").mapInArrow(run, "conv_id long, place long, role string, text string")


def text_digests(rows: DataFrame) -> DataFrame:
    """conv_id, sha256 of the lines ``role:text`` of conversations that are whole and in order in their partitions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, code, out = None, None, []
        for batch in batches:
            for conv_id, place, role, text in zip(*(batch.column(k).to_pylist() for k in range(4))):
                if place == 0:
                    if code is not None:
                        out.append((conv, code.hexdigest()))
                    conv, code = conv_id, hashlib.sha256()
                else:
                    code.update(b"\n")
                code.update(f"{role}:{text}".encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out])], names=["id", "repaired_sha256"])
                out = []
        if code is not None:
            yield pa.RecordBatch.from_arrays([pa.array([conv], pa.int64()), pa.array([code.hexdigest()])], names=["id", "repaired_sha256"])

    return rows.mapInArrow(run, "id long, repaired_sha256 string")


def digest(conversations: DataFrame) -> DataFrame:
    """One row per conversation of the damaged table: faults, repair and digest of the repaired text."""
    rows = damaged(conversations)
    parsed = materialize(parse(rows), "parsed")
    codes = text_digests(repaired(rows, parsed))
    empty = hashlib.sha256(b"").hexdigest()
    return parsed.join(codes, F.col("conv_id").eqNullSafe(F.col("id")), "left").select(
        *parsed.columns[:-1], F.coalesce("repaired_sha256", F.lit(empty)).alias("repaired_sha256")
    )
