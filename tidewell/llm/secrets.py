"""Secret scans by one automaton for all rules.

Regular expressions over bytes become one nondeterministic automaton, subset construction makes it deterministic, and
partition refinement makes it minimal. Its transition array is read once per byte of a text, for all rules together. It
holds each rule's expression up to where that tells a match apart (its mark); runs that go on behind it would multiply
the states of all rules with one another. Where a rule's mark ends, a small automaton of that rule alone, run backward,
gives the earliest start, and one of the whole rule, run forward from there, the end, so that matches are leftmost,
longest and without overlap within their rule.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm.common import columns, slices, table, texts_of

# --- regular expressions over bytes, as trees -------------------------------------------------------------------------


class Parser:
    """Trees of expressions: bytes, classes with ranges and ^, (..), (?:..), (?i:..), |, ?, *, +, {n} and the escapes \\n,
    \\t, \\r, \\v, \\f, \\xHH and of single marks. Anything else is refused."""

    ESCAPES = {"n": 10, "t": 9, "r": 13, "v": 11, "f": 12}

    def __init__(self, pattern: str):
        self.left, self.fold = list(pattern), False

    def tree(self) -> tuple:
        made = self.choice()
        if self.left:
            raise ValueError("unbalanced bracket in expression")
        return made

    def next_is(self, *marks: str) -> bool:
        return bool(self.left) and self.left[0] in marks

    def take(self, expected: str | None = None) -> str:
        if not self.left or expected is not None and self.left[0] != expected:
            raise ValueError(f"expression needs {expected or 'more'}")
        return self.left.pop(0)

    def choice(self) -> tuple:
        parts = [self.sequence()]
        while self.next_is("|"):
            self.take()
            parts.append(self.sequence())
        return parts[0] if len(parts) == 1 else ("alt", tuple(parts))

    def sequence(self) -> tuple:
        parts = []
        while self.left and not self.next_is("|", ")"):
            part = self.atom()
            while self.next_is("?", "*", "+", "{"):
                mark = self.take()
                if mark == "{":
                    n = ""
                    while not self.next_is("}"):
                        n += self.take()
                    self.take("}")
                    part = ("seq", (part,) * int(n))
                else:
                    part = {"?": ("alt", (part, ("seq", ()))), "*": ("star", part), "+": ("seq", (part, ("star", part)))}[mark]
            parts.append(part)
        return ("seq", tuple(parts))

    def atom(self) -> tuple:
        mark = self.take()
        if mark == "(":
            outer = self.fold
            if self.next_is("?"):
                self.take()
                flag = self.take()
                if flag == "i":
                    self.fold = True
                    flag = self.take()
                if flag != ":":
                    raise ValueError(f"(?{flag} isn't known")
            made = self.choice()
            self.take(")")
            self.fold = outer
            return made
        if mark == "[":
            return self.members()
        if mark in ".^$]}":
            raise ValueError(f"{mark} isn't known")
        return self.one(self.code(mark))

    def code(self, mark: str) -> int:
        if mark != "\\":
            return self.byte(mark)
        mark = self.take()
        if mark == "x":
            return int(self.take() + self.take(), 16)
        if mark.isalnum() and mark not in self.ESCAPES:
            raise ValueError(f"\\{mark} isn't known")
        return self.ESCAPES.get(mark, ord(mark))

    @staticmethod
    def byte(mark: str) -> int:
        if ord(mark) > 127:
            raise ValueError("expressions are ASCII; write other bytes as \\xHH")
        return ord(mark)

    def one(self, *codes: int) -> tuple:
        found = set(codes)
        if self.fold:
            found |= {ord(chr(c).swapcase()) for c in codes if c < 128}
        return ("class", frozenset(found))

    def members(self) -> tuple:
        inverse = self.next_is("^")
        if inverse:
            self.take()
        codes: set[int] = set()
        while not self.next_is("]"):
            first = last = self.code(self.take())
            if self.next_is("-") and len(self.left) > 1 and self.left[1] != "]":
                self.take()
                last = self.code(self.take())
            codes |= set(range(first, last + 1))
        self.take("]")
        return ("class", frozenset(range(256)) - self.one(*codes)[1]) if inverse else self.one(*codes)


def parsed(pattern: str) -> tuple:
    return Parser(pattern).tree()


def backward(tree: tuple) -> tuple:
    """The tree of the mirrored strings."""
    kind, body = tree
    if kind == "seq":
        return (kind, tuple(backward(x) for x in reversed(body)))
    if kind == "alt":
        return (kind, tuple(backward(x) for x in body))
    return (kind, backward(body)) if kind == "star" else tree


# --- automata ---------------------------------------------------------------------------------------------------------


@dataclass
class Automaton:
    """letter: byte -> letter, bytes that no rule tells apart being one. step: state + letter -> state; states are
    multiples of 2 ** shift, the start is `start`, and those from `limit` on accept. accepts: state >> shift -> bit mask
    of rules. dead: the state that nothing leads out of, or -1."""

    letter: bytes
    shift: int
    step: list[int]
    accepts: list[int]
    start: int
    limit: int
    dead: int


def compile_rules(trees: list[tuple], anywhere: bool) -> Automaton:
    """anywhere: a match may begin at any byte, so the start state is always alive."""
    moves: list[list[tuple[frozenset, int]]] = []
    empty: list[list[int]] = []

    def state() -> int:
        moves.append([])
        empty.append([])
        return len(moves) - 1

    def build(tree: tuple, start: int) -> int:
        kind, body = tree
        if kind == "class":
            end = state()
            moves[start].append((body, end))
            return end
        if kind == "seq":
            for part in body:
                start = build(part, start)
            return start
        if kind == "alt":
            end = state()
            for part in body:
                into = state()
                empty[start].append(into)
                empty[build(part, into)].append(end)
            return end
        into, end = state(), state()
        empty[start] += [into, end]
        empty[build(body, into)] += [into, end]
        return end

    root = state()
    final = {}
    for k, tree in enumerate(trees):
        into = state()
        empty[root].append(into)
        final[build(tree, into)] = 1 << k

    def closure(states: set[int]) -> frozenset[int]:
        todo, seen = list(states), set(states)
        while todo:
            for x in empty[todo.pop()]:
                if x not in seen:
                    seen.add(x)
                    todo.append(x)
        return frozenset(seen)

    # Bytes that no class tells apart are one letter.
    letters: dict[tuple[int, ...], list[int]] = {}
    classes = list({c for m in moves for c, _ in m})
    for b in range(256):
        letters.setdefault(tuple(i for i, c in enumerate(classes) if b in c), []).append(b)
    groups = list(letters.values())
    letter = [0] * 256
    for k, members in enumerate(groups):
        for b in members:
            letter[b] = k

    first = closure({root})
    number, rows, accepts, todo = {first: 0}, [], [], [first]
    for found in todo:
        accepts.append(sum(final.get(s, 0) for s in found))
        row = []
        for members in groups:
            b = members[0]
            into = {t for s in found for c, t in moves[s] if b in c}
            target = closure(into | ({root} if anywhere else set()))
            if target not in number:
                number[target] = len(number)
                todo.append(target)
            row.append(number[target])
        rows.append(row)

    # Refine the partition by acceptance until each block agrees on where every letter leads.
    table = np.array(rows)
    _, block = np.unique(np.array(accepts), return_inverse=True)
    while True:
        _, finer = np.unique(np.column_stack([block, block[table]]), axis=0, return_inverse=True)
        finer = finer.ravel()
        if finer.max() == block.max():
            break
        block = finer
    n = block.max() + 1
    _, example = np.unique(block, return_index=True)
    masks = np.array(accepts)[example]
    order = np.empty(n, int)
    order[np.argsort(masks != 0, kind="stable")] = np.arange(n)
    shift = max(1, (len(groups) - 1).bit_length())
    step = np.zeros((n, 1 << shift), int)
    step[order, : len(groups)] = order[block[table[example]]] << shift
    kept = np.zeros(n, int)
    kept[order] = masks
    dead = [x for x in range(n) if not kept[x] and (step[x, : len(groups)] == x << shift).all()]
    return Automaton(bytes(letter), shift, step.ravel().tolist(), kept.tolist(), int(order[block[0]]) << shift, int((masks == 0).sum()) << shift, dead[0] << shift if dead and not anywhere else -1)


# --- rules ------------------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Rule:
    """kind: name in spans. pattern: the whole expression. mark: the beginning of it that tells a match apart. least:
    bytes that a match, or its part after `head`, must have. tail: what a match goes on over where it follows."""

    kind: str
    pattern: str
    mark: str
    least: int = 0
    head: str | None = None
    tail: str | None = None


BEFORE_VALUE = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
VALUE = "[A-Za-z0-9+/_.=-]"
KEY_LINE = r"[A-Z\x20]*PRIVATE KEY-----"
#: A key's body, also with its lines in an escaped string or with attributes before it, and its last line.
KEY_BODY = rf"(?:[A-Za-z0-9+/=\x20\t\n\r\v\f\\:,]|-[A-Za-z0-9])*-----END {KEY_LINE}"
BASE = (
    Rule("assign", f"{BEFORE_VALUE}{VALUE}+", BEFORE_VALUE + VALUE, 12, BEFORE_VALUE),
    Rule("access", "AKIA[A-Z0-9]+", "AKIA[A-Z0-9]", 18),
    # The automaton counts to 6, for shorter runs are everywhere.
    Rule("hex", "[0-9a-f]{6}[0-9a-f]*", "[0-9a-f]{6}", 16),
)
ADDED = (
    Rule("private_key", f"-----BEGIN {KEY_LINE}", "-----BEGIN ", tail=KEY_BODY),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", "eyJ[A-Za-z0-9_-]"),
    Rule("code_host", "gh[pousr]_[A-Za-z0-9]+", "gh[pousr]_", 40),
    Rule("chat", "xox[abprs]-[A-Za-z0-9-]+", "xox[abprs]-", 20),
    Rule("payment", "[sr]k_live_[A-Za-z0-9]+", "[sr]k_live_", 24),
    Rule("url_password", r"://[A-Za-z0-9._-]+:[A-Za-z0-9._~!$*+=%-]+@", "://", 8),
)
RULES = BASE + ADDED


class Scanner:
    def __init__(self, rules: tuple[Rule, ...] = RULES):
        self.rules = rules
        marks = [parsed(r.mark) for r in rules]
        self.all = compile_rules(marks, True)
        self.alone = [compile_rules([m], True) for m in marks]
        self.behind = [compile_rules([backward(m)], False) for m in marks]
        whole = lambda pattern: compile_rules([parsed(pattern)], False) if pattern else None
        self.ahead, self.head, self.tail = ([whole(p) for p in ps] for ps in ([r.pattern for r in rules], [r.head for r in rules], [r.tail for r in rules]))

    def accepted(self, text: bytes) -> list[tuple[int, int, int]]:
        """(rule, first end, last end) of each stretch of bytes at which a rule's marks end: the one pass."""
        machine = self.all
        step, limit, changes, state, before = machine.step, machine.limit, [], machine.start, 0
        for at, letter in enumerate(text.translate(machine.letter), 1):
            state = step[state | letter]
            if state >= limit or before:
                now = machine.accepts[state >> machine.shift]
                if now != before:
                    changes.append((at, now ^ before))
                    before = now
        if before:
            changes.append((len(text) + 1, before))
        opened: dict[int, int] = {}
        out = []
        for at, mask in changes:
            for k in range(len(self.rules)):
                if mask >> k & 1:
                    first = opened.pop(k, 0)
                    if first:
                        out.append((k, first, at - 1))
                    else:
                        opened[k] = at
        return out

    @staticmethod
    def reach(machine: Automaton, text: bytes, start: int, stop: int) -> int:
        """Where the longest match from start on ends, or -1. Reads backward if stop is before start."""
        step, letters, limit, dead, state = machine.step, machine.letter, machine.limit, machine.dead, machine.start
        found = start if state >= limit else -1
        ahead = stop >= start
        for at in range(start, stop) if ahead else range(start - 1, stop - 1, -1):
            state = step[state | letters[text[at]]]
            if state == dead:
                break
            if state >= limit:
                found = at + 1 if ahead else at
        return found

    @staticmethod
    def longest(machine: Automaton, text: bytes, start: int, barren: set[int]) -> int:
        """Where the longest match from start on ends, or -1. barren: places and states that no match ends behind, of this
        text and machine; a read that comes by one is over, so that many reads of one run cost no more than a few. Short
        ends of reads aren't worth keeping."""
        step, letters, limit, dead, state = machine.step, machine.letter, machine.limit, machine.dead, machine.start
        found, trail, wide = start if state >= limit else -1, [], len(step)
        for at in range(start, len(text)):
            state = step[state | letters[text[at]]]
            if state == dead or (barren and at * wide + state in barren):
                break
            if state >= limit:
                found = at + 1
                trail.clear()
            else:
                trail.append(at * wide + state)
        if len(trail) > 64:
            barren.update(trail)
        return found

    def first_end(self, k: int, text: bytes, start: int, stop: int) -> int:
        """The first byte at which a mark that begins at start or later ends, or -1."""
        machine = self.alone[k]
        state = machine.start
        for at in range(start, stop):
            state = machine.step[state | machine.letter[text[at]]]
            if state >= machine.limit:
                return at + 1
        return -1

    def scan(self, text: bytes) -> list[tuple[int, int, int]]:
        """(start, rule, end) in bytes, by start and rule. A match uses up its text, also if it is then dropped because
        it is too short; what else ends in its stretch may begin in used-up text, so that is searched from there anew."""
        out, free, barren = [], [0] * len(self.rules), [set() for _ in self.rules]
        for k, first, last in self.accepted(text):
            rule, end = self.rules[k], first
            if end <= free[k]:
                end = self.first_end(k, text, free[k], last)
            while 0 <= end <= last:
                start = self.reach(self.behind[k], text, end, free[k])
                if start < 0 or start == end:
                    end = self.first_end(k, text, free[k], last)
                    start = self.reach(self.behind[k], text, end, free[k]) if end >= 0 else -1
                    if start < 0:
                        break
                stop = self.longest(self.ahead[k], text, start, barren[k])
                if stop < end:  # the mark stands there, but not what the rule needs behind it
                    free[k] = start + 1
                    end = self.first_end(k, text, free[k], last)
                    continue
                if self.tail[k]:
                    stop = max(stop, self.reach(self.tail[k], text, stop, len(text)))
                free[k] = stop
                if stop - (self.reach(self.head[k], text, start, stop) if self.head[k] else start) >= rule.least:
                    out.append((start, k, stop))
                end = self.first_end(k, text, stop, last)
        return sorted(out)


@lru_cache(maxsize=4)
def compiled(rules: tuple[Rule, ...]) -> Scanner:
    return Scanner(rules)


def in_code_points(text: bytes, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    if text.isascii() or not spans:
        return spans
    begins = np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)
    count = lambda at: int(begins[at - 1]) if at else 0
    return [(count(a), k, count(b)) for a, k, b in spans]


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES, out: str = "secrets") -> DataFrame:
    """The columns of docs, then `out` array<struct<kind, start, end>> in code points, end exclusive, by start and then
    rule.

    Null and empty texts have none. Repeated rows are scanned each for itself; an empty table gives no rows. A column of
    docs that is called `out` already is an error, so choose another name then.
    """
    names = docs.columns
    if out.lower() in (n.lower() for n in names):
        raise ValueError(f"docs has a column {out} already")
    shared = docs.sparkSession.sparkContext.broadcast(compiled(rules))  # its size depends on the rules alone
    entry = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = shared.value
        for batch in slices(batches):
            found = [[{"kind": rules[k].kind, "start": a, "end": b} for a, k, b in in_code_points(t, scanner.scan(t))] for t in texts_of(batch)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.list_(entry))], names=[*names, out])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(run, schema + f", `{out}` array<struct<kind:string,start:long,end:long>>")


def redact(docs: DataFrame, mark: str = "[secret]") -> DataFrame:
    """docs with each secret in `text` replaced by the mark; overlapping secrets are replaced as one. Null and empty texts
    stay, repeated rows are done each for itself, an empty table stays empty, and columns of any name are kept."""
    names = docs.columns
    own = docs.select(*[F.col(f"`{c}`").alias("text" if c == "text" else f"c{i}") for i, c in enumerate(names)])
    found = find_secrets(own)
    merged = F.aggregate(
        "secrets",
        F.expr("cast(array() as array<struct<start:long,end:long>>)"),
        lambda done, x: F.when(
            (F.size(done) > 0) & (x["start"] < F.element_at(done, -1)["end"]),
            F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(F.element_at(done, -1)["start"].alias("start"), F.greatest(F.element_at(done, -1)["end"], x["end"]).alias("end")))),
        ).otherwise(F.concat(done, F.array(F.struct(x["start"].alias("start"), x["end"].alias("end"))))),
    )
    # From the last span to the first, so that earlier offsets stay true.
    text = F.aggregate(F.reverse("spans"), F.col("text"), lambda t, x: F.concat(F.substring(t, F.lit(1), x["start"].cast("int")), F.lit(mark), t.substr((x["end"] + 1).cast("int"), F.length(t))))
    made = found.withColumn("spans", merged)
    return made.withColumn("text", F.when(F.size("spans") > 0, text).otherwise(F.col("text"))).select(*[F.col(c).alias(names[i]) for i, c in enumerate(own.columns)])


def op3_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = find_secrets(columns(table(spark, sf_dir, "documents"), "doc_id", "text")).drop("text")
    base = F.filter("secrets", lambda x: x["kind"].isin(*(r.kind for r in BASE)))
    joined = lambda spans: F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    count = lambda kind: F.size(F.filter("secrets", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return made.select("doc_id", *(count(r.kind) for r in BASE), F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("secrets")).alias("spans"))
