"""Conversation structure repair: generalised LR parsing with edits over the role grammar.

The roles of a conversation must read

    C -> () | T | s T        T -> P | T P        P -> u a

(s system, u user, a assistant). An SLR table is built from these rules. A
conversation's rows are parsed on a graph-structured stack: stacks share their
lower nodes, each live top carries the least (cost, audit) of all edit
sequences that lead to it, and equal tops merge by that minimum. For each row
the actions are Keep (0), Rerole to user or assistant (1) and Delete (2, the
only one for a blank or duplicate row); Insert (5) puts an empty user or
assistant row anywhere, and a truncated row that is not deleted adds 5. The
audit is the initials of the edits in order; of equally cheap ones the least in
ASCII order is taken. Appending the same edits to two audits of one cost at one
row keeps their order (neither starts the other, as they differ in cost then),
so the merging loses no best repair.

Scale. Rows are sorted over all tasks by conversation and place, so a
conversation of any length is cut where the tasks' ranges end. A task parses
the conversations that lie whole in its range; of the others (two a task at
most) it gives a transfer: for each stack at the start the best (cost, audit)
for each stack at the end. Transfers are joined through a tree of groups of FAN,
then the chosen stacks go back down to the pieces, each of which gives its own
repaired rows. Within a task long runs of rows are parsed in blocks of BLOCK
rows, joined alike.

Defined cases: null conversation ids are one conversation, shown as null; a
null turn sorts first; rows of a turn are ordered by role, then text; repeated
rows are duplicates of the first; a null or empty text is blank; an empty or
unknown role has no place in the grammar, so it is reroled or deleted; only a
role's first letter is read; extra columns are ignored; an empty table gives
no conversation.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from carestat.llm.common import Scratch

RULES = [("C'", ("C",)), ("C", ()), ("C", ("T",)), ("C", ("s", "T")), ("T", ("P",)), ("T", ("T", "P")), ("P", ("u", "a"))]
TERMINALS = ("s", "u", "a")
NAMES = {"u": "user", "a": "assistant"}
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
BLOCK = 512  # rows parsed as one run
FAN = 32  # pieces of a conversation joined by one group of a level
CACHED = 1 << 16  # short conversations whose repair a worker keeps
CACHED_ROWS = 24

#: what the parser knows of a row: initial (s, u, a, or - for any other), then
#: k may be kept, t truncated, d must go
FINE, CUT, GONE = "k", "t", "d"
Label = tuple[int, str]
Transfer = dict[tuple[int, int], tuple[int, str, tuple[int, ...]]]


# ---- the SLR table

def _closure(items: set) -> frozenset:
    items, todo = set(items), list(items)
    while todo:
        rule, dot = todo.pop()
        right = RULES[rule][1]
        if dot < len(right):
            for r, (left, _) in enumerate(RULES):
                if left == right[dot] and (r, 0) not in items:
                    items.add((r, 0))
                    todo.append((r, 0))
    return frozenset(items)


def _goto(items: frozenset, symbol: str) -> frozenset:
    return _closure({(r, d + 1) for r, d in items if d < len(RULES[r][1]) and RULES[r][1][d] == symbol})


def _follow() -> dict[str, set]:
    """Terminals ($ the end) that may come after each left side; only C is empty and it comes last."""
    lefts = {left for left, _ in RULES}
    first = {t: {t} for t in TERMINALS} | {n: set() for n in lefts}
    follow = {n: set() for n in lefts} | {"C'": {"$"}}
    for _ in range(len(RULES) * len(RULES)):
        for left, right in RULES:
            if right:
                first[left] |= first[right[0]]
            for i, x in enumerate(right):
                if x in lefts:
                    follow[x] |= first[right[i + 1]] if i + 1 < len(right) else follow[left]
    return follow


@dataclass
class Stacks:
    """The nodes of the graph-structured stack: (state, node below), each held once."""

    states: list = field(default_factory=list)
    nodes: list = field(default_factory=list)
    ids: dict = field(default_factory=dict)
    steps: dict = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.follow = _follow()
        self.root = self.node(self.state(_closure({(0, 0)})), -1)

    def state(self, items: frozenset) -> int:
        if items not in self.states:
            self.states.append(items)
        return self.states.index(items)

    def node(self, state: int, below: int) -> int:
        if (state, below) not in self.ids:
            self.ids[state, below] = len(self.nodes)
            self.nodes.append((state, below))
        return self.ids[state, below]

    def push(self, node: int, symbol: str) -> int | None:
        to = _goto(self.states[self.nodes[node][0]], symbol)
        return self.node(self.state(to), node) if to else None

    def reduced(self, node: int, ahead: str) -> list[int]:
        """The node and all that reductions with this terminal ahead make of it."""
        found = [node]
        for n in found:
            for r, dot in self.states[self.nodes[n][0]]:
                left, right = RULES[r]
                if r and dot == len(right) and ahead in self.follow[left]:
                    below = n
                    for _ in right:
                        below = self.nodes[below][1]
                    to = self.push(below, left)
                    if to is not None and to not in found:
                        found.append(to)
        return found

    def step(self, node: int, symbol: str) -> int | None:
        """The top after reductions and a shift of the terminal; the last pair is reduced at once
        (its rule is the state's only item), so equal stacks have one node."""
        key = (node, symbol)
        if key not in self.steps:
            tops = [self.push(n, symbol) for n in self.reduced(node, symbol)]
            tops = {t for t in tops if t is not None}
            done = set()
            for t in tops:
                while len(items := self.states[self.nodes[t][0]]) == 1 and next(iter(items))[1] == len(RULES[next(iter(items))[0]][1]):
                    left, right = RULES[next(iter(items))[0]]
                    below = t
                    for _ in right:
                        below = self.nodes[below][1]
                    t = self.push(below, left)
                done.add(t)
            assert len(done) <= 1, "the role grammar has one parse"
            self.steps[key] = done.pop() if done else None
        return self.steps[key]

    def accepts(self, node: int) -> bool:
        final = self.state(_goto(self.states[0], "C"))
        return any(self.nodes[n][0] == final for n in self.reduced(node, "$"))

    def resting(self) -> list[int]:
        """All stacks between rows (finitely many for this grammar)."""
        found = [self.root]
        for n in found:
            for s in TERMINALS:
                to = self.step(n, s)
                if to is not None and to not in found:
                    found.append(to)
        return found


STACKS = Stacks()
RESTING = STACKS.resting()


# ---- parsing

def _inserted(front: dict[int, Label]) -> dict[int, Label]:
    """The tops with all inserts that pay added."""
    todo = list(front)
    while todo:
        n = todo.pop()
        cost, audit = front[n]
        for s in NAMES:
            to = STACKS.step(n, s)
            if to is not None:
                new = (cost + INSERT, audit + "I")
                if to not in front or new < front[to]:
                    front[to] = new
                    todo.append(to)
    return front


def _run(rows: str, start: int) -> dict[int, Label]:
    """Best (cost, audit) of each top after the rows (two letters each), from one stack."""
    front = _inserted({start: (0, "")})
    for i in range(0, len(rows), 2):
        initial, fault = rows[i], rows[i + 1]
        extra, after = TRUNCATED * (fault == CUT), {}
        for n, (cost, audit) in front.items():
            options = [(n, (cost + DELETE, audit + "D"))]
            if fault != GONE:
                if initial in TERMINALS:
                    options.append((STACKS.step(n, initial), (cost + KEEP + extra, audit + "K")))
                options += [(STACKS.step(n, s), (cost + REROLE + extra, audit + "R")) for s in NAMES]
            for to, label in options:
                if to is not None and (to not in after or label < after[to]):
                    after[to] = label
        front = _inserted(after)
    return front


def join(a: Transfer, b: Transfer) -> Transfer:
    """The transfer over the rows of a, then those of b."""
    out: Transfer = {}
    for (s, m), (c1, x1, p1) in a.items():
        for (m2, e), (c2, x2, p2) in b.items():
            if m == m2:
                new = (c1 + c2, x1 + x2, p1 + p2)
                if (s, e) not in out or new[:2] < out[s, e][:2]:
                    out[s, e] = new
    return out


def transfer(rows: str) -> Transfer:
    """For every stack at the start the best (cost, audit, (end,)) for each at the end."""
    parts = [rows[i:i + 2 * BLOCK] for i in range(0, len(rows), 2 * BLOCK)] or [""]
    tables = [{(s, e): (c, x, ()) for s in RESTING for e, (c, x) in _run(p, s).items()} for p in parts]
    tables = fold(tables)
    return {(s, e): (c, x, (e,)) for (s, e), (c, x, _) in tables.items()}


def fold(tables: list[Transfer]) -> Transfer:
    """All transfers joined in order, neighbours first."""
    while len(tables) > 1:
        tables = [join(*tables[i:i + 2]) if i + 1 < len(tables) else tables[i] for i in range(0, len(tables), 2)]
    return tables[0]


def best(table: Transfer) -> tuple[int, str, tuple[int, ...]]:
    return min(v for (s, e), v in table.items() if s == STACKS.root and STACKS.accepts(e))


@lru_cache(CACHED)
def _short(rows: str) -> Label:
    return min(label for n, label in _run(rows, STACKS.root).items() if STACKS.accepts(n))


def cheapest(rows: str) -> Label:
    """(cost, audit) of the cheapest repair; rows as two letters each, see FINE."""
    return _short(rows) if len(rows) <= 2 * CACHED_ROWS else best(transfer(rows))[:2]


def repaired(audit: str, rows: Iterable[tuple[str, str]], start: int = STACKS.root) -> Iterator[tuple[str, str, str]]:
    """(edit, role, text) of every edit but the deletes, from the stack at the start."""
    rows, at = iter(rows), start
    for edit in audit:
        role, text = ("", "") if edit == "I" else next(rows)
        if edit == "D":
            continue
        if edit != "K":
            role = next(name for s, name in NAMES.items() if STACKS.step(at, s) is not None)
        at = STACKS.step(at, role[0])
        yield edit, role, text


# ---- pieces of conversations

@dataclass
class Piece:
    """Counts over a run of rows of one conversation, and its transfer."""

    n: int = 0
    blank: int = 0
    duplicate: int = 0
    truncated: int = 0
    illegal: int = 0
    turns: int = 0
    low: int | None = None
    high: int | None = None
    first: str = ""
    last: str = ""
    table: Transfer | None = None

    def __add__(self, o: "Piece") -> "Piece":
        same = self.turns and o.turns and self.high == o.low
        return Piece(self.n + o.n, self.blank + o.blank, self.duplicate + o.duplicate, self.truncated + o.truncated,
                     self.illegal + o.illegal + int(self.last + o.first not in LEGAL), self.turns + o.turns - int(bool(same)),
                     self.low if self.turns else o.low, o.high if o.turns else self.high, self.first, o.last)

    @property
    def gaps(self) -> int:
        return min(self.high - self.low + 1 - self.turns, (1 << 63) - 1) if self.turns else 0


LEGAL = {"su", "ua", "au"}
BLANK, DUPLICATE, SHORT = "blank", "duplicate", "truncated"
_TOPS = "array<struct<start:int,end:int,cost:long,audit:string,path:array<int>>>"
_PIECE = ("conv string, part int, n long, blank long, duplicate long, truncated long, illegal long, turns long, low long, high long, "
          f"first string, last string, tops {_TOPS}")
_COUNTS = ("n", "blank", "duplicate", "truncated", "illegal", "turns", "low", "high", "first", "last")


def fault_column(text: Column) -> Column:
    """blank or truncated, else empty (duplicates are found by place)."""
    bare = F.regexp_replace(text, "[\\x20\\x09-\\x0D]+$", "")
    return F.when(bare == "", BLANK).when(~F.substring(bare, -1, 1).isin(".", "!", "?"), SHORT).otherwise("")


def conv_key(column: Column) -> Column:
    """The conversation's id as text after a mark, empty for null."""
    return F.coalesce(F.concat(F.lit("="), column.cast("string")), F.lit(""))


def ordered_rows(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv, has_turn, turn, role, text, digest, fault, again, n): distinct rows with their number and
    whether the same role and text come before, sorted over the partitions by conversation and place.

    Equal rows become one before anything is sorted, and the earliest place of a
    (conversation, role, text) is found by a grouped minimum that is joined by the whole
    place: no key is shared by more than one row.
    """
    value = F.coalesce(F.col(text).cast("string"), F.lit(" "))
    thin = rows.select(conv_key(F.col(conv)).alias("conv"), F.col(turn).cast("long").alias("turn"),
                       F.coalesce(F.col(role).cast("string"), F.lit(" ")).alias("role"), value.alias("text"))
    thin = thin.select("conv", F.col("turn").isNotNull().alias("has_turn"),
                       F.coalesce("turn", F.lit(0)).alias("turn"), "role", "text", F.md5(F.col("text").cast("binary")).alias("digest"))
    place = ["conv", "has_turn", "turn", "role", "digest"]
    one = thin.groupBy(*place).agg(F.first("text").alias("text"), F.count("*").alias("n"))
    earliest = (thin.groupBy("conv", "role", "digest").agg(F.min(F.struct("has_turn", "turn")).alias("m"))
                .select("conv", "m.has_turn", "m.turn", "role", "digest", F.lit(True).alias("_new")))
    out = one.join(earliest, place, "left").select(*place, "text", "n", F.col("_new").isNull().alias("again"), fault_column(F.col("text")).alias("fault"))
    by = ["conv", "has_turn", "turn", "role", "text"]
    return out.repartitionByRange(*by).sortWithinPartitions(*by)


class _Rows:
    """Buffered rows of one conversation in one partition."""

    def __init__(self, conv: str):
        self.conv, self.letters, self.texts, self.piece = conv, [], [], Piece()

    def add(self, has_turn: bool, turn: int, role: str, text: str, n: int, again: bool, fault: str) -> None:
        initial = role[:1]
        known = initial if initial in TERMINALS else "-"
        for copy in range(n):
            kind = fault if fault == BLANK else DUPLICATE if again or copy else fault
            p = Piece(1, int(kind == BLANK), int(kind == DUPLICATE), int(kind == SHORT), 0, int(has_turn), turn if has_turn else None,
                      turn if has_turn else None, initial or " ", initial or " ")
            self.piece = self.piece + p if self.piece.n else p
            self.letters.append(known + (GONE if kind in (BLANK, DUPLICATE) else CUT if kind == SHORT else FINE))
            self.texts.append((role, text))

    @property
    def rows(self) -> str:
        return "".join(self.letters)


def _digest(lines: Iterable[tuple[str, str, str]], sha=None, begun: bool = False):
    sha = sha or hashlib.sha256()
    for _, role, text in lines:
        sha.update((("\n" if begun else "") + f"{role}:{text}").encode("utf-8", "surrogatepass"))
        begun = True
    return sha, begun


_WHOLE = ("conv string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string")
_LINE = "conv string, part int, at long, role string, text string"
_PARSED = f"whole struct<{_WHOLE}>, piece struct<{_PIECE}>, line struct<{_LINE}>"


_TOP_ARROW = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("cost", pa.int64()), ("audit", pa.string()), ("path", pa.list_(pa.int32()))])


def _fields(ddl: str) -> pa.StructType:
    """The Arrow struct of "name type, name type"."""
    kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), _TOPS: pa.list_(_TOP_ARROW)}
    return pa.struct([(name, kinds[kind]) for name, kind in (f.split(" ", 1) for f in ddl.replace(_TOPS, "@").split(", ")) if kind != "@"]
                     + ([("tops", kinds[_TOPS])] if _TOPS in ddl else []))


_PARSED_ARROW = pa.schema([("whole", _fields(_WHOLE)), ("piece", _fields(_PIECE)), ("line", _fields(_LINE))])


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[_Rows]:
    """The conversations of a sorted partition one after another."""
    now = None
    for b in batches:
        for conv, has, turn, role, text, n, again, fault in zip(*[b.column(b.schema.get_field_index(c)).to_pylist() for c in
                                                                   ("conv", "has_turn", "turn", "role", "text", "n", "again", "fault")]):
            if now is None or now.conv != conv:
                if now is not None:
                    yield now
                now = _Rows(conv)
            now.add(has, turn, role, text, n, again, fault)
    if now is not None:
        yield now


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A conversation inside a partition is repaired; the first and the last one, which the neighbours may
    share, give a piece and their rows."""
    from pyspark import TaskContext
    part, runs, out = TaskContext.get().partitionId(), _runs(batches), _Out()
    held, first = None, True
    for run in runs:
        if held is not None:
            yield from out.add(_open(held, part) if first else _closed(held))
            first = False
        held = run
    if held is not None:
        yield from out.add(_open(held, part))
    yield from out.flush()


class _Out:
    """Output rows gathered into batches of bounded size."""

    def __init__(self):
        self.rows, self.bytes = [], 0

    def add(self, rows: Iterable[dict]) -> Iterator[pa.RecordBatch]:
        for r in rows:
            self.rows.append(r)
            line, whole, piece = r.get("line"), r.get("whole"), r.get("piece")
            self.bytes += 300 + (len(line["text"]) if line else 0) + (len(whole["audit"]) if whole else 0)
            self.bytes += sum(len(t["audit"]) for t in piece["tops"]) if piece else 0
            if self.bytes > 4 << 20:
                yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.rows:
            yield pa.RecordBatch.from_pylist([{"whole": r.get("whole"), "piece": r.get("piece"), "line": r.get("line")} for r in self.rows], _PARSED_ARROW)
        self.rows, self.bytes = [], 0


def _counts(p: Piece) -> dict:
    return {"gaps": p.gaps, "blank": p.blank, "duplicate": p.duplicate, "truncated": p.truncated, "illegal": p.illegal}


def _closed(run: _Rows) -> Iterator[dict]:
    cost, audit = cheapest(run.rows)
    sha = _digest(repaired(audit, run.texts))[0].hexdigest()
    yield {"whole": {"conv": run.conv, **_counts(run.piece), "cost": cost, "audit": audit, "repaired_sha256": sha}}


def _tops(table: Transfer) -> list[dict]:
    return [{"start": s, "end": e, "cost": c, "audit": x, "path": list(p)} for (s, e), (c, x, p) in table.items()]


def _open(run: _Rows, part: int) -> Iterator[dict]:
    p = run.piece
    yield {"piece": {"conv": run.conv, "part": part, **{c: getattr(p, c) for c in _COUNTS}, "tops": _tops(transfer(run.rows))}}
    for i, (role, text) in enumerate(run.texts):
        yield {"line": {"conv": run.conv, "part": part, "at": i, "role": role, "text": text}}


def _joined(group: pd.DataFrame) -> pd.DataFrame:
    """The pieces of a group, in order, as one (its part is the first's)."""
    group = group.sort_values("part")
    pieces = [Piece(*[None if pd.isna(v) else v for v in row]) for row in group[list(_COUNTS)].itertuples(index=False, name=None)]
    tables = [{(t["start"], t["end"]): (t["cost"], t["audit"], tuple(t["path"])) for t in tops} for tops in group["tops"]]
    whole = pieces[0]
    for p in pieces[1:]:
        whole = whole + p
    return pd.DataFrame([{"conv": group["conv"].iloc[0], "part": group["part"].iloc[0], **{c: getattr(whole, c) for c in _COUNTS},
                          "tops": _tops(fold(tables))}]).astype({"low": "Int64", "high": "Int64"})


def _chosen(group: pd.DataFrame) -> pd.DataFrame:
    """The whole conversation's best repair, and the stacks between its pieces."""
    rows = []
    for row in _joined(group).itertuples(index=False):
        table = {(t["start"], t["end"]): (t["cost"], t["audit"], tuple(t["path"])) for t in row.tops}
        cost, audit, path = best(table)
        p = Piece(*[None if pd.isna(getattr(row, c)) else getattr(row, c) for c in _COUNTS])
        rows.append({"conv": row.conv, **_counts(p), "cost": cost, "audit": audit, "path": list(path)})
    return pd.DataFrame(rows)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest of each conversation from its lines in order: a piece's audit and starting stack come before its lines."""
    def lines():
        for b in batches:
            yield from zip(*[b.column(b.schema.get_field_index(c)).to_pylist() for c in ("conv", "at", "role", "text", "start")])

    done = pa.schema([("conv", pa.string()), ("repaired_sha256", pa.string())])
    stream, conv, sha, begun = lines(), None, None, False
    ahead = next(stream, None)
    while ahead is not None:
        name, _, _, audit, start = ahead
        if name != conv:
            if sha is not None:
                yield pa.RecordBatch.from_pylist([{"conv": conv, "repaired_sha256": sha.hexdigest()}], done)
            conv, sha, begun = name, hashlib.sha256(), False
        ahead = None

        def own():
            nonlocal ahead
            for row in stream:
                if row[1] < 0:
                    ahead = row
                    return
                yield row[2], row[3]
        rows = own()
        sha, begun = _digest(repaired(audit, rows, start), sha, begun)
        for _ in rows:  # nothing is left but deletes at the end
            pass
    if sha is not None:
        yield pa.RecordBatch.from_pylist([{"conv": conv, "repaired_sha256": sha.hexdigest()}], done)


def _cut(parsed: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Of the conversations that tasks share: (conv, counts, cost, audit, path), and per piece (conv, part, start, audit)."""
    pieces = scratch.put(parsed.where("piece is not null").select("piece.*"), "pieces")
    # a conversation has a piece in each of the partitions it covers, so their numbers follow one another
    pieces = scratch.put(pieces.join(pieces.groupBy("conv").agg(F.min("part").alias("_low")), "conv").withColumn("part", F.col("part") - F.col("_low")).drop("_low"), "placed")
    many = pieces.agg(F.max("part")).first()[0]
    level, schema = pieces, _PIECE
    for depth in range(max(0, math.ceil(math.log(max(1, (many or 0) + 1), FAN)) - 1)):
        level = scratch.put(level.withColumn("_g", F.floor(F.col("part") / FAN)).groupBy("conv", "_g").applyInPandas(_joined, schema)
                            .withColumn("part", F.floor(F.col("part") / FAN).cast("int")), f"level-{depth}")
    whole = level.groupBy("conv").applyInPandas(_chosen, "conv string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, path array<int>")
    whole = scratch.put(whole, "cut")
    ends = whole.select("conv", F.posexplode("path").alias("part", "end"), F.array_insert("path", 1, F.lit(STACKS.root)).alias("path"))
    ends = ends.select("conv", "part", "end", F.get("path", F.col("part")).alias("start"))
    own = pieces.select("conv", "part", F.explode("tops").alias("t")).select("conv", "part", "t.start", "t.end", "t.audit")
    return whole, ends.join(own, ["conv", "part", "start", "end"]).select("conv", "part", "start", "audit")


def repair(spark: SparkSession, rows: DataFrame, scratch: Scratch, conv: str = "conv_id", turn: str = "turn",
           role: str = "role", text: str = "text") -> DataFrame:
    """(conv, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) per conversation with rows;
    conv is ``conv_key`` of the id.

    ``repaired_sha256`` is the digest of the repaired ``role:text`` lines. A digest has to be taken in
    order, so the lines of a conversation that several tasks share pass through one task as a stream;
    nothing of them is held.
    """
    parsed = scratch.put(ordered_rows(rows, conv, turn, role, text).mapInArrow(_parse, _PARSED), "parsed")
    whole, audits = _cut(parsed, scratch)
    lines = parsed.where("line is not null").select("line.*")
    low = parsed.where("piece is not null").groupBy(F.col("piece.conv").alias("conv")).agg(F.min("piece.part").alias("_low"))
    lines = lines.join(low, "conv").select("conv", (F.col("part") - F.col("_low")).alias("part"), "at", "role", "text", F.lit(None).cast("int").alias("start"))
    heads = audits.select("conv", "part", F.lit(-1).cast("long").alias("at"), F.lit("").alias("role"), F.col("audit").alias("text"), "start")
    stream = heads.unionByName(lines).repartition("conv").sortWithinPartitions("conv", "part", "at")
    shas = stream.mapInArrow(_hashed, "conv string, repaired_sha256 string")
    cut = whole.drop("path").join(shas, "conv")
    return parsed.where("whole is not null").select("whole.*").unionByName(cut)


def repaired_rows(spark: SparkSession, rows: DataFrame, scratch: Scratch, conv: str = "conv_id", turn: str = "turn",
                  role: str = "role", text: str = "text") -> DataFrame:
    """(conv, part, at, edit, role, text): the repaired rows; part and at give their order in a conversation."""
    ordered = scratch.put(ordered_rows(rows, conv, turn, role, text).withColumn("_part", F.spark_partition_id())
                          .withColumn("_row", F.monotonically_increasing_id()), "ordered")
    parsed = ordered.repartitionById(max(1, (ordered.agg(F.max("_part")).first()[0] or 0) + 1), F.col("_part")).sortWithinPartitions("_row")
    whole, audits = _cut(scratch.put(parsed.mapInArrow(_parse, _PARSED), "parsed"), scratch)
    known = scratch.put(audits, "audits")
    low = ordered.join(known.select("conv").distinct(), "conv", "left_semi").groupBy("conv").agg(F.min("_part").alias("_low"))
    # a piece's audit travels to its partition as a row before the rows
    heads = known.join(low, "conv").select("conv", (F.col("part") + F.col("_low")).alias("_part"), F.lit(-1).cast("long").alias("_row"), F.col("audit"), "start")
    body = ordered.unionByName(heads, allowMissingColumns=True)
    return (body.repartitionById(parsed.rdd.getNumPartitions(), F.col("_part")).sortWithinPartitions(F.col("_row"))
            .mapInArrow(_written, "conv string, part int, at long, edit string, role string, text string"))


def _written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext
    part, given = TaskContext.get().partitionId(), {}

    def bodies():
        for b in batches:
            head = pa.compute.less(b.column(b.schema.get_field_index("_row")), 0)
            for r in b.filter(head).to_pylist():
                given[r["conv"]] = (r["audit"], r["start"])
            yield b.filter(pa.compute.invert(head))
    out, size = [], 0
    schema = pa.schema([("conv", pa.string()), ("part", pa.int32()), ("at", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())])
    for run in _runs(bodies()):
        audit, start = given.get(run.conv) or (cheapest(run.rows)[1], STACKS.root)
        for at, (edit, role, text) in enumerate(repaired(audit, run.texts, start)):
            out.append({"conv": run.conv, "part": part, "at": at, "edit": edit, "role": role, "text": text})
            size += 100 + len(text)
            if size > 4 << 20:
                yield pa.RecordBatch.from_pylist(out, schema)
                out, size = [], 0
    if out:
        yield pa.RecordBatch.from_pylist(out, schema)


# ---- the damage that the query repairs

def damaged(conversations: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) after seeded damage by crc32(conv_id:turn) mod 20: 0 drops, 1 empties the text,
    2 removes its . ! ?, 3 repeats the row, 4 makes the role user. A null is one space."""
    conv, turn = F.col("conv_id"), F.col("turn")
    part = [F.coalesce(c.cast("string"), F.lit(" ")) for c in (conv, turn)]
    fate = F.crc32(F.concat(part[0], F.lit(":"), part[1]).cast("binary")) % 20
    text = F.coalesce(F.col("text").cast("string"), F.lit(" "))
    rows = conversations.select(
        conv, turn, F.when(fate == 4, "user").otherwise(F.coalesce(F.col("role").cast("string"), F.lit(" "))).alias("role"),
        F.when(fate == 1, "").when(fate == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"), fate.alias("_fate"))
    copies = F.when(F.col("_fate") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.where("_fate <> 0").select("conv_id", "turn", "role", "text", F.explode(copies).alias("_copy")).drop("_copy")


def repaired_conversations(spark: SparkSession, conversations: DataFrame) -> DataFrame:
    """Damage and repair of every conversation: conv_id and the columns of ``repair``; zeros where no row is left."""
    with Scratch(spark, "repair") as scratch:
        found = scratch.put(repair(spark, damaged(conversations), scratch), "found", keep=True)
    every = conversations.select("conv_id").distinct().withColumn("conv", conv_key(F.col("conv_id")))
    out = every.join(found, "conv", "left").drop("conv")
    nothing = {c: 0 for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")}
    return out.na.fill({**nothing, "audit": "", "repaired_sha256": hashlib.sha256(b"").hexdigest()},
                       subset=[*nothing, "audit", "repaired_sha256"])
