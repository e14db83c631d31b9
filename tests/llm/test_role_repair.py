import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from carestat.llm import role_repair as rr
from carestat.llm.common import Scratch

SMALL = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string, conv string, digest string, part int, n int"
GRAMMAR = re.compile(r"(s?(ua)+)?")


def _repairs(rows):
    """Every edit sequence no dearer than deleting all: (cost, audit, roles, lines)."""
    limit = 2 * len(rows)

    def go(i, cost, audit, lines):
        if cost > limit:
            return
        if i == len(rows):
            if GRAMMAR.fullmatch("".join(r[0] for r, _ in lines)):
                yield cost, audit, lines
        else:
            role, text, kind = rows[i]
            yield from go(i + 1, cost + 2, audit + "D", lines)
            if kind not in ("blank", "duplicate"):
                extra = 5 * (kind == "truncated")
                if role[:1] in ("s", "u", "a"):
                    yield from go(i + 1, cost + extra, audit + "K", [*lines, (role, text)])
                for to in ("user", "assistant"):
                    yield from go(i + 1, cost + 1 + extra, audit + "R", [*lines, (to, text)])
        for to in ("user", "assistant"):
            yield from go(i, cost + 5, audit + "I", [*lines, (to, "")])
    return go(0, 0, "", [])


def _faults(rows):
    seen, out = set(), []
    for role, text in rows:
        bare = re.sub(r"[\x20\x09-\x0D]+$", "", text)
        out.append((role, text, "blank" if not re.search(r"[^\x20\x09-\x0D]", text) else "duplicate" if (role, text) in seen
                    else "truncated" if bare[-1] not in ".!?" else ""))
        seen.add((role, text))
    return out


def _damage(table):
    """Rows per conversation after damage, in order."""
    out = {}
    for conv, turn, role, text in table:
        rows = out.setdefault(conv, [])
        space = lambda v: " " if v is None else str(v)
        fate = zlib.crc32(f"{space(conv)}:{space(turn)}".encode()) % 20
        role, text = space(role), space(text)
        if fate == 0:
            continue
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        rows += [(turn, "user" if fate == 4 else role, text)] * (2 if fate == 3 else 1)
    order = lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode())
    return {c: sorted(rows, key=order) for c, rows in out.items()}


def _expected(rows, solve):
    turns = {t for t, _, _ in rows if t is not None}
    kinds = _faults([(r, t) for _, r, t in rows])
    count = lambda k: sum(kind == k for _, _, kind in kinds)
    illegal = sum((a[1][:1] or " ") + (b[1][:1] or " ") not in ("su", "ua", "au") for a, b in itertools.pairwise(rows))
    cost, audit, lines = solve(kinds)
    return (max(turns) - min(turns) + 1 - len(turns) if turns else 0, count("blank"), count("duplicate"), count("truncated"), illegal,
            cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in lines).encode()).hexdigest())


def _dynamic(kinds):
    """Plain shortest edits over the four places of the pattern, any length."""
    nexts = {("0", "s"): "s", ("0", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    names = {"u": "user", "a": "assistant"}

    def fill(front):
        for _ in range(4):
            for at, (c, x, lines) in list(front.items()):
                for s in names:
                    to = nexts.get((at, s))
                    if to and (to not in front or (c + 5, x + "I") < front[to][:2]):
                        front[to] = (c + 5, x + "I", [*lines, (names[s], "")])
        return front
    front = fill({"0": (0, "", [])})
    for role, text, kind in kinds:
        after = {}
        for at, (c, x, lines) in front.items():
            moves = [(at, c + 2, x + "D", lines)]
            if kind not in ("blank", "duplicate"):
                e = 5 * (kind == "truncated")
                moves.append((nexts.get((at, role[:1])), c + e, x + "K", [*lines, (role, text)]))
                moves += [(nexts.get((at, s)), c + 1 + e, x + "R", [*lines, (names[s], text)]) for s in names]
            for to, *new in moves:
                if to and (to not in after or (new[0], new[1]) < after[to][:2]):
                    after[to] = tuple(new)
        front = fill(after)
    return min((v for k, v in front.items() if k in "0a"), key=lambda v: v[:2])


def test_parser_finds_the_least_edits():
    rng = random.Random(4)
    for n in (0, 1, 2, 3, 4, 4, 5) * 12:
        rows = [(rng.choice(["system", "user", "assistant", "tool", " "]), rng.choice(["Yes.", "No.", "cut", "", f"{i}!", f"{i}?"])) for i in range(n)]
        kinds = _faults(rows)
        cost, audit, lines = min(_repairs(kinds), key=lambda r: r[:2])
        letters = "".join((r[0] if r[0] in "sua" else "-") + {"blank": "d", "duplicate": "d", "truncated": "t", "": "k"}[k] for r, _, k in kinds)
        assert rr.cheapest(letters) == (cost, audit)
        assert rr.best(rr.transfer(letters))[:2] == (cost, audit)
        cuts = sorted(rng.choices(range(n + 1), k=2))
        parts = [letters[2 * a:2 * b] for a, b in zip([0, *cuts], [*cuts, n])]
        assert rr.best(rr.fold([rr.transfer(p) for p in parts]))[:2] == (cost, audit)
        assert [(r, t) for _, r, t in rr.repaired(audit, rows)] == lines
        assert _dynamic(kinds)[:2] == (cost, audit)


def _rows():
    """Edge rows: nulls, repeats, ties, unknown roles, a conversation over all partitions, one dropped whole."""
    rng = random.Random(9)
    rows = [(1, 0, "system", "Be kind."), (1, 1, "user", "Hi!"), (1, 2, "assistant", "Hello."), (1, 2, "assistant", "Hello."), (1, 5, "user", None),
            (None, 0, "user", "Q?"), (None, None, "assistant", "A."), (None, 3, None, "x"), (2, None, "user", "a."), (2, None, "assistant", "b."),
            (3, 1, "", "no role."), (3, 2, "tool", "other."), (4, 1, "user", " \t\n"), (5, -4, "user", "q" * 70000 + "."), (5, 9, "assistant", "ok.")]
    gone = next(i for i in range(100, 10**6) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    rows.append((gone, 0, "user", "Dropped."))
    rows += [(7, t // 2, rng.choice(["system", "user", "assistant", "user", "assistant"]), rng.choice(["Yes.", f"Turn {t}.", f"cut {t}", "No!"])) for t in range(3000)]
    rows += [(i, t, ("user", "assistant")[t % 2], f"{i} {t}.") for i in range(20, 60) for t in range(rng.randint(1, 7))]
    rng.shuffle(rows)
    return rows


@pytest.fixture(scope="module")
def edge(spark):
    return spark.createDataFrame([(*r, "clash", "clash", 1, 2) for r in _rows()], SCHEMA).repartition(4)


COLUMNS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def _check(got, table):
    want = {c: _expected(rows, _dynamic) for c, rows in _damage(table).items()}
    assert len(got) == len(want)
    assert {r.conv_id: tuple(r[c] for c in COLUMNS) for r in got} == want


def test_query_matches_brute_force(spark, edge):
    got = rr.repaired_conversations(spark, edge).collect()
    _check(got, _rows())
    long = next(r for r in got if r.conv_id == 7)
    assert len(long.audit) >= 2500


def test_query_on_the_given_table(spark):
    table = spark.read.parquet(f"{SMALL}/conversations.parquet")
    _check(rr.repaired_conversations(spark, table).collect(), [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()])


def test_pieces_join_over_levels(spark, edge, monkeypatch):
    """One conversation over more partitions than a group joins at once."""
    rows = [r for r in _rows() if r[0] == 7]
    monkeypatch.setattr(rr, "FAN", 2)
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        _check(rr.repaired_conversations(spark, edge.where("conv_id = 7")).collect(), rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def test_repaired_rows_give_the_digest(spark, edge):
    with Scratch(spark, "test-repair") as scratch:
        lines = rr.repaired_rows(spark, rr.damaged(edge), scratch).orderBy("conv", "part", "at").collect()
    texts = {}
    for r in lines:
        texts.setdefault(r.conv, []).append(f"{r.role}:{r.text}")
    for r in rr.repaired_conversations(spark, edge).collect():
        key = "" if r.conv_id is None else f"={r.conv_id}"
        assert hashlib.sha256("\n".join(texts.get(key, [])).encode()).hexdigest() == r.repaired_sha256
    assert {r.edit for r in lines} <= {"K", "R", "I"}


def test_no_conversations(spark):
    assert rr.repaired_conversations(spark, spark.createDataFrame([], SCHEMA)).count() == 0
