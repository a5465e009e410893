"""Conversation repair against brute force, and its search against all edit strings."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from cohortflow.llm import conversation_repair as C
from cohortflow.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
PATTERN = re.compile(r"(s?(ua)+)?")
COST = {"K": 0, "R": 3, "D": 4, "I": 3}


def rank(v):
    return (v is not None, v if v is not None else 0)


def replay(rows, edits):
    """(cost, repaired rows) of an edit string on [(role, text, fault)], or None where it isn't allowed."""
    cost, out, k = 0, [], 0
    initials = ""

    def made_up():
        return "a" if initials.endswith("u") else "u"

    for e in edits:
        cost += COST[e]
        if e == "I":
            initials += made_up()
            out.append(({"u": "user", "a": "assistant"}[initials[-1]], ""))
            continue
        if k == len(rows):
            return None
        role, text, fault = rows[k]
        k += 1
        if e == "D":
            continue
        if fault in ("blank", "duplicate"):
            return None
        cost += 3 * (fault == "truncated")
        if e == "K":
            if not role:
                return None
            initials += role[0]
            out.append((role, text))
        else:
            initials += made_up()
            out.append(({"u": "user", "a": "assistant"}[initials[-1]], text))
    return (cost, out) if k == len(rows) and PATTERN.fullmatch(initials) else None


def all_strings(rows):
    """The cheapest, then ASCII-least, of all edit strings with up to four insertions."""
    found = []
    for n in range(len(rows), len(rows) + 5):
        for places in itertools.combinations(range(n), n - len(rows)):
            for letters in itertools.product("DKR", repeat=len(rows)):
                it = iter(letters)
                edits = "".join("I" if p in places else next(it) for p in range(n))
                if (r := replay(rows, edits)) is not None:
                    found.append((r[0], edits, r[1]))
    return min(found, key=lambda x: x[:2])


def cheapest(rows):
    """The same by a table over whole strings, for longer conversations."""
    best = {"": (0, "")}  # by the shape of the initials: "", "s", "u", "a"
    steps = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}

    def add(to, state, cost, edits):
        if state not in to or (cost, edits) < to[state]:
            to[state] = (cost, edits)

    def insert(b):
        for _ in range(4):
            for s, (c, e) in list(b.items()):
                add(b, "a" if s == "u" else "u", c + 3, e + "I")

    for role, _, fault in rows:
        insert(best)
        after = {}
        for s, (c, e) in best.items():
            add(after, s, c + 4, e + "D")
            if fault not in ("blank", "duplicate"):
                more = 3 * (fault == "truncated")
                if (s, role[:1]) in steps:
                    add(after, steps[s, role[:1]], c + more, e + "K")
                add(after, "a" if s == "u" else "u", c + 3 + more, e + "R")
        best = after
    insert(best)
    cost, edits = min(best[s] for s in ("", "a") if s in best)
    assert replay(rows, edits)[0] == cost
    return cost, edits, replay(rows, edits)[1]


def faults(rows):
    seen, out = set(), []
    for role, text in rows:
        told = text.rstrip(" \t\n\x0b\x0c\r")
        fault = "blank" if not told else "duplicate" if (role, text) in seen else None if told[-1] in ".!?" else "truncated"
        seen.add((role, text))
        out.append((role, text, fault))
    return out


def brute(table):
    """The contract over rows (conv_id, turn, role, text)."""
    by = {}
    for conv, turn, role, text in sorted(table, key=lambda r: (rank(r[1]), (r[2] or " ").encode() if r[2] is not None else b" ", (r[3] if r[3] is not None else " ").encode())):
        by.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        way = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if way == 4:
            role = "user"
        text = "" if way == 1 else re.sub("[.!?]", "", text) if way == 2 else text
        by[conv] += [(turn, role, text)] * (0 if way == 0 else 2 if way == 3 else 1)
    out = {}
    for conv, rows in by.items():
        rows.sort(key=lambda r: (rank(r[0]), r[1].encode(), r[2].encode()))
        turns = [t for t, _, _ in rows if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        marked = faults([r[1:] for r in rows])
        kinds = [f for _, _, f in marked]
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(marked))
        cost, edits, fixed = cheapest(marked)
        sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in fixed).encode()).hexdigest()
        out[conv] = (gaps, kinds.count("blank"), kinds.count("duplicate"), kinds.count("truncated"), illegal, cost, edits, sha)
    return out


def search(rows):
    paths, edits = C.Survivors(), []
    for role, _, fault in rows:
        paths.read(role, fault)
        edits += paths.settled()
    return "".join(e for e, _ in [*edits, *paths.end()])


def test_search_equals_all_edit_strings():
    rng = random.Random(3)
    for _ in range(250):
        rows = [(rng.choice(["user", "assistant", "system", "tool", ""]), "x", rng.choice([None, None, None, "truncated", "blank", "duplicate"])) for _ in range(rng.randint(0, 4))]
        want = all_strings(rows)
        assert cheapest(rows)[:2] == want[:2]
        assert search(rows) == want[1], rows


def test_search_equals_the_table_and_holds_few_rows():
    rng = random.Random(4)
    for n in (5, 30, 400):
        for roles in (["user", "assistant"], ["user", "assistant", "system"], ["assistant"], ["system", "user"], ["user"], ["tool", "system"]):
            rows = [(rng.choice(roles), "x", rng.choice([None, None, "truncated", "blank"])) for _ in range(n)]
            assert search(rows) == cheapest(rows)[1]
    paths, held, most = C.Survivors(), 0, 0
    for k in range(20000):
        paths.read(("user", "assistant")[rng.random() < 0.5], rng.choice([None, "truncated", "blank"]))
        held += 1 - sum(e != "I" for e, _ in paths.settled())
        most = max(most, held)
    assert most < 60


@pytest.fixture(scope="module")
def conversations():
    rng = random.Random(6)
    texts = ["Yes.", "No!", "Why?", "cut of", "", "  \n", "x. ", None, "long " * 30000 + ".", "é ü.", "Yes.", "a:b\nc."]
    rows = []
    for conv in [*range(150), None]:
        for turn in range(rng.randint(1, 9)):
            turn = None if rng.random() < 0.05 else turn * rng.choice([1, 1, 1, 2])
            rows.append((conv, turn, rng.choice(["user", "assistant", "user", "assistant", "system", None, "tool", ""]), rng.choice(texts)))
    rows += rows[10:20]
    rows += [(1000, k, ("user", "assistant")[k % 2], f"Turn {k}.") for k in range(3000)]  # one very long conversation
    dropped = next(k for k in range(10000) if zlib.crc32(f"2000:{k}".encode()) % 20 == 0)
    return [*rows, (2000, dropped, "user", "gone.")]


def test_op11_equals_brute_force(spark, tmp_path, conversations):
    df = spark.createDataFrame([(*r, 1, "x", 2) for r in conversations], "conv_id long, turn long, role string, text string, copy int, fault string, same int")
    df.repartition(5).write.parquet(f"{tmp_path}/conversations.parquet")
    got = [tuple(r) for r in QUERIES["op11_conversation_repair"](spark, str(tmp_path)).collect()]
    want = brute(conversations)
    assert len(got) == len(want)
    assert {r[0]: r[1:] for r in got} == want


def test_op11_on_the_given_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert {r[0]: tuple(r)[1:] for r in QUERIES["op11_conversation_repair"](spark, SMALL).collect()} == brute(rows)


def test_op11_empty_table(spark, tmp_path):
    spark.createDataFrame([], "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    df = QUERIES["op11_conversation_repair"](spark, str(tmp_path))
    assert df.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"] and df.collect() == []


def test_edits_give_the_repaired_rows(spark):
    rows = [(1, 0, "user", "Hi.", 0, False), (1, 1, "user", "Hi.", 0, False), (1, 2, "user", "More?", 0, False)]
    edits = C.repair(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, copy int, dropped boolean")).where("edit IS NOT NULL").collect()
    assert [(e.edit, e.role, e.text) for e in edits] == [("K", "user", "Hi."), ("D", None, "Hi."), ("R", "assistant", "More?")]
