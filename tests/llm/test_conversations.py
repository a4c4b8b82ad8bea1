"""Conversation repair against a search over whole strings, and histories against strings."""

import hashlib
import random
import re
import zlib
from collections import defaultdict
from itertools import product

import pytest

from roster.llm import conversations
from roster.llm.conversations import damaged, repair_conversations
from roster.llm.edit_history import History, common_size, less, rebased, shared_beginning
from tests.llm.conftest import LONG, SF

NEXT = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
GAPS = " \t\n\x0b\x0c\r"


def broken(rows):
    """{conversation: its rows after the damage of the contract}"""
    found = defaultdict(list)
    for conv_id, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}".encode()) % 20
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(kind, text)
        found[conv_id] += [(turn, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return found


def searched(rows):
    """The numbers, the audit and the digest of one conversation; every state keeps its whole strings."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    faults, seen = [], set()
    for _, role, text in rows:
        bare = text.strip(GAPS)
        faults.append("b" if not bare else "d" if (role, text) in seen else "t" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    best = {"": (0, "", ())}

    def offer(states, place, state):
        if place is not None and (place not in states or state[:2] < states[place][:2]):
            states[place] = state

    def insert(states):
        for _ in range(4):
            for place, (cost, audit, lines) in list(states.items()):
                for role in ("user", "assistant"):
                    offer(states, NEXT.get((place, role[0])), (cost + 2, audit + "I", (*lines, role + ":")))

    insert(best)
    for (_, role, text), fault in zip(rows, faults):
        after = {}
        for place, (cost, audit, lines) in best.items():
            offer(after, place, (cost + 3, audit + "D", lines))
            if fault in ("b", "d"):
                continue
            cost += fault == "t"
            offer(after, NEXT.get((place, role[:1])), (cost, audit + "K", (*lines, f"{role}:{text}")))
            for new in ("user", "assistant"):
                offer(after, NEXT.get((place, new[0])), (cost + 2, audit + "R", (*lines, f"{new}:{text}")))
        best = after
        insert(best)
    cost, audit, lines = min((best[p] for p in ("", "a") if p in best), key=lambda s: s[:2])
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    counts = [faults.count(f) for f in "bdt"]
    return (gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def assert_searched(df):
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in df.select("conv_id", "turn", "role", "text").collect()]
    got = repair_conversations(damaged(df)).collect()
    assert {r.conv_id: tuple(r)[1:] for r in got} == {c: searched(rs) for c, rs in broken(rows).items()}
    assert len(got) == len({r[0] for r in rows})


def cheapest(initials):
    """The cheapest audit by trying all edits of a short conversation of sound turns."""
    right = re.compile("(s?(ua)+)?")
    found = []
    choices = [["K" + i, "Ru", "Ra", "D"] for i in initials]
    fills = ["", "u", "a", "ua", "au"]
    for edits in product(*choices):
        for inserts in product(fills, repeat=len(initials) + 1):
            roles, audit, cost = inserts[0], "I" * len(inserts[0]), 2 * len(inserts[0])
            for edit, more in zip(edits, inserts[1:]):
                roles += edit[1:] + more
                audit += edit[0] + "I" * len(more)
                cost += {"K": 0, "R": 2, "D": 3}[edit[0]] + 2 * len(more)
            if right.fullmatch(roles):
                found.append((cost, audit))
    return min(found)


@pytest.fixture
def talks(spark):
    def build(rows, id_type="long"):
        schema = f"conv_id {id_type}, turn int, role string, text string, kind int, gone boolean, empty string, open int, _ string"
        return spark.createDataFrame([(*r, 1, True, "x", 2, "y") for r in rows], schema)

    return build


def test_whole_table(spark):
    assert_searched(spark.read.parquet(f"{SF}/conversations.parquet"))


def test_odd_rows(talks):
    pick = random.Random(2)
    roles = ["user", "assistant", "system", "tool", "", None, "u", "Ünder"]
    texts = ["Yes.", "no", "", " \n", None, "What?!", "é", "x . \t", "...", LONG + "."]
    rows = [
        (pick.choice([*range(60), None]), pick.choice([*range(12), -5, None]), pick.choice(roles[: pick.choice([2, 3, 8])]), pick.choice(texts))
        for _ in range(900)
    ]
    assert_searched(talks(rows + rows[:40]))


def test_names_as_ids(talks):
    assert_searched(talks([(c, t, r, "Well.") for c in ("a", "ä b", "", None) for t, r in enumerate(["user", "assistant", "user"])], "string"))


def test_conversations_without_rows(talks):
    assert repair_conversations(damaged(talks([]))).collect() == []
    gone = [(c, 0, "user", "Hm.") for c in range(400) if zlib.crc32(f"{c}:0".encode()) % 20 == 0]
    rows = repair_conversations(damaged(talks(gone))).collect()
    assert len(rows) == len(gone) > 5
    assert {tuple(r)[1:] for r in rows} == {(0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


def test_all_edits_of_short_conversations():
    for n in range(4):
        for initials in product("suat", repeat=n):
            rows = [(i, {"s": "system", "u": "user", "a": "assistant", "t": "tool"}[x], f"No {i}.") for i, x in enumerate(initials)]
            assert searched(rows)[5:7] == cheapest(initials)


def test_long_conversations_are_decided_on_the_way(monkeypatch):
    monkeypatch.setattr(conversations, "RECHECK", 5)
    pick = random.Random(3)
    for _ in range(200):
        rows = [(i, pick.choice(["user", "assistant", "user", "system"]), pick.choice(["One.", "two", f"{i}."])) for i in range(pick.randint(0, 60))]
        talk = conversations._Conversation(1)
        for turn, role, text in rows:
            talk.add(turn, role, text, False, text[-1] not in ".!?")
        assert talk.result()[1:] == searched(rows)
    talk = conversations._Conversation(1)
    for i in range(5000):
        talk.add(i, pick.choice(["user", "assistant"]), f"{i}.", False, False)
    assert len(talk.rows) < 100 and max(len(held[1].up) for held in talk.best if held) < 10


def test_histories_compare_as_strings():
    pick, made = random.Random(5), [("", History())]
    for _ in range(300):
        text, history = pick.choice(made[-6:] if pick.random() < 0.7 else made)
        letter = pick.choice("DIKR")
        made.append((text + letter, History(letter, history)))
    assert all(h.letters() == t for t, h in made)
    for _ in range(2000):
        (s, a), (t, b) = pick.choice(made), pick.choice(made)
        common = next((i for i, (x, y) in enumerate(zip(s, t)) if x != y), min(len(s), len(t)))
        assert common_size(a, b) == common and less(a, b) == (s < t)
        assert shared_beginning([a, b]).size == common
        root, (c, d) = rebased([a, b], common)
        assert less(c, d) == (s < t) and c.letters(common) == s[common:] and root.size == common


def test_equal_hashes_are_verified():
    base = History("K", History())
    a, b = History("D", base), History("I", base)
    b.code = a.code
    assert common_size(a, b) == 1 and less(a, b) and not less(b, a)
