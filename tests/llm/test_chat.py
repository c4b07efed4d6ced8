import heapq
import random
import re
from collections import Counter
from itertools import product

from affinis.llm import chat

MACHINE = chat.Automaton()


def cheapest(roles):
    """Cost of the cheapest repair, by search over turns read and states."""
    done, todo = set(), [(0.0, 0, chat.START)]
    while todo:
        cost, i, state = heapq.heappop(todo)
        if (i, state) in done:
            continue
        done.add((i, state))
        if i == len(roles) and state in chat.ACCEPTED:
            return cost
        for role in (chat.SYSTEM, chat.USER, chat.ASSISTANT):
            legal = (state, role) in chat.LEGAL
            if legal:
                heapq.heappush(todo, (cost + 3, i, role))
            if i < len(roles):
                change = 0 if roles[i] == role else 2
                if legal:
                    heapq.heappush(todo, (cost + change, i + 1, role))
                if state == role:
                    heapq.heappush(todo, (cost + change + 1, i + 1, role))


def test_costs_are_minimal():
    for length in range(1, 6):
        for roles in product((chat.SYSTEM, chat.USER, chat.ASSISTANT, None), repeat=length):
            assert MACHINE.trace(list(roles), chat.START, MACHINE.ending())[1] == cheapest(roles)


SCHEMA = "conv_id long, turn long, role string, text string, segment string"


def run(spark, rows):
    return chat.repaired(spark.createDataFrame(rows, SCHEMA)).collect()


def rendered(pieces, conv):
    return "".join(r.rendered for r in sorted((r for r in pieces if r.conv_id == conv), key=lambda r: (r.segment, r.place)))


def test_rendering(spark):
    rows = [
        (1, 0, "system", "S", "x"), (1, 1, "user", "A", "x"), (1, 2, "user", "B", "x"), (1, 3, "assistant", "C", "x"),
        (2, 0, "assistant", "hello", None), (3, 0, "user", None, None), (None, 0, "user", "lost", None),
        (4, 1, "assistant", "second", None), (4, 0, "user", "first", None), (5, 0, "bot", "?", None), (6, None, "user", "", None),
        (7, 0, "user", "same", None), (7, 0, "user", "same", None),
    ]
    out = run(spark, rows)
    assert rendered(out, 1) == "<|system|>\nS<|end|>\n<|user|>\nA\nB<|end|>\n<|assistant|>\nC<|end|>\n"
    assert {r.action: r.cost for r in out if r.conv_id == 2} == {"relabel": 2.0}
    assert rendered(out, 3) == "<|user|>\n<|end|>\n"
    assert rendered(out, 4) == "<|user|>\nfirst<|end|>\n<|assistant|>\nsecond<|end|>\n"
    assert rendered(out, 5) == "<|user|>\n?<|end|>\n"
    assert rendered(out, 6) == "<|user|>\n<|end|>\n"
    assert rendered(out, 7) == "<|user|>\nsame\nsame<|end|>\n"
    assert {r.conv_id for r in out} == set(range(1, 8))


def test_empty_table(spark):
    assert run(spark, []) == []


def test_segments_give_the_same_repair(spark, monkeypatch):
    roles = ["user", "user", "assistant", "system", "assistant", None, "user", "assistant", "assistant", "user"] * 5
    rows = [(1, i, r, str(i), None) for i, r in enumerate(roles)]
    whole = run(spark, rows)
    monkeypatch.setattr(chat, "SEGMENT", 7)
    parts = run(spark, rows)
    assert len({r.segment for r in parts}) == 8
    numbers = [chat.ROLES.get(r) for r in roles]
    assert {r.cost for r in whole} == {r.cost for r in parts} == {cheapest(numbers)}
    assert rendered(whole, 1) == rendered(parts, 1)


def replayed(pieces, conv, turns):
    """Checks one conversation's pieces by themselves: a legal sequence, every turn once and in order, at the cheapest cost."""
    own = sorted((r for r in pieces if r.conv_id == conv), key=lambda r: (r.segment, r.place))
    blocks = re.findall(r"<\|(\w+)\|>\n(.*?)<\|end\|>\n", rendered(pieces, conv), flags=re.S)
    assert "".join(f"<|{role}|>\n{text}<|end|>\n" for role, text in blocks) == rendered(pieces, conv)
    states = [chat.START, *(chat.ROLES[role] for role, _ in blocks)]
    assert all(step in chat.LEGAL for step in zip(states, states[1:], strict=False)) and states[-1] in chat.ACCEPTED
    expected, made = [], 0.0
    for r in own:
        if r.action == "insert":
            expected.append((r.role, ""))
            made += 3
            continue
        role, text = turns[sum(p.action != "insert" for p in own[: own.index(r)])]
        made += 2 * ("relabel" in r.action) + ("merge" in r.action)
        assert ("relabel" in r.action) == (role != r.role)
        if "merge" in r.action:
            expected[-1] = (r.role, f"{expected[-1][1]}\n{text}")
        else:
            expected.append((r.role, text))
    assert blocks == expected and sum(r.action != "insert" for r in own) == len(turns)
    assert {r.cost for r in own} == {made} == {cheapest([chat.ROLES.get(role) for role, _ in turns])}


def test_sequences_against_search(spark, monkeypatch):
    """Random conversations, at a segment size that takes several levels."""
    monkeypatch.setattr(chat, "SEGMENT", 3)
    drawn = random.Random(7)
    turns = {c: [(drawn.choice(["system", "user", "user", "assistant", "assistant", "bot", None]), f"t{c}-{i}") for i in range(1 + c * c)] for c in range(8)}
    pieces = run(spark, [(c, 10 * i - 5, role, text, "x") for c, own in turns.items() for i, (role, text) in enumerate(own)])
    assert {r.conv_id for r in pieces} == set(turns)
    for c, own in turns.items():
        replayed(pieces, c, own)


def test_one_number_is_cut_by_position(spark, monkeypatch):
    """A conversation of one repeated turn number, or of none, is many segments; equal rows as well."""
    monkeypatch.setattr(chat, "SEGMENT", 5)
    rows = [(1, 4, "user", "same", None)] * 60 + [(1, None, "assistant", "last", None)] * 23 + [(2, 0, "user", "x", None)]
    pieces = run(spark, rows)
    turns = [("user", "same")] * 60 + [("assistant", "last")] * 23
    replayed(pieces, 1, turns)
    sizes = Counter(r.segment for r in pieces if r.conv_id == 1 and r.action != "insert")
    assert max(sizes.values()) == 5 and len(sizes) == 17


def test_ties_of_a_number_go_by_role(spark):
    rows = [(1, 0, "bot", "D", None), (1, 0, "assistant", "C", None), (1, 0, "user", "B", None), (1, 0, "system", "A", None)]
    replayed(run(spark, rows), 1, [("system", "A"), ("user", "B"), ("assistant", "C"), ("bot", "D")])
