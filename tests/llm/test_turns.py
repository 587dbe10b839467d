"""Conversations repaired and conversation tries, against brute force."""

import collections
import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from diagarc.llm import prefix_trie, turn_repair

SMALL = "/root/testdata/sf0.001"
TURNS = "conv_id bigint, turn bigint, role string, text string"


def in_order(rows):
    return sorted(rows, key=lambda r: ((r[1] is not None, r[1] or 0), r[2], r[3]))


@pytest.fixture(scope="module")
def odd():
    """Nulls everywhere, repeated rows, equal numbers, a long text, and names as operators use them."""
    rows = [(1, None, "user", "Hi."), (1, 0, None, "what"), (1, 0, "assistant", None), (1, 3, "", "Empty role."), (2, 1, "user", "a."), (2, 1, "user", "a."),
            (None, 1, "user", "No id."), (None, None, "tool", " \t\n"), (3, 7, "system", "x" * 100_000), (4, -5, "assistant", "é. "), (-7, 0, "user", "a."), (-7, 1, None, None)]
    draw = random.Random(3)
    for conv in itertools.chain(range(100, 160), range(200, 204), range(301, 309)):
        for turn in range(draw.choice([1, 2, 3, 9])):
            rows.append((conv, turn * draw.choice([1, 1, 1, 2]), draw.choice(["user", "assistant", "assistant", "system", "user"]), draw.choice(["Yes.", "No", "", "Why?", "So be it!  "])))
    return rows


def with_clashes(spark, rows):
    df = spark.createDataFrame(rows, TURNS)
    for name in ("path", "head", "node", "n", "owner", "shard", "times", "base", "heads", "chars"):
        df = df.withColumn(name, F.lit("clash"))
    return df


def all_repairs(turns):
    """Cheapest cost and edits over every sequence of edits, with at most two inserts in a row."""
    best = (10**9, "")

    def legal(roles):
        return re.fullmatch("(s?(ua)+)?", roles)

    gaps = list(itertools.product(("", "u", "a", "ua", "au"), repeat=len(turns) + 1))
    for edits in itertools.product("KUAD", repeat=len(turns)):
        if any(f in ("b", "d") and e != "D" for e, (_, f) in zip(edits, turns)):
            continue
        own = [r if e == "K" else "" if e == "D" else e.lower() for e, (r, _) in zip(edits, turns)]
        if any(e == "K" and (not r or r not in "sua") for e, (r, _) in zip(edits, turns)):
            continue
        price = sum({"K": 0, "D": 4}.get(e, 3) + 3 * (f == "t" and e != "D") for e, (_, f) in zip(edits, turns))
        letters = ["R" if e in "UA" else e for e in edits]
        for put in gaps:
            if price + 3 * sum(map(len, put)) <= best[0] and legal("".join(p + o for p, o in zip(put, [*own, ""]))):
                best = min(best, (price + 3 * sum(map(len, put)), "".join("I" * len(p) + e for p, e in zip(put, [*letters, ""]))))
    return best


def test_branch_and_bound_is_exact():
    draw = random.Random(5)
    for n in (0, 1, 2, 3, 3, 4) * 12:
        turns = [(draw.choice(["u", "a", "a", "s", "", " "]), draw.choice(["", "", "", "b", "d", "t"])) for _ in range(n)]
        assert turn_repair.cheapest(turns)[:2] == all_repairs(turns)


def by_columns(turns):
    """The same by a table of the best (cost, edits) per number of turns read and state."""
    labels = {0: (0, "")}

    def inserted(at):
        for _ in range(2):
            for state, (cost, edits) in list(at.items()):
                to = turn_repair._OTHER[state]
                at[to] = min(at.get(to, (10**9, "")), (cost + 3, edits + "I"))
        return at

    for role, fault in turns:
        after = {}
        for state, (cost, edits) in inserted(labels).items():
            steps = [(state, 4, "D")]
            if fault not in ("b", "d"):
                extra = 3 * (fault == "t")
                steps.append((turn_repair._OTHER[state], 3 + extra, "R"))
                if (state, role) in turn_repair._TURN:
                    steps.append((turn_repair._TURN[state, role], extra, "K"))
            for to, price, letter in steps:
                after[to] = min(after.get(to, (10**9, "")), (cost + price, edits + letter))
        labels = after
    labels = inserted(labels)
    return min(labels[k] for k in (0, 3) if k in labels)


@pytest.mark.parametrize("roles", ["ua", "uuaas", "us", "sssua", "a"])
def test_long_conversations_need_few_nodes(roles):
    draw = random.Random(len(roles))
    turns = [(draw.choice(roles), draw.choice([""] * 12 + ["b", "d", "t"])) for _ in range(3000)]
    cost, audit, expanded = turn_repair.cheapest(turns)
    assert (cost, audit) == by_columns(turns) and expanded < 10 * len(turns)


def repaired(rows):
    """What the contract asks of damaged rows, by plain Python and the table above."""
    out, groups = [], collections.defaultdict(list)
    space = "\x20\x09\x0a\x0b\x0c\x0d"
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        groups[conv].extend([(conv, turn, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1))
    for conv, own in groups.items():
        own, seen, turns = in_order(own), set(), []
        for _, _, role, text in own:
            fault = "b" if not text.strip(space) else "d" if (role, text) in seen else "" if text.rstrip(space)[-1] in ".!?" else "t"
            seen.add((role, text))
            turns.append((role[:1], fault))
        numbers = {t for _, t, _, _ in own if t is not None}
        cost, audit = by_columns(turns)
        lines, state, at = [], 0, 0
        for letter in audit:
            if letter in "IR":
                state = turn_repair._OTHER[state]
                lines.append(("user:" if state == 2 else "assistant:") + (own[at][3] if letter == "R" else ""))
            elif letter == "K":
                state = turn_repair._TURN[state, turns[at][0]]
                lines.append(own[at][2] + ":" + own[at][3])
            at += letter != "I"
        count = collections.Counter(f for _, f in turns)
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        out.append((conv, max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0, count["b"], count["d"], count["t"], illegal, cost, audit,
                    hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=str)


def test_repair_of_odd_rows(spark, odd):
    got = turn_repair.repair(turn_repair.damaged(with_clashes(spark, odd))).drop("n_expanded").collect()
    assert sorted(map(tuple, got), key=str) == repaired(odd)


def test_repair_buffers_long_texts(spark, monkeypatch):
    monkeypatch.setattr(turn_repair, "HELD", 10)
    rows = [(1, i, "user" if i % 2 == 0 else "assistant", f"Text {i} of some length.") for i in range(30)]
    one = turn_repair._Conversation(1)
    for _, number, role, text in rows:
        one.add(number, role, text)
    assert one.row()[:9] == (1, 0, 0, 0, 0, 0, 0, "K" * 30, hashlib.sha256("\n".join(f"{r}:{t}" for _, _, r, t in rows).encode()).hexdigest())


def test_dropped_conversations_and_empty_tables(spark):
    lost = next(c for c in range(10_000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    rows = [(lost, 0, "user", "Gone.")]
    assert [tuple(r)[1:9] for r in turn_repair.repair(turn_repair.damaged(spark.createDataFrame(rows, TURNS))).collect()] == [(0,) * 6 + ("", hashlib.sha256().hexdigest())]
    none = spark.createDataFrame([], TURNS)
    assert turn_repair.repair(turn_repair.damaged(none)).collect() == [] and prefix_trie.trie(prefix_trie.rebuilt(prefix_trie.paths(none))).collect() == []


# Tries.

def rebuilt(rows):
    own = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn, role or "", text or ""))
    digest = lambda role, text: hashlib.sha256(f"{len(role)}:{role}:{text}".encode()).digest()[:16]
    path = {c: [t[1:] for t in sorted(ts, key=lambda t: (t[0] is not None, t[0] or 0, digest(*t[1:])))] for c, ts in own.items()}
    out = {}
    for c, turns in path.items():
        h = zlib.crc32(str(c).encode()) % 6
        block = c - (c % 100 if c >= 0 else -(-c % 100))
        out[c] = path.get(block, [])[:h] + turns[h:]
    return out


def whole_trie(convs):
    members = collections.defaultdict(list)
    for c, path in sorted(convs.items()):
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(c)
    inner = {node[:-1] for node in members if node}
    saved, leaves = collections.Counter(), collections.Counter()
    for node, own in members.items():
        for d in range(len(node) + 1):
            saved[node[:d]] += (len(own) - 1) * (len(node[-1][1]) if node else 0)
            leaves[node[:d]] += node not in inner
    children = collections.Counter(node[:-1] for node in members if node)
    return sorted(((own[0], len(node), members[node[:-1]][0] if node else None, len(own), children[node], leaves[node], saved[node],
                    hashlib.sha256(",".join(str(c) for c in own if len(convs[c]) == len(node)).encode()).hexdigest()) for node, own in members.items()), key=str)


def found_trie(df):
    return sorted(map(tuple, prefix_trie.trie(prefix_trie.rebuilt(prefix_trie.paths(df))).collect()), key=str)


@pytest.mark.parametrize("members", [3, 4096])
def test_trie_of_odd_rows(spark, odd, monkeypatch, members):
    monkeypatch.setattr(prefix_trie, "MEMBERS", members)
    assert found_trie(with_clashes(spark, odd)) == whole_trie(rebuilt(odd))


def test_trie_of_many_equal_conversations(spark):
    """A third of all conversations have one path, longer than the turns that order them."""
    rows = [(c, t, "user" if t % 2 == 0 else "assistant", f"turn {t}") for c in range(1000, 1400) for t in range(12)]
    rows += [(c, t, "user", f"turn {t} of {c if t > 9 else c % 3}") for c in range(1400, 1900) for t in range(c % 14)]
    assert found_trie(spark.createDataFrame(rows, TURNS)) == whole_trie(rebuilt(rows))


def test_shard_nodes_without_turns():
    assert list(prefix_trie.shard_nodes([4, 9], [[], []], [[], []])) == [(prefix_trie.ROOT, None, 0, 2, 4, 0, False, [4, 9], [])]
