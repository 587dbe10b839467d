"""Conversations damaged on purpose and repaired at the least cost, by branch and bound.

A repair reads the turns in order and keeps, re-roles or deletes each, and inserts empty turns
anywhere, until the role initials read ``(s?(ua)+)?``. The search of one conversation is
depth-first with an explicit stack. A node is (turns read, role state) with the cost and the edits
that lead to it. It is cut where

* its cost and a lower bound of what the remaining turns cost exceed the incumbent, or equal it
  while its edits are already behind the incumbent's in ASCII order, or
* the dominance table holds a prefix to the same turns and state that is no worse.

The bounds come from a relaxed problem in which any role may end a conversation. When the stack is
empty the incumbent is proved best.

Turns of a conversation are streamed through one task in order, texts beside the search wait in a
buffer that moves to a file of the task when it is large, so that the digest is made without holding
a conversation's texts.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterable, Iterator
from hashlib import blake2b, sha256

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from diagarc.llm.common import table

KEEP, REROLE, DELETE, INSERT = 0, 3, 4, 3
#: Added for a truncated turn that is not deleted.
TRUNCATED = 3
#: Role states: nothing yet, after a system, user or assistant turn. The first and last may end.
START, SYSTEM, USER, ASSISTANT = range(4)
_TURN = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (ASSISTANT, "u"): USER, (USER, "a"): ASSISTANT}
_OTHER = (USER, USER, ASSISTANT, USER)
_BEYOND = 1 << 60
#: Bytes of a conversation's texts held in memory.
HELD = 1 << 24


def suffix_bounds(turns: list[tuple[str, str]]) -> list[tuple[int, int, int, int]]:
    """For each number of turns read and each role state, the least cost of the rest in the relaxed problem."""
    bounds = [(0, 0, 0, 0)]
    for role, fault in reversed(turns):
        late = bounds[-1]
        extra = TRUNCATED if fault == "t" else 0
        best = [DELETE + b for b in late]
        if fault not in ("b", "d"):
            for state in range(4):
                best[state] = min(best[state], REROLE + extra + late[_OTHER[state]])
                if (state, role) in _TURN:
                    best[state] = min(best[state], KEEP + extra + late[_TURN[state, role]])
        best[USER] = min(best[USER], INSERT + best[ASSISTANT])
        bounds.append(tuple(min(best[state], INSERT + best[_OTHER[state]]) for state in range(4)))
    return bounds[::-1]


class _Search:
    """Nodes as parallel lists: parent, edit letter, number of edits."""

    def __init__(self) -> None:
        self.parent, self.letter, self.length = [-1], [""], [0]

    def add(self, parent: int, letter: str) -> int:
        self.parent.append(parent)
        self.letter.append(letter)
        self.length.append(self.length[parent] + 1)
        return len(self.parent) - 1

    def before(self, a: int, b: int) -> bool:
        """Whether the edits to a come before those to b; their common part is not read."""
        one, other = [], []
        while a != b:
            if self.length[a] >= self.length[b]:
                one.append(self.letter[a])
                a = self.parent[a]
            else:
                other.append(self.letter[b])
                b = self.parent[b]
        return one[::-1] < other[::-1]

    def behind(self, a: int, best: list[int]) -> bool:
        """Whether the edits to a are behind as many of the path ``best``, which has a node per length."""
        own, theirs = [], []
        if self.length[a] >= len(best):
            # Longer than a whole repair of the same cost: as far as that goes.
            while self.length[a] >= len(best):
                a = self.parent[a]
        while best[self.length[a]] != a:
            own.append(self.letter[a])
            theirs.append(self.letter[best[self.length[a]]])
            a = self.parent[a]
        return own[::-1] > theirs[::-1]

    def path(self, a: int) -> list[int]:
        nodes = []
        while a >= 0:
            nodes.append(a)
            a = self.parent[a]
        return nodes[::-1]


def cheapest(turns: list[tuple[str, str]]) -> tuple[int, str, int]:
    """Cost, edit letters and number of expanded nodes for turns of (role initial, fault).

    Faults are b (blank), d (duplicate), t (truncated) or nothing; the first two must be deleted.
    Of repairs of the same cost the one whose letters (D, I, K, R) come first in ASCII order is taken.
    """
    n, bounds = len(turns), suffix_bounds(turns)
    search, expanded = _Search(), 0
    best_cost, best = _BEYOND, []
    dominance: dict[tuple[int, int], tuple[int, int]] = {(0, START): (0, 0)}
    stack = [(0, START, 0, 0)]
    while stack:
        read, state, cost, node = stack.pop()
        if dominance[read, state] != (cost, node):
            continue
        bound = cost + bounds[read][state]
        if bound > best_cost or bound == best_cost and search.behind(node, best):
            continue
        expanded += 1
        if read == n and state in (START, ASSISTANT):
            best_cost, best = cost, search.path(node)
            continue
        steps = [(cost + INSERT, "I", read, _OTHER[state])]
        if read < n:
            role, fault = turns[read]
            steps.append((cost + DELETE, "D", read + 1, state))
            if fault not in ("b", "d"):
                extra = TRUNCATED if fault == "t" else 0
                steps.append((cost + REROLE + extra, "R", read + 1, _OTHER[state]))
                if (state, role) in _TURN:
                    steps.append((cost + KEEP + extra, "K", read + 1, _TURN[state, role]))
        # The most promising is searched first, so it goes on the stack last.
        steps.sort(key=lambda s: (s[0] + bounds[s[2]][s[3]], s[1]), reverse=True)
        for total, letter, after, role_state in steps:
            bound = total + bounds[after][role_state]
            known = dominance.get((after, role_state))
            if bound > best_cost or known and total > known[0]:
                continue
            child = search.add(node, letter)
            if known and total == known[0] and not search.before(child, known[1]):
                continue
            if bound == best_cost and search.behind(child, best):
                continue
            dominance[after, role_state] = (total, child)
            stack.append((after, role_state, total, child))
    return best_cost, "".join(search.letter[i] for i in best), expanded


def repaired_roles(turns: list[tuple[str, str]], audit: str) -> Iterator[tuple[str | None, bool]]:
    """The role that each edit leaves and whether it reads a turn: None for a deleted or kept role (the latter's is its own)."""
    state, at = START, 0
    for letter in audit:
        if letter in "IR":
            state = _OTHER[state]
            yield ("user" if state == USER else "assistant"), letter == "R"
        else:
            if letter == "K":
                state = _TURN[state, turns[at][0]]
            yield None, True
        at += letter != "I"


class _Conversation:
    """Facts of the turns seen so far; their texts go to a buffer."""

    def __init__(self, conv_id) -> None:
        self.conv_id, self.turns, self.sizes, self.numbers, self.seen = conv_id, [], [], set(), set()
        self.texts = tempfile.SpooledTemporaryFile(max_size=HELD)

    def add(self, number: int | None, role: str, text: str) -> None:
        own, said = role.encode(), text.encode()
        digest = blake2b(b"%d:" % len(own) + own + said, digest_size=16).digest()
        last = text.rstrip("\x20\x09\x0a\x0b\x0c\x0d")[-1:]
        fault = "b" if not last else "d" if digest in self.seen else "" if last in ".!?" else "t"
        self.seen.add(digest)
        if number is not None:
            self.numbers.add(number)
        self.turns.append((role[:1], fault))
        self.sizes.append((len(own), len(said)))
        self.texts.write(own)
        self.texts.write(said)

    def row(self) -> tuple:
        roles = [r for r, _ in self.turns]
        faults = [f for _, f in self.turns]
        gaps = max(self.numbers) - min(self.numbers) + 1 - len(self.numbers) if self.numbers else 0
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(roles, roles[1:]))
        cost, audit, expanded = cheapest(self.turns)
        digest, first, sizes = sha256(), True, iter(self.sizes)
        self.texts.seek(0)
        for letter, (role, reads) in zip(audit, repaired_roles(self.turns, audit)):
            own, said = b"", 0
            if reads:
                size, said = next(sizes)
                own = self.texts.read(size)
            if letter == "D":
                self.texts.seek(said, 1)
                continue
            digest.update((b"" if first else b"\n") + (own if role is None else role.encode()) + b":")
            first = False
            while said:
                piece = self.texts.read(min(said, HELD))
                digest.update(piece)
                said -= len(piece)
        self.texts.close()
        counts = [sum(f == k for f in faults) for k in "bdt"]
        return (self.conv_id, gaps, *counts, illegal, cost, audit, digest.hexdigest(), expanded)


COLUMNS = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256", "n_expanded")


def _repaired(schema: pa.Schema):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def emit(rows: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

        now, done = None, []
        for batch in batches:
            for conv_id, there, number, role, text in zip(*(c.to_pylist() for c in batch.columns)):
                if now is None or now.conv_id != conv_id:
                    if now is not None:
                        done.append(now.row())
                    now = _Conversation(conv_id)
                if there:
                    now.add(number, role, text)
            if len(done) >= 512:
                yield emit(done)
                done = []
        if now is not None:
            done.append(now.row())
        if done:
            yield emit(done)

    return run


def repair(turns: DataFrame) -> DataFrame:
    """COLUMNS of every conv_id of ``turns`` (conv_id, turn, role, text, and optionally ``there``).

    Turns are taken by number (nulls first), equal numbers by role, then text. Rows that are not
    ``there`` only make their conversation appear: without others it has zeros, no edits and the
    digest of nothing. A null role or text counts as one space, so it is no role that can be kept
    and no filled text; an empty role cannot be kept either. Rows without conv_id form one
    conversation. Other columns are ignored. A repeated row is a duplicate turn.
    """
    there = F.coalesce(F.col("there"), F.lit(False)) if "there" in turns.columns else F.lit(True)
    rows = turns.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), there.alias("there"), F.col("turn").cast("bigint").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"), F.when(there, F.coalesce("text", F.lit(" "))).alias("text"))
    schema = pa.schema([("conv_id", pa.int64()), *((c, pa.int64()) for c in COLUMNS[1:7]), ("audit", pa.string()), ("repaired_sha256", pa.string()), ("n_expanded", pa.int64())])
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    longs = ", ".join(f"{c} bigint" for c in COLUMNS[:7])
    return ordered.mapInArrow(_repaired(schema), f"{longs}, audit string, repaired_sha256 string, n_expanded bigint")


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, there: turns broken by crc32 of ``conv_id:turn`` (nulls: one space) modulo 20.

    0 drops a turn (it stays as a row that is not ``there``), 1 empties its text, 2 removes ``.!?``,
    3 repeats it, 4 makes its role user; others stay as they are. A null role or text is one space.
    """
    text = F.coalesce("text", F.lit(" "))
    key = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    kind = F.crc32(key.cast("binary")) % 20
    rows = conversations.select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(F.coalesce("role", F.lit(" "))).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        (kind != 0).alias("there"), F.when(kind == 3, 2).otherwise(1).alias("times"))
    return rows.withColumn("times", F.explode(F.sequence(F.lit(1), F.col("times")))).drop("times")


#: crc32 of a text ``{0}`` of ASCII characters, in DuckDB.
CRC = """xor(list_reduce(list_prepend(4294967295::bigint, list_transform(string_split({0}, ''), lambda ch: ord(ch)::bigint)),
  lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda x, i: xor(x >> 1, 3988292384::bigint * (x & 1)))), 4294967295::bigint)"""

SQL = f"""
with recursive k as (select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
  {CRC.format("coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ')")} % 20 as kind from conversations),
t as (select conv_id, turn, case when kind = 4 then 'user' else role end as role,
  case kind when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text,
  unnest(range(case kind when 3 then 2 else 1 end)) as copy from k where kind <> 0),
o as (select *, row_number() over (partition by conv_id order by turn nulls first, role, text, copy) as i from t),
f as (select *, left(role, 1) as r, lead(left(role, 1)) over (partition by conv_id order by i) as later,
  case when not regexp_matches(text, '[^\\x20\\x09-\\x0D]') then 'b'
    when row_number() over (partition by conv_id, role, text order by i) > 1 then 'd'
    when right(rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) not in ('.', '!', '?') then 't' else '' end as fault from o),
p as (select conv_id, count(*) as n, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps,
  count(*) filter (fault = 'b') as blank, count(*) filter (fault = 'd') as duplicate, count(*) filter (fault = 't') as truncated,
  count(*) filter (later is not null and r || later not in ('su', 'ua', 'au')) as illegal from f group by conv_id),
-- Before each turn and at the end none, one or two are inserted; st is the last role, or - before any.
ins(st, more, nxt, roles) as (values ('-', 0, '-', []), ('s', 0, 's', []), ('u', 0, 'u', []), ('a', 0, 'a', []), ('-', 1, 'u', ['user']), ('s', 1, 'u', ['user']),
  ('a', 1, 'u', ['user']), ('u', 1, 'a', ['assistant']), ('-', 2, 'a', ['user', 'assistant']), ('s', 2, 'a', ['user', 'assistant']), ('a', 2, 'a', ['user', 'assistant']), ('u', 2, 'u', ['assistant', 'user'])),
act(st, edit, r, nxt, price) as (values ('-', 'K', 's', 's', 0), ('-', 'K', 'u', 'u', 0), ('s', 'K', 'u', 'u', 0), ('a', 'K', 'u', 'u', 0), ('u', 'K', 'a', 'a', 0),
  ('-', 'R', null, 'u', 3), ('s', 'R', null, 'u', 3), ('a', 'R', null, 'u', 3), ('u', 'R', null, 'a', 3),
  ('-', 'D', null, '-', 4), ('s', 'D', null, 's', 4), ('u', 'D', null, 'u', 4), ('a', 'D', null, 'a', 4)),
s as (select conv_id, 0::bigint as i, '-' as st, 0::bigint as cost, '' as audit, []::varchar[] as lines from p
  union all select conv_id, i, st, b.cost, b.audit, b.lines from (
    select s.conv_id, s.i + 1 as i, act.nxt as st, min({{'cost': s.cost + 3 * ins.more + price + case when fault = 't' and edit <> 'D' then 3 else 0 end,
      'audit': s.audit || repeat('I', ins.more) || edit,
      'lines': s.lines || list_transform(ins.roles, lambda x: x || ':') || case edit when 'D' then [] when 'K' then [role || ':' || text] when 'R' then [case act.nxt when 'u' then 'user:' else 'assistant:' end || text] end}}) as b
    from s join f on f.conv_id is not distinct from s.conv_id and f.i = s.i + 1 join ins on ins.st = s.st join act on act.st = ins.nxt and (act.r is null or act.r = f.r)
      and (fault not in ('b', 'd') or edit = 'D') group by 1, 2, 3)),
e as (select s.conv_id, min({{'cost': s.cost + 3 * more, 'audit': s.audit || repeat('I', more), 'lines': s.lines || list_transform(ins.roles, lambda x: x || ':')}}) as b
  from s join p on p.conv_id is not distinct from s.conv_id and p.n = s.i join ins on ins.st = s.st where ins.nxt in ('-', 'a') group by 1)
select c.conv_id, coalesce(gaps, 0)::bigint as gaps, coalesce(blank, 0)::bigint as blank, coalesce(duplicate, 0)::bigint as duplicate, coalesce(truncated, 0)::bigint as truncated,
  coalesce(illegal, 0)::bigint as illegal, coalesce(e.b.cost, 0)::bigint as cost, coalesce(e.b.audit, '') as audit, sha256(coalesce(array_to_string(e.b.lines, chr(10)), '')) as repaired_sha256
from (select distinct conv_id from conversations) c left join p on p.conv_id is not distinct from c.conv_id left join e on e.conv_id is not distinct from c.conv_id"""


def op11_turn_repair(spark, directory):
    return repair(damaged(table(spark, directory, "conversations"))).drop("n_expanded")
