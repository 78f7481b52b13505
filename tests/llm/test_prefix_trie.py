import hashlib
import random
import re
import zlib
from collections import defaultdict

import duckdb
import pytest

from traitlens.llm import prefix_trie as P

SCHEMA = "conv_id long, turn long, role string, text string, h string, head string, words string, pos string"


def brute_force(rows):
    """Nodes by walking every rebuilt conversation; rows of equal turn must be equal."""
    own = defaultdict(list)
    for c, turn, role, text in sorted((r for r in rows if r[0] is not None),
                                      key=lambda r: (r[0], r[1] is not None, r[1] or 0)):
        own[c].append((role or "", text or ""))
    whole = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (c % 20 if c >= 0 else -(-c % 20))
        whole[c] = tuple(own.get(base, [])[:h] + own[c][h:])
    members, children = defaultdict(list), defaultdict(set)
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
            if d:
                children[turns[:d - 1]].add(turns[:d])
    out = {}
    for node in sorted(members, key=len, reverse=True):
        below = [out[x] for x in children[node]]
        words = len(re.findall("[^\x20\x09-\x0d]+", node[-1][1])) if node else 0
        ends = ",".join(str(c) for c in sorted(c for c in members[node] if len(whole[c]) == len(node)))
        out[node] = (min(members[node]), len(node), min(members[node[:-1]]) if node else None, len(members[node]),
                     len(below), sum(x[5] for x in below) or 1,
                     (len(members[node]) - 1) * words + sum(x[6] for x in below), hashlib.sha256(ends.encode()).hexdigest())
    return sorted(out.values(), key=str)


def nodes(df):
    return sorted((tuple(r) for r in P.trie(df).collect()), key=str)


def conversations(seed, n=300, words=("yes", "no", "a b", "", "x\ty\x0bz", "ü ß")):
    rnd = random.Random(seed)
    rows = []
    for c in rnd.sample(range(-40, 400), n):
        turns = [None] + list(range(-3, 9))
        for turn in rnd.sample(turns, rnd.choice([1, 1, 2, 3, 4, 6, 9])):
            rows.append((c, turn, rnd.choice(["user", "user", None, ""]), rnd.choice([*words[:rnd.randint(1, 6)], None])))
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, *[None] * 4) for r in rows], SCHEMA).repartition(5)


@pytest.mark.parametrize("seed", [1, 2])
def test_nodes_equal_brute_force(spark, seed):
    rows = conversations(seed)
    assert nodes(frame(spark, rows)) == brute_force(rows)


def test_blocks_change_nothing(spark, monkeypatch):
    """Long conversations and end lists span several blocks; a third of all rows is one conversation."""
    rows = conversations(3) + [(401, t, "user", f"w{t % 3}") for t in range(700)] + \
        [(c, 0, "user", "the same") for c in range(1000, 1300)]
    expected = brute_force(rows)
    for block in (3, 64):
        monkeypatch.setattr(P, "BLOCK", block)
        assert nodes(frame(spark, rows)) == expected


def test_ties_repeats_and_rows_without_conversation(spark):
    rows = [(None, 0, "user", "x"), (1, 0, "user", "a"), (1, 0, "user", "a"), (1, None, None, None), (2, 0, "b", "c"),
            (2, 0, "c", "b")]
    found = nodes(frame(spark, rows))
    assert found == nodes(frame(spark, rows[::-1])) and sum(r[1] == 0 for r in found) == 1
    assert [r[3] for r in found if r[1] == 0] == [2]


def test_empty_table_and_turnless_conversations(spark):
    assert nodes(frame(spark, [])) == []
    # a head of three turns is wanted and there is none: nothing is left of these conversations
    lone = [c for c in range(1, 2000) if c % 20 and zlib.crc32(str(c).encode()) % 4 == 3][:3]
    rows = [(c, 0, "user", "hello there") for c in lone]
    found = nodes(frame(spark, rows))
    assert found == brute_force(rows) and len(found) == 1 and found[0][3] == 3


def test_oracle_on_given_table():
    con = duckdb.connect()
    con.execute("create view conversations as select * from '/root/testdata/sf0.01/conversations.parquet'")
    found = sorted(con.execute(P.ORACLE).fetchall(), key=str)
    assert found == brute_force(con.execute("select conv_id, turn, role, text from conversations").fetchall())
