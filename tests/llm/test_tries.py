import hashlib
import os
import random
import zlib

import pytest
from pyspark.sql import functions as F

from quotegrid.llm import tries


def first(c):
    return c is not None, c or 0


def brute(rows, rebuilt=True):
    convs, new = {}, {}
    for c, _, role, text in sorted(rows, key=lambda r: (*first(r[0]), *first(r[1]))):
        convs.setdefault(c, []).append((role or "", text or ""))
    for c, turns in convs.items():
        h = zlib.crc32(str(c).encode()) % 6 if rebuilt and c is not None else 0
        base = convs.get(c - (abs(c) % 100) * (1 if c >= 0 else -1), []) if h else []
        new[c] = base[:h] + turns[h:]
    members, kids, totals = {}, {}, {}
    for c, turns in new.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    for n in members:
        if n:
            kids.setdefault(n[:-1], []).append(n)
    for n in sorted(members, key=len, reverse=True):
        own = (len(members[n]) - 1) * (len(n[-1][1]) if n else 0)
        below = [totals[k] for k in kids.get(n, [])]
        totals[n] = max(1, sum(x for x, _ in below)), own + sum(x for _, x in below)
    out = []
    for n, ms in members.items():
        ends = ",".join("" if c is None else str(c) for c in sorted(ms, key=first) if len(new[c]) == len(n))
        parent = min(members[n[:-1]], key=first) if n else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        out.append((min(ms, key=first), len(n), parent, len(ms), len(kids.get(n, [])), *totals[n], digest))
    return sorted(out, key=str)


def odd_rows():
    random.seed(3)
    ids = [None, 0, 1, 2, 3, 100, 101, 102, 150, -5, -100, -101]
    rows = {}
    for _ in range(90):
        r = (random.choice(ids), random.choice([None, 0, 1, 2, 3, 4]), random.choice(["u", None]), random.choice(["a", "b", "cc\n", None]))
        rows[r[0], r[1]] = r
    rows = list(rows.values())
    rows += [(c, t, "user", "the same " * 3) for c in range(200, 330) for t in range(4)]
    rows += [(c, t, "user", f"turn {t}") for c in (500, 600, 700) for t in range(300)]
    return rows + [(900, 0, "", "twice"), (900, 0, "", "twice")]


def table(spark, rows):
    said = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    return said.withColumns({c: F.lit("clash") for c in ("depth", "a", "b", "h", "pos", "piece", "first", "n")})


def found(turns, **bounds):
    return sorted((tuple(r) for r in tries.prefix_trie(turns, **bounds).collect()), key=str)


@pytest.mark.parametrize("bounds", [{}, {"crowd": 2, "most": 3}, {"crowd": 1, "most": 1}, {"crowd": 20, "most": 50}])
def test_trie_equals_brute_force(spark, bounds):
    turns = tries.turn_table(table(spark, odd_rows()))
    assert found(tries.rebuilt_turns(turns), **bounds) == brute(odd_rows())


def test_trie_of_conversations_as_they_are(spark):
    turns = tries.turn_table(table(spark, odd_rows()))
    assert found(tries.own_turns(turns), crowd=5) == brute(odd_rows(), rebuilt=False)


def test_whole_table(spark):
    said = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").select("conv_id", "turn", "role", "text")
    assert found(tries.rebuilt_turns(tries.turn_table(said))) == brute([tuple(r) for r in said.collect()])


def test_empty_table_has_no_node(spark):
    turns = tries.turn_table(table(spark, odd_rows()).limit(0))
    assert found(tries.rebuilt_turns(turns)) == []


def test_many_conversations_that_end_alike(spark):
    rows = [(c, 0, "user", "hello") for c in range(0, 300_000, 100)]
    got = found(tries.own_turns(tries.turn_table(table(spark, rows))), crowd=7)
    assert got == brute(rows, rebuilt=False)


def test_queue_spills_and_adds_up(tmp_path):
    random.seed(5)
    for most in (1, 4, 50):
        folder = tmp_path / str(most)
        queue, want = tries.SpillingQueue(str(folder), most), {}
        nodes = sorted({(-random.randrange(1, 5), random.randrange(9), random.randrange(3)) for _ in range(80)})
        for _ in range(400):
            node, sent = random.choice(nodes), (1, random.randrange(5), random.randrange(100))
            queue.push((*node, *sent))
            want[node] = [a + b for a, b in zip(want.get(node, (0, 0, 0)), sent, strict=True)]
        assert len(queue.heap) <= most and (len(os.listdir(folder)) > 0)
        assert [list(queue.take(n)) for n in nodes] == [want.get(n, [0, 0, 0]) for n in nodes]
        queue.close()
        assert os.listdir(folder) == []


def test_a_message_to_a_node_elsewhere_is_an_error(tmp_path):
    queue = tries.SpillingQueue(str(tmp_path))
    queue.push((-3, 1, 1, 1, 1, 1))
    with pytest.raises(ValueError):
        queue.take((-2, 0, 0))
