import hashlib
import random
import zlib

import pytest
from helpers import words
from pyspark.sql import functions as F

from stargauge.llm import prefix_trie as T
from stargauge.llm.common import table

SCHEMA = "conv_id long, turn long, role string, text string"


def rebuilt(rows):
    """Every conversation's turns, with the first ones of its family's first conversation."""
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(turns)] for c, turns in own.items()}
    found = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        found[c] = own.get(c - c % 20, [])[:h] + turns[h:]
    return found


def plain_trie(lists):
    """Each node's row, from all prefixes of all conversations."""
    members = {}
    for c, turns in lists.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    kids = {}
    for node in members:
        if node:
            kids.setdefault(node[:-1], []).append(node)

    def below(node):
        yield node
        for k in kids.get(node, []):
            yield from below(k)

    out = []
    for node, convs in members.items():
        sub = list(below(node))
        saved = sum((len(members[x]) - 1) * len(words(x[-1][1])) for x in sub if x)
        ends = ",".join(str(c) for c in sorted(convs) if len(lists[c]) == len(node))
        out.append(
            (
                min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), len(kids.get(node, [])),
                sum(1 for x in sub if x not in kids), saved, hashlib.sha256(ends.encode()).hexdigest(),
            )
        )
    return sorted(out, key=str)


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def nodes_of(frame):
    return sorted([tuple(r) for r in frame.select(COLUMNS).collect()], key=str)


def random_rows(n=60, seed=3):
    draw = random.Random(seed)
    rows = []
    for c in range(n):
        if c % 7 == 3:
            continue
        for turn in range(draw.choice([1, 2, 3, 5, 9])):
            rows.append((c, turn, draw.choice(["user", "assistant"]), draw.choice(["a b", "c", "", "one two three"])))
    rows += [(c, t, "user", "copied text") for c in range(200, 400) for t in range(6)]
    rows += [(900, t, "user", f"deep {t}") for t in range(150)]
    draw.shuffle(rows)
    return rows


def test_nodes_equal_those_of_all_prefixes(spark):
    rows = random_rows()
    frame = spark.createDataFrame(rows, SCHEMA)
    got = T.prefix_trie(T.with_shared_heads(T.turn_lists(frame)))
    assert nodes_of(got) == plain_trie(rebuilt(rows))


def test_open_paths_close_in_later_rounds(spark, monkeypatch):
    rows = random_rows(40, seed=5)
    monkeypatch.setattr(T, "PART_BYTES", 600)
    frame = spark.createDataFrame(rows, SCHEMA)
    got = T.prefix_trie(T.with_shared_heads(T.turn_lists(frame)), most_open=12)
    assert nodes_of(got) == plain_trie(rebuilt(rows))


def test_query_equals_plain_version(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in table(spark, folder, "conversations").select("conv_id", "turn", "role", "text").collect()]
    assert nodes_of(T.op11_prefix_trie(spark, folder)) == plain_trie(rebuilt(rows))


def test_odd_rows(spark):
    long = "word " * 50_000
    rows = [
        (0, None, None, None), (0, 1, "user", long), (0, 1, "user", long), (1, 0, "user", ""), (1, None, "user", None),
        (20, 0, "", "\t x \n y"), (21, 0, "a", "only"), (22, 5, "b", "one"), (22, -5, "b", "two"), (45, 0, "user", "alone"),
        (None, 0, "user", "nobody's"), (None, None, None, None),
    ]
    frame = spark.createDataFrame(rows, SCHEMA).withColumns({n: F.lit("x") for n in ("path", "words", "node", "turns", "head", "n", "ends")})
    lists = T.turn_lists(frame)
    assert nodes_of(T.prefix_trie(T.with_shared_heads(lists))) == plain_trie(rebuilt(rows))
    assert T.prefix_trie(T.turn_lists(frame.limit(0))).collect() == []


@pytest.mark.parametrize("last", [True, False])
def test_peeling_nothing(last):
    assert list(T.peel([], last)) == []
