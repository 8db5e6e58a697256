"""The trie against one built node by node, on random conversations with many shared beginnings."""

import hashlib
import random
import re
import zlib

from tidemark.llm import conversations


def brute(rows):
    by_id = {}
    for conv, turn, role, text in rows:
        by_id.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    by_id = {c: [t[2:] for t in sorted(turns)] for c, turns in by_id.items()}
    members = {}
    for c in sorted(by_id):
        h = zlib.crc32(str(c).encode()) % 4
        turns = by_id.get(c - c % 20, [])[:h] + by_id[c][h:]
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append((c, len(turns)))
    saving = {n: (len(m) - 1) * (len(re.findall(r"[^\x20\x09-\x0D]+", n[-1][1])) if n else 0) for n, m in members.items()}
    children = {n: [o for o in members if len(o) == len(n) + 1 and o[: len(n)] == n] for n in members}
    out = []
    for n, m in members.items():
        below = [o for o in members if o[: len(n)] == n]
        ends = ",".join(str(c) for c, size in m if size == len(n))
        out.append(
            (
                m[0][0],
                len(n),
                members[n[:-1]][0][0] if n else None,
                len(m),
                len(children[n]),
                sum(not children[o] for o in below),
                sum(saving[o] for o in below),
                hashlib.sha256(ends.encode()).hexdigest(),
            )
        )
    return sorted(out, key=repr)


def test_random_conversations(spark, rows):
    rng = random.Random(5)
    table = []
    for c in rng.sample(range(0, 200), 90):
        for t in range(rng.randint(1, 5)):
            table.append((c, t, rng.choice(["user", "bot"]) if t > 1 else "user", rng.choice(["a", "a b", " c  d e", ""])))
    turns = spark.createDataFrame(table, "conv_id long, turn int, role string, text string")
    found = conversations.trie(conversations.rebuilt(conversations.numbered(turns)))
    assert rows(found) == brute(table)


def test_a_hot_conversation_and_ids_over_many_blocks(spark, rows):
    table = [(c, t, "user", f"turn {t}") for c in range(0, 20_000, 7) for t in range(4)]
    turns = spark.createDataFrame(table, "conv_id long, turn int, role string, text string")
    found = conversations.trie(conversations.rebuilt(conversations.numbered(turns)))
    assert rows(found) == brute(table)


def test_turns_alike_but_for_the_border_of_role_and_text_differ(spark):
    turns = spark.createDataFrame([(4, 0, "a", "bc"), (5, 0, "ab", "c")], "conv_id long, turn int, role string, text string")
    found = conversations.trie(conversations.rebuilt(conversations.numbered(turns)))
    assert found.filter("depth = 0").first()["n_convs"] == 2
