"""Near-duplicates, components, spread lines, sharding and search against brute force."""

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tidemark.llm import components, lines, sharding, simhash, topk

SIGNED = 1 << 64


def brute_fingerprint(text, size):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", lowered) if w]
    shingles = [" ".join(words[i : i + size]) for i in range(len(words) - size + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("text", [None, "", " \n", "One", "a b", "A b C d É\x0bÉ", "x y z " * 50, "ß " * 40_000])
def test_fingerprints(text):
    assert simhash.fingerprint(text, 3) % SIGNED == brute_fingerprint(text, 3)


def roots(edges, nodes):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def near_prints(rng, n, flips):
    """Fingerprints around a few centres, so that chains and dense groups arise."""
    centres = rng.integers(0, 2**63, 6, dtype=np.uint64)
    found = []
    for _ in range(n):
        x = int(rng.choice(centres))
        for b in rng.choice(64, rng.integers(0, flips + 1), replace=False):
            x ^= 1 << int(b)
        found.append(x)
    return found


@pytest.fixture
def small_batches(spark):
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "16")
    yield
    spark.conf.set(setting, before)


@pytest.mark.parametrize(("large", "flips"), [(4096, 4), (8, 3)])
def test_linked_groups_equal_all_pairs(spark, monkeypatch, small_batches, large, flips):
    monkeypatch.setattr(simhash, "LARGE_BLOCK", large)
    monkeypatch.setattr(simhash, "ROWS_TOGETHER", 40)
    prints = near_prints(np.random.default_rng(flips), 400, flips)
    rows = [(i * 3 % 400 + 1000, x - SIGNED if x >> 63 else x) for i, x in enumerate(prints)]
    rows += [(None, rows[0][1]), (5, rows[7][1]), (5, rows[7][1])]
    found = simhash.grouped(spark.createDataFrame(rows, "doc_id long, fingerprint long"), 3).collect()
    values = sorted({x % SIGNED for _, x in rows})
    edges = [(a, b) for a in values for b in values if a < b and (a ^ b).bit_count() <= 3]
    root = roots(edges, values)
    least = {}
    for doc, x in rows:
        if doc is not None:
            least[root[x % SIGNED]] = min(doc, least.get(root[x % SIGNED], doc))
    assert len(found) == len(rows)
    assert all(r["component_id"] == least[root[r["fingerprint"] % SIGNED]] for r in found)


def test_a_block_is_swept_whole():
    prints = np.array(near_prints(np.random.default_rng(1), 300, 5), np.uint64)
    links = simhash.link_blocks(prints, np.zeros(300, np.int64), 3)
    edges = [(i, j) for i in range(300) for j in range(i) if (int(prints[i]) ^ int(prints[j])).bit_count() <= 3]
    want = roots(edges, range(300))
    got = roots([(i, int(x)) for i, x in enumerate(links)], range(300))
    assert got == want


def test_one_row_of_each_group_stays(spark):
    long = " ".join(f"w{i}" for i in range(400))
    rows = [(3, long), (2, long), (2, long), (9, long.upper()), (7, "another text entirely, of other words"), (None, None), (None, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = [(r["doc_id"], r["text"]) for r in simhash.deduplicated(docs, 5, 3).collect()]
    assert (2, long) in kept and (7, rows[4][1]) in kept and len(kept) == 3
    assert simhash.deduplicated(docs.limit(0), 5, 3).count() == 0


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, x) for x in range(101, 140)] + [(7, 7), (200, 201), (201, 200), (None, 3)]
    found = components.components(spark.createDataFrame(edges, "x long, y long")).collect()
    real = [(a, b) for a, b in edges if a is not None and a != b]
    assert {r["node"]: r["root"] for r in found} == roots(real, {n for e in real for n in e})
    assert len(found) == len({r["node"] for r in found})
    assert components.components(spark.createDataFrame([], "x long, y long")).count() == 0


@pytest.fixture
def many_shuffle_partitions(spark):
    wanted = {"spark.sql.shuffle.partitions": "24", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("of_task", (components.EDGES_A_TASK, 30))
def test_rounds_take_tasks_by_edges(spark, many_shuffle_partitions, monkeypatch, of_task):
    """A few edges take one task a round, not one for each shuffle partition; results are the same."""
    rounds = []
    real = components.cut
    monkeypatch.setattr(components, "cut", lambda df: rounds.append(real(df)) or rounds[-1])
    monkeypatch.setattr(components, "EDGES_A_TASK", of_task)
    rng = np.random.default_rng(12)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 150, (100, 2)) if a != b]
    nodes = {n for e in edges for n in e}
    found = components.components(spark.createDataFrame(edges, "x long, y long")).collect()
    assert {r["node"]: r["root"] for r in found} == roots(edges, nodes) and len(found) == len(nodes)
    if of_task > len(edges):
        assert [r.rdd.getNumPartitions() for r in rounds[1:]] == [1] * (len(rounds) - 1)


BOILERPLATE = "This line is on many sites, as it is."


def test_frequent_lines_meet_their_rows_either_way(spark, monkeypatch):
    """The rows are the same whether all, some or none of the spread lines are sent to every task."""
    rows = [(i, "\n".join(f"line {i * j % 13}" for j in range(1, 9)), f"s{i % 7}") for i in range(80)] + [(None, "line 3", "s1")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = []
    for most in (20_000, 3, 0):
        monkeypatch.setattr(lines, "MOST_BROADCAST", most)
        found.append(sorted(map(str, lines.clean(docs).collect())))
    assert found[0] == found[1] == found[2]
    assert any("n_removed=0" not in row for row in found[0])


def test_spread_lines_stay_in_the_first_document(spark):
    rows = [(i, f"own words of document {i}\n  {BOILERPLATE} \nshort", f"s{i % 6}", 0) for i in range(12)]
    rows += [(50 + i, "on four sites only, so kept", f"s{i}", 0) for i in range(4)]
    rows += [(70, None, "s1", None), (None, BOILERPLATE, None, 1), (71, "", "s1", 0)]
    found = {r["doc_id"]: r for r in lines.clean(spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long")).collect()}
    assert found[0]["n_removed"] == 0 and BOILERPLATE in found[0]["text"]
    # Lines of a few characters go like others.
    assert all(found[i]["text"] == f"own words of document {i}" and found[i]["n_removed"] == 2 and found[i]["n_chars"] == len(found[i]["text"]) for i in range(1, 12))
    assert all(found[50 + i]["n_removed"] == 0 for i in range(4))
    assert found[None]["text"] == "" and found[70]["text"] is None and found[71]["text"] == ""


def test_estimates_near_the_threshold_are_settled_exactly(spark):
    chosen = lines.Settings(least_sites=100, precision=4)
    rows = [(i, f"the line of {n} sites stands here", f"s{i}") for n in (60, 95, 99, 100, 101, 150) for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = lines.spread_lines(docs, chosen).join(
        docs.select(lines.line_hash(F.col("text")).alias("line"), "text").distinct(), "line"
    )
    assert {r["text"].split()[3] for r in found.collect()} == {"100", "101", "150"}


def test_shards_fit_and_only_large_buckets_split(spark):
    rng = np.random.default_rng(3)
    rows = [(i, int(rng.integers(0, 2**60)), int(rng.integers(0, 100))) for i in range(3000)]
    rows += [(9000 + i, 12345, 300) for i in range(50)] + [(9999, 1, 5000)]
    found = sharding.shard(spark.createDataFrame(rows, "doc_id long, hash long, bytes long"), 1000).collect()
    assert len(found) == len(rows)
    sizes, members, by_prefix = {}, {}, {}
    for r in found:
        assert f"{r['hash']:060b}".startswith(r["shard"]) and len(r["shard"]) == r["depth"]
        key = r["shard"], r["page"]
        sizes[key] = sizes.get(key, 0) + r["bytes"]
        members[key] = members.get(key, 0) + 1
        for d in range(r["depth"]):
            by_prefix[r["shard"][:d]] = by_prefix.get(r["shard"][:d], 0) + r["bytes"]
    assert all(size <= 1000 or members[key] == 1 for key, size in sizes.items())
    assert all(size > 1000 for size in by_prefix.values())


def test_shards_of_small_and_of_equal_rows(spark):
    rows = spark.range(10).selectExpr("id AS doc_id", "7L AS hash", "400L AS bytes")
    assert {(r["shard"], r["page"]) for r in sharding.shard(rows, 10_000).collect()} == {("", 0)}
    pages = [r["page"] for r in sharding.shard(rows, 1000).collect()]
    assert sorted(pages) == [0, 0, 1, 1, 2, 2, 3, 3, 4, 4]
    assert sharding.shard(rows.limit(0), 1000).count() == 0


def test_sharding_runs_no_python(spark, awkward):
    from tidemark.llm.queries import op9_sharding

    plan = op9_sharding(spark, awkward)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


@pytest.mark.parametrize("scale", [3, 2**20, 2**28])
def test_search_equals_all_pairs(spark, monkeypatch, scale):
    monkeypatch.setattr(topk, "ROWS_IN_BLOCK", 60)
    monkeypatch.setattr(topk, "QUERIES_IN_BLOCK", 15)
    rng = np.random.default_rng(4)
    vectors = {i: [int(x) for x in rng.integers(-scale, scale + 1, 6)] for i in range(300)}
    vectors[300] = vectors[299] = vectors[0]
    rows = spark.createDataFrame(list(vectors.items()), "id long, vector array<long>")
    found = topk.search(rows, rows.filter("id % 10 = 0"), 7).collect()
    for q in range(0, 301, 10):
        scored = sorted((-sum(a * b for a, b in zip(vectors[q], v)), i) for i, v in vectors.items() if i != q)[:7]
        got = sorted((r["rank"], r["vec_id"], r["score"]) for r in found if r["query_id"] == q)
        assert got == [(n, i, -s) for n, (s, i) in enumerate(scored, 1)]


def test_search_with_few_candidates(spark):
    rows = spark.createDataFrame([(1, [1, 2]), (2, [3]), (3, []), (None, [9, 9])], "id long, vector array<long>")
    found = topk.search(rows, rows.filter("id = 1"), 20).collect()
    assert [(r["rank"], r["vec_id"], r["score"]) for r in found] == [(1, 2, 3), (2, 3, 0)]
    assert topk.search(rows.limit(0), rows.limit(0), 20).count() == 0


def test_a_forest_has_an_edge_for_a_node_at_most(spark, monkeypatch):
    """A dense graph is left with a star for each task, whatever the number of its edges."""
    edges = [(a, b) for a in range(40) for b in range(a)] + [(100, 99)]
    frame = spark.createDataFrame(edges, "u long, v long").coalesce(1)
    found = [tuple(r) for r in components.forest(frame).collect()]
    assert sorted(found) == [(n, 0) for n in range(1, 40)] + [(100, 99)]
    assert components.forest(frame.limit(0)).collect() == []
