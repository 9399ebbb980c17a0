"""Walks from many roots against a plain search."""

import random
from collections import deque

import pytest

from factloom.plans import frontier
from factloom.plans.frontier import reach


def plain(seeds, links, most=None):
    onward = {}
    for a, b in links:
        onward.setdefault(a, set()).add(b)
    out = set()
    for root in {r for r, _ in seeds}:
        depth = {n: 0 for r, n in seeds if r == root}
        queue = deque(depth)
        while queue:
            node = queue.popleft()
            for there in onward.get(node, ()) if most is None or depth[node] < most else ():
                if there not in depth:
                    depth[there] = depth[node] + 1
                    queue.append(there)
        out |= {(root, n, d) for n, d in depth.items()}
    return out, onward


def walk(spark, seeds, links, most=None):
    got = reach(spark.createDataFrame(seeds, "root int, node int"), spark.createDataFrame(links, "_from int, _to int"), most).collect()
    assert len(got) == len({(r["root"], r["node"]) for r in got})
    return got


def test_more_roots_than_a_row_holds(spark):
    chance = random.Random(3)
    links = [(chance.randrange(60), chance.randrange(60)) for _ in range(90)]  # cycles, loops and repeats
    seeds = [(r, chance.randrange(60)) for r in range(-20, 180) for _ in range(chance.randint(1, 2))]
    assert {(r["root"], r["node"], r["depth"]) for r in walk(spark, seeds, links)} == plain(seeds, links)[0]


def test_the_limit_marks_what_goes_on(spark):
    links = [(k, k + 1) for k in range(9)] + [(3, 0)]
    seeds = [(0, 0), (0, 0), (5, 5), (9, 9)]
    want, onward = plain(seeds, links, 3)
    got = walk(spark, seeds, links, 3)
    assert {(r["root"], r["node"], r["depth"]) for r in got} == want
    assert {(r["root"], r["node"]) for r in got if r["cut"]} == {(r, n) for r, n, d in want if d == 3 and n in onward}


def test_no_links_and_no_seeds(spark):
    assert [tuple(r) for r in walk(spark, [(1, 2)], [])] == [(1, 2, 0)]
    assert walk(spark, [], [(1, 2)]) == []


def test_a_root_without_a_name(spark):
    got = walk(spark, [(None, 1), (4, None)], [(1, 2)])
    assert {tuple(r) for r in got} == {(None, 1, 0), (None, 2, 1), (4, None, 0)}


def test_roots_that_start_at_one_hub_share_rows(spark, monkeypatch):
    """Ten hubs with 64 roots each that lead to 30 nodes: as many rows as nodes, not roots or blocks times nodes."""
    sizes = []
    plain_written = frontier.written

    def counted(df, path=None):
        out = plain_written(df, path)
        if path:
            sizes.append(out.count())
        return out

    monkeypatch.setattr(frontier, "written", counted)
    seeds = [(r, r) for r in range(640)]
    links = [(r, 1000 + r % 10) for r in range(640)] + [(1000 + h, 2000 + 30 * h + i) for h in range(10) for i in range(30)]
    got = walk(spark, seeds, links, 2)
    assert {(r["root"], r["node"], r["depth"]) for r in got} == plain(seeds, links, 2)[0]
    assert sizes[0] == 640 and sizes[1] <= 3 * 10 and sizes[2] <= 3 * 300


@pytest.mark.parametrize("known", [0, 2, 64])
def test_hubs_of_the_last_step(spark, monkeypatch, known):
    """Hubs that share nodes and lead to each other and back, nodes that few or many have come to before, other ways."""
    monkeypatch.setattr(frontier, "HUB", 5)
    monkeypatch.setattr(frontier, "KNOWN", known)
    chance = random.Random(known)
    nodes = [*range(100, 160), 900, 901, 902, 0, 1, 2, 3]
    links = [(r, chance.choice([900, 901, 902])) for r in range(150)] + [(r, chance.choice(nodes)) for r in range(150)]
    links += [(h, chance.choice(nodes)) for h in (900, 901, 902) for _ in range(40)] + [(chance.choice(nodes), chance.choice(nodes)) for _ in range(30)]
    seeds = [(r, r) for r in range(150)] + [(r, 500) for r in range(5)] + [(None, 7)]
    for most in (1, 2, 3):
        got = walk(spark, seeds, links + [(900, None), (500, 7)], most)
        want, onward = plain(seeds, links + [(500, 7)], most)
        assert {(r["root"], r["node"], r["depth"]) for r in got if r["node"] is not None} == want
        assert all(r["cut"] == (r["depth"] == most and r["node"] in {a for a, _ in links + [(500, 7)]}) for r in got if r["node"] is not None)
    about = spark.createDataFrame([(n, n * 2) for n in nodes for _ in range(n % 3)], "node int, more int")
    got = reach(spark.createDataFrame(seeds, "root int, node int"), spark.createDataFrame(links, "_from int, _to int"), 2, about).collect()
    want, _ = plain(seeds, links, 2)
    assert sorted([(r["root"], r["node"], r["depth"], r["more"]) for r in got], key=str) == sorted([(*w, w[1] * 2) for w in want if w[1] in nodes for _ in range(w[1] % 3)], key=str)


def test_nothing_is_written_per_block_and_node_of_a_hub(spark, monkeypatch):
    """1,280 roots at one hub that leads to 300 nodes, some of them roots: 20 blocks times 300 nodes are not written."""
    sizes = []
    plain_written = frontier.written

    def counted(df, path=None):
        out = plain_written(df, path)
        sizes.append(out.count())
        return out

    monkeypatch.setattr(frontier, "written", counted)
    links = [(r, 5000) for r in range(1280)] + [(5000, 1200 + n) for n in range(300)]
    seeds = [(r, r) for r in range(1280)]
    got = walk(spark, seeds, links, 2)
    assert {(r["root"], r["node"], r["depth"]) for r in got} == plain(seeds, links, 2)[0]
    assert max(sizes) <= len(links)


def test_columns_of_the_nodes_come_along(spark):
    about = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c")], "node int, name string")
    seeds = spark.createDataFrame([(9, 1), (9, 5)], "root int, node int")
    got = reach(seeds, spark.createDataFrame([(1, 2), (2, 3)], "_from int, _to int"), about=about)
    assert sorted(tuple(r) for r in got.collect()) == [(9, 1, 0, "a"), (9, 2, 1, "b"), (9, 2, 1, "c")]
