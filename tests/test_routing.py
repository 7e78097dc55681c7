"""Nearest nodes and shortest paths against brute force."""

import heapq
import random

import pytest

import curbline.operators.routing as routing
import curbline.session as session
from curbline.operators.nearest import nearest_nodes
from curbline.operators.stays import with_lv03

EDGES = "city_bfs_id int, mode string, u bigint, v bigint, length_m double"
PAIRS = "city_bfs_id int, mode string, origin bigint, destination bigint"


def dijkstra(edges, origin):
    out = {}
    for u, v, w in edges:
        out.setdefault(u, []).append((v, w))
    best, queue = {}, [(0.0, origin)]
    while queue:
        d, n = heapq.heappop(queue)
        if n not in best:
            best[n] = d
            for v, w in out.get(n, []):
                heapq.heappush(queue, (d + w, v))
    return best


def random_graph(seed, nodes=60, edges=150):
    pick = random.Random(seed)
    ring = [(i, i + 1, pick.uniform(1, 9)) for i in range(nodes // 2)]
    return ring + [(pick.randrange(nodes), pick.randrange(nodes), pick.uniform(1, 50)) for _ in range(edges - len(ring))]


@pytest.mark.parametrize("limit", [session.BROADCAST_LIMIT_BYTES, -1])
def test_random_graphs(spark, monkeypatch, limit):
    monkeypatch.setattr(session, "BROADCAST_LIMIT_BYTES", limit)
    graphs = {"walk": random_graph(1), "bike": random_graph(2, edges=80)}
    edges = spark.createDataFrame([(1, m, *e) for m, g in graphs.items() for e in g], EDGES)
    pick = random.Random(3)
    wanted = [(1, m, 0 if pick.random() < 0.4 else pick.randrange(60), pick.randrange(60)) for m in graphs for _ in range(60)]
    pairs = spark.createDataFrame(wanted + wanted[:5], PAIRS)
    lengths = {tuple(r)[:4]: r.length_m for r in routing.shortest_lengths(pairs, edges).collect()}
    expected = {}
    for c, m, o, d in wanted:
        best = dijkstra(graphs[m], o)
        if d in best:
            expected[(c, m, o, d)] = best[d]
    assert lengths.keys() == expected.keys()
    for key, value in expected.items():
        assert lengths[key] == pytest.approx(value)
    paths = {}
    for r in routing.shortest_paths(pairs, edges).collect():
        paths.setdefault((r.city_bfs_id, r.mode, r.origin, r.destination), []).append((r.pos, r.node_id))
    assert paths.keys() == expected.keys()
    for key, steps in paths.items():
        nodes = [n for _, n in sorted(steps)]
        assert [p for p, _ in sorted(steps)] == list(range(len(nodes)))
        assert nodes[0] == key[2] and nodes[-1] == key[3]
        lightest = {}
        for u, v, w in graphs[key[1]]:
            lightest[u, v] = min(w, lightest.get((u, v), w))
        assert sum(lightest[step] for step in zip(nodes, nodes[1:])) == pytest.approx(expected[key])


def test_long_line_and_unreachable(spark):
    line = [(1, "walk", i, i + 1, 1.0) for i in range(70)]
    edges = spark.createDataFrame(line + [(1, "walk", 500, 501, 1.0)], EDGES)
    pairs = spark.createDataFrame([(1, "walk", 0, 70), (1, "walk", 70, 0), (1, "walk", 0, 501), (1, "walk", 0, 999),
                                   (1, "walk", 999, 999), (2, "walk", 0, 1)], PAIRS)
    got = {(r.city_bfs_id, r.origin, r.destination): r.length_m for r in routing.shortest_lengths(pairs, edges).collect()}
    assert got == {(1, 0, 70): 70.0, (1, 999, 999): 0.0}


def test_lines(spark, streets):
    nodes, edges = streets
    pairs = spark.createDataFrame([(230, "walk", 0, 3), (230, "walk", 5, 5)], PAIRS)
    rows = {r.destination: r for r in routing.path_lines(routing.shortest_paths(pairs, edges), nodes).collect()}
    assert [round(v.x, 6) for v in rows[3].line] == [8.69, 8.692, 8.694, 8.696]
    assert rows[3].line_m == pytest.approx(rows[3].length_m, rel=0.01)
    assert rows[5].line is None and rows[5].line_m is None


@pytest.mark.parametrize("cell", [50.0, 500.0, 5000.0])
def test_nearest_nodes(spark, cell):
    pick = random.Random(7)
    nodes = [(230, m, i, pick.uniform(8.69, 8.78), pick.uniform(47.45, 47.53)) for m in ("walk", "bike") for i in range(40)]
    nodes = [n for n in nodes if n[1] == "walk" or n[2] < 10]
    points = [(230, f"v{i % 7}", i, pick.uniform(8.69, 8.78), pick.uniform(47.45, 47.53)) for i in range(60)]
    df = with_lv03(spark.createDataFrame(points, "city_bfs_id int, id string, stay int, lon double, lat double"))
    node_df = spark.createDataFrame(nodes, "city_bfs_id int, mode string, node_id bigint, lon double, lat double")
    got = {r.stay: (r.node_walk, r.node_bike) for r in nearest_nodes(df, node_df, ("city_bfs_id", "id", "stay"), cell_m=cell).collect()}

    import math

    def far(a, b):
        s = math.sin(math.radians(b[4] - a[4]) / 2) ** 2
        t = math.sin(math.radians(b[3] - a[3]) / 2) ** 2
        return s + math.cos(math.radians(a[4])) * math.cos(math.radians(b[4])) * t
    for p in points:
        assert got[p[2]] == tuple(min((n for n in nodes if n[1] == m), key=lambda n: far(p, n))[2] for m in ("walk", "bike"))


def test_region_without_nodes(spark):
    df = with_lv03(spark.createDataFrame([(230, "a", 0, 8.70, 47.49)], "city_bfs_id int, id string, stay int, lon double, lat double"))
    node_df = spark.createDataFrame([(261, "walk", 1, 8.70, 47.49)], "city_bfs_id int, mode string, node_id bigint, lon double, lat double")
    row = nearest_nodes(df, node_df, ("city_bfs_id", "id", "stay")).collect()[0]
    assert row.node_walk is None and row.node_bike is None
