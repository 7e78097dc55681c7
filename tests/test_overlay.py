"""The street overlay, its landmarks and the routes over it against brute force."""

import random

import pytest
from test_routing import EDGES, PAIRS, dijkstra, random_graph

from curbline.operators import overlay as ov
from curbline.operators import city_routes
from curbline.operators.city_routes import LANDMARKS, _Network, landmarks, search, shortest_lengths, shortest_paths

SIDE = 34
NODES = "city_bfs_id int, mode string, node_id bigint, lon double, lat double"


def city(side, seed):
    """A street grid with uneven lengths, one-way streets, gaps and ids in no order; an island of three; a dead end."""
    pick = random.Random(seed)
    ids = pick.sample(range(10 * side * side), side * side)
    at = {(x, y): ids[x * side + y] for x in range(side) for y in range(side)}
    nodes = [(n, 8.4 + 0.001 * x + pick.uniform(0, 0.0005), 47.3 + 0.001 * y + pick.uniform(0, 0.0005)) for (x, y), n in at.items()]
    edges = []
    for (x, y), n in at.items():
        for to in ((x + 1, y), (x, y + 1)):
            if to in at and pick.random() < 0.93:
                length = pick.uniform(50, 150)
                edges += [(n, at[to], length), (at[to], n, length)][:1 if pick.random() < 0.1 else 2]
    far = 10 * side * side
    edges += [(far, far + 1, 5.0), (far + 1, far + 2, 5.0), (far + 2, far, 5.0), (ids[0], far + 3, 7.0)]
    nodes += [(far + k, 8.3, 47.2) for k in range(4)]
    return nodes, edges, far


def graph(spark, side, seed=1):
    nodes, edges, far = city(side, seed)
    frame = spark.createDataFrame([(1, "walk", *n) for n in nodes], NODES)
    return frame, spark.createDataFrame([(1, "walk", *e) for e in edges], EDGES), edges, far


def test_small_cells(spark, cells=8):
    """Several cells, with and without landmarks; whole graphs in one cell are in test_routing."""
    edges = random_graph(4, nodes=40, edges=110) + [(100, 101, 1.0), (3, 102, 2.0)]
    table = spark.createDataFrame([(1, "walk", *e) for e in edges], EDGES)
    wanted = [(1, "walk", o, d) for o in (0, 3, 7, 100, 102) for d in (*range(0, 40, 3), 101, 102)]
    pairs = spark.createDataFrame(wanted, PAIRS)
    built = ov.build_overlay(table, cell_nodes=cells)
    expected = {(o, d): dijkstra(edges, o).get(d) for _, _, o, d in wanted}
    lightest = {}
    for u, v, w in edges:
        lightest[u, v] = min(w, lightest.get((u, v), w))
    marks = landmarks(built)
    for given in (None, marks):
        got = {(r.origin, r.destination): r.length_m for r in shortest_lengths(pairs, table, overlay=built, marks=given).collect()}
        assert got.keys() == {k for k, v in expected.items() if v is not None}
        assert all(got[k] == pytest.approx(expected[k], abs=1e-6) for k in got)
    paths = {}
    for r in shortest_paths(pairs, table, overlay=built, marks=marks).collect():
        paths.setdefault((r.origin, r.destination), []).append((r.pos, r.node_id))
    assert paths.keys() == got.keys()
    for key, steps in paths.items():
        way = [n for _, n in sorted(steps)]
        assert [p for p, _ in sorted(steps)] == list(range(len(way))) and (way[0], way[-1]) == key
        assert sum(lightest[step] for step in zip(way, way[1:])) == pytest.approx(expected[key], abs=1e-6)


def test_cells_and_components(spark):
    nodes, table, edges, far = graph(spark, 30)
    built = ov.build_overlay(table, nodes, cell_nodes=64)
    rows = {r.node: r for r in built.nodes.collect()}
    sizes = {}
    for r in rows.values():
        sizes[r.cell] = sizes.get(r.cell, 0) + 1
    assert max(sizes.values()) == 64 and len(rows) == len({n for e in edges for n in e[:2]})
    # Nodes have one root when edges join them, whatever their direction.
    label = {n: n for n in rows}

    def find(n):
        while label[n] != n:
            n = label[n]
        return n
    for u, v, _ in edges:
        label[find(u)] = find(v)
    groups = {}
    for n in rows:
        groups.setdefault(find(n), set()).add(rows[n].root)
    assert all(len(g) == 1 for g in groups.values()) and len({min(g) for g in groups.values()}) == len(groups)
    assert rows[far].root != rows[far + 3].root


def test_city(spark):
    """Right lengths, labels on border nodes only, fewer with landmarks, none for what cannot be reached.

    ``SIDE`` 142 (20,164 nodes) was run by hand; it takes minutes.
    """
    nodes, table, edges, far = graph(spark, SIDE)
    pick = random.Random(2)
    at = sorted({n for e in edges for n in e[:2] if n < far})
    origins = pick.sample(at, 4)
    wanted = [(1, "walk", o, pick.choice(at)) for o in origins for _ in range(2)]
    lost = [(1, "walk", o, far + 1) for o in origins] + [(1, "walk", far + 3, at[5])]
    known = {o: dijkstra(edges, o) for o in origins}
    expected = {(o, d): known[o][d] for _, _, o, d in wanted if d in known[o]}
    built = ov.build_overlay(table, nodes, cell_nodes=64)
    marks = landmarks(built)
    assert all(len(r.ahead) == len(r.back) == LANDMARKS for r in marks.limit(5).collect())
    labels = {}
    for name, given in (("plain", None), ("marked", marks)):
        net = _Network(spark.createDataFrame(wanted + lost, PAIRS), built, given)
        found = search(net)
        labels[name] = found.count()
        got = {(r.origin, r.destination): r.best / ov.STEPS for r in net.pairs.join(city_routes._reached(net, found), ["o", "d"]).collect()}
        assert got.keys() == expected.keys()
        assert all(got[k] == pytest.approx(expected[k], abs=1e-6) for k in got)
    print(labels, len(at) * len(origins))
    # Brute force settles every node for each origin; the overlay has border nodes only.
    assert labels["marked"] <= labels["plain"] < 0.6 * len(at) * len(origins)
    # The dead end leads nowhere: landmarks tell before the search.
    assert _Network(spark.createDataFrame(lost, PAIRS), built, marks).searched.isEmpty()


def test_numbers_do_not_mix_graphs(spark):
    rows = [(c, m, u, u + 1, 1.0) for c in (1, 2) for m in ("bike", "walk") for u in range(50)]
    built = ov.build_overlay(spark.createDataFrame(rows, EDGES), cell_nodes=7)
    found = {}
    for r in built.nodes.collect():
        found.setdefault(r.cell, set()).add((r.city_bfs_id, r.mode))
    assert all(len(g) == 1 for g in found.values())
    assert len({r.root for r in built.nodes.collect()}) == 4
