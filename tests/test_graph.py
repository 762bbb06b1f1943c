import heapq
import random

import pytest
from pyspark.sql import functions as F

from plumbline.functions.distance import grid_distance
from plumbline.operators import graph


def grid(spark, rows, costs=None):
    """Cells from text rows, ``#`` being a wall."""
    data = [
        (r, c, sign == "#", costs[r][c] if costs else None) for r, line in enumerate(rows) for c, sign in enumerate(line)
    ]
    return spark.createDataFrame(data, "row int, col int, wall boolean, cost int")


def point(spark, *points):
    return spark.createDataFrame([((r << 32) | c,) for r, c in points], "node bigint")


def solve(spark, cells, start):
    edges = graph.grid_edges(cells)
    return edges, graph.shortest_paths(edges, point(spark, start))


def costs_of(found):
    return {(r.node >> 32, r.node & 0xFFFFFFFF): r.cost for r in found.collect()}


def dijkstra(rows, costs, start):
    best, queue = {start: 0}, [(0, start)]
    while queue:
        cost, (r, c) = heapq.heappop(queue)
        if cost > best[(r, c)]:
            continue
        for nr, nc in ((r - 1, c), (r + 1, c), (r, c - 1), (r, c + 1)):
            if 0 <= nr < len(rows) and 0 <= nc < len(rows[0]) and rows[nr][nc] != "#":
                new = cost + costs[nr][nc]
                if new < best.get((nr, nc), float("inf")):
                    best[(nr, nc)] = new
                    heapq.heappush(queue, (new, (nr, nc)))
    return best


def test_open_grid_is_manhattan(spark):
    _, found = solve(spark, grid(spark, ["....", "....", "...."]), (0, 0))
    assert costs_of(found) == {(r, c): float(r + c) for r in range(3) for c in range(4)}


def test_random_grids_against_a_heap_search(spark):
    rng = random.Random(42)
    rows = ["".join("#" if rng.random() < 0.25 and (r, c) != (0, 0) else "." for c in range(9)) for r in range(8)]
    costs = [[rng.randint(1, 3) for _ in range(9)] for _ in range(8)]
    edges, found = solve(spark, grid(spark, rows, costs), (0, 0))
    assert costs_of(found) == dijkstra(rows, costs, (0, 0))
    near = found.select(F.col("node").alias("src"), F.col("cost").alias("a"))
    far = found.select(F.col("node").alias("dst"), F.col("cost").alias("b"))
    assert edges.join(near, "src").join(far, "dst").where("b > a + weight").isEmpty()


def test_detour_around_costly_cells(spark):
    costs = [[1, 9, 1], [1, 9, 1], [1, 1, 1]]
    edges, found = solve(spark, grid(spark, ["...", "...", "..."], costs), (0, 0))
    assert costs_of(found)[(0, 2)] == 6.0
    steps = graph.routes(edges, found, point(spark, (0, 2))).orderBy("step").collect()
    assert [(s.node >> 32, s.node & 0xFFFFFFFF) for s in steps] == [(0, 0), (1, 0), (2, 0), (2, 1), (2, 2), (1, 2), (0, 2)]
    assert [s.cost for s in steps] == [0.0, 1.0, 2.0, 3.0, 4.0, 5.0, 6.0]


def test_unreachable_goal_has_no_cost_and_no_route(spark):
    edges, found = solve(spark, grid(spark, [".#.", "##.", "..."]), (0, 0))
    assert costs_of(found) == {(0, 0): 0.0}
    assert graph.routes(edges, found, point(spark, (2, 2))).count() == 0


def test_start_is_goal(spark):
    edges, found = solve(spark, grid(spark, ["..", ".."]), (1, 1))
    assert [(s.step, s.cost) for s in graph.routes(edges, found, point(spark, (1, 1))).collect()] == [(0, 0.0)]


def test_several_sources_and_free_edges(spark):
    edges = spark.createDataFrame([(1, 2, 0.0), (2, 1, 0.0), (2, 3, 0.0), (3, 2, 0.0), (9, 3, 5.0), (3, 4, 1.5)], "src bigint, dst bigint, weight double")
    sources = spark.createDataFrame([(1,), (9,), (1,)], "node bigint")
    want = {(1, 0.0, 0), (9, 0.0, 0), (2, 0.0, 1), (3, 0.0, 2), (4, 1.5, 3)}
    found = graph.shortest_paths(edges, sources)
    assert {tuple(r) for r in found.collect()} == want
    assert {tuple(r) for r in graph.shortest_paths(edges, sources, steps_per_round=1).collect()} == want
    route = graph.routes(edges, found, spark.createDataFrame([(4,)], "node bigint")).orderBy("step")
    assert [r.node for r in route.collect()] == [1, 2, 3, 4]


def test_hubs_and_chords_against_a_heap_search(spark):
    rng = random.Random(7)
    rows = [(0, i, float(rng.randint(1, 9))) for i in range(1, 301)] + [(i, 0, 1.0) for i in range(1, 301)]
    rows += [(rng.randint(1, 300), rng.randint(1, 300), float(rng.randint(1, 3))) for _ in range(300)]
    best, queue = {}, [(0.0, 0, 5)]
    while queue:
        cost, hops, node = heapq.heappop(queue)
        if node not in best:
            best[node] = (cost, hops)
            for a, b, w in rows:
                if a == node:
                    heapq.heappush(queue, (cost + w, hops + 1, b))
    edges = spark.createDataFrame(rows, "src bigint, dst bigint, weight double")
    found = graph.shortest_paths(edges, spark.createDataFrame([(5,)], "node bigint"))
    assert {r.node: (r.cost, r.hops) for r in found.collect()} == best and len(best) == 301


@pytest.mark.parametrize("weight", [None, float("nan"), -1.0])
def test_unusable_weights_are_errors(spark, weight):
    edges = spark.createDataFrame([(1, 2, weight), (1, 3, 5.0), (3, 2, 1.0)], "src bigint, dst bigint, weight double")
    with pytest.raises(ValueError, match="1"):
        graph.shortest_paths(edges, spark.createDataFrame([(1,)], "node bigint"))


def test_round_guard_raises_rather_than_cutting_short(spark):
    edges = spark.createDataFrame([(i, i + 1, 1.0) for i in range(9)], "src bigint, dst bigint, weight double")
    with pytest.raises(RuntimeError):
        graph.shortest_paths(edges, spark.createDataFrame([(0,)], "node bigint"), steps_per_round=2, max_rounds=4)


def test_walls_as_start_or_goal_raise(spark):
    cells = grid(spark, [".#", ".."])
    graph.require_open(cells, [(0, 0), (1, 1)])
    for bad in ((0, 1), (5, 5)):
        with pytest.raises(graph.BlockedCell):
            graph.require_open(cells, [(0, 0), bad])


def test_edge_weight_is_the_cost_of_the_entered_cell(spark):
    edges = graph.grid_edges(grid(spark, ["..", "#."], [[1, 2], [5, 3]]))
    assert {(r.src & 1, r.src >> 32, r.dst & 1, r.dst >> 32, r.weight) for r in edges.collect()} == {
        (0, 0, 1, 0, 2.0), (1, 0, 0, 0, 1.0), (1, 0, 1, 1, 3.0), (1, 1, 1, 0, 2.0),
    }


def test_distances(spark):
    df = spark.sql("SELECT 1 AS r1, 2 AS c1, 4 AS r2, 6 AS c2")
    got = df.select(*[grid_distance("r1", "c1", "r2", "c2", k).alias(k) for k in ("manhattan", "euclidean", "chebyshev")]).first()
    assert tuple(got) == (7.0, 5.0, 4.0)
    with pytest.raises(ValueError):
        grid_distance("r1", "c1", "r2", "c2", "other")


def test_contraction_keeps_costs_and_hops(spark):
    rng = random.Random(11)
    rows = ["".join("#" if rng.random() < 0.2 and (r, c) != (0, 0) else "." for c in range(14)) for r in range(14)]
    costs = [[rng.randint(0, 3) for _ in range(14)] for _ in range(14)]
    edges = graph.grid_edges(grid(spark, rows, costs))
    found = {tuple(r) for r in graph.shortest_paths(edges, point(spark, (0, 0))).collect()}
    assert found == {tuple(r) for r in graph.shortest_paths(edges, point(spark, (0, 0)), contract=False).collect()}


def test_contraction_takes_away_most_of_a_long_path(spark):
    ways = spark.range(400).select(F.col("id").alias("src"), (F.col("id") + 1).alias("dst"), F.lit(2.0).alias("weight"), F.lit(1).alias("hop"))
    left, taken = graph.contracted(ways, spark.createDataFrame([(0,), (400,)], "node bigint"))
    assert left.count() < 40 and 5 <= len(taken) <= 14
    total = left.where("src = 0 AND dst = 400").collect() or graph._relaxed(left, spark.createDataFrame([(0,)], "node bigint"), 8, None).where("node = 400").collect()
    assert total[0][-2:] == (800.0, 400)
    edges = ways.drop("hop")
    # Without contraction 400 steps take 50 rounds of eight.
    found = graph.shortest_paths(edges, spark.createDataFrame([(0,)], "node bigint"), max_rounds=8, contract=True)
    assert {(r.node, r.cost, r.hops) for r in found.collect()} == {(i, 2.0 * i, i) for i in range(401)}


def test_broken_weights_are_not_regrouped(spark):
    edges = spark.createDataFrame([(i, i + 1, 0.1) for i in range(12)], "src bigint, dst bigint, weight double")
    assert not graph.require_weights(edges) and graph.require_weights(edges.withColumn("weight", F.lit(3.0)))
    found = graph.shortest_paths(edges, spark.createDataFrame([(0,)], "node bigint"))
    want, total = {0: 0.0}, 0.0
    for i in range(12):
        total += 0.1
        want[i + 1] = total
    assert {r.node: r.cost for r in found.collect()} == want
    assert graph.routes(edges, found, spark.createDataFrame([(12,)], "node bigint")).count() == 13


def test_hubs_are_split(spark, monkeypatch):
    monkeypatch.setattr(graph, "HUB_WAYS", 50)
    edges = spark.createDataFrame([(0, i, float(i)) for i in range(1, 301)] + [(i, 301, 0.5) for i in range(1, 301)], "src bigint, dst bigint, weight double")
    found = {r.node: r.cost for r in graph.shortest_paths(edges, spark.createDataFrame([(0,)], "node bigint")).collect()}
    assert found == {0: 0.0, **{i: float(i) for i in range(1, 301)}, 301: 1.5}


def _left(goal, kind="manhattan", factor=1.0):
    return lambda node: factor * grid_distance(graph.cell_row(node), graph.cell_col(node), F.lit(goal[0]), F.lit(goal[1]), kind)


def test_directed_path_is_the_cheapest_and_reads_less(spark):
    rng = random.Random(11)
    rows = ["".join("#" if rng.random() < 0.2 and (r, c) not in ((5, 7), (5, 11)) else "." for c in range(20)) for r in range(11)]
    costs = [[rng.randint(1, 3) for _ in range(20)] for _ in range(11)]
    edges = graph.grid_edges(grid(spark, rows, costs)).persist()
    start, goal = (5, 7), (5, 11)
    found = graph.shortest_path(edges, start[0] << 32 | start[1], goal[0] << 32 | goal[1], _left(goal)).persist()
    want, got = dijkstra(rows, costs, start), costs_of(found)
    assert got[goal] == want[goal] and all(want[n] == cost for n, cost in got.items())
    assert len(got) < len(want) / 2
    steps = graph.routes(edges, found, point(spark, goal)).orderBy("step").collect()
    cells = [(r.node >> 32, r.node & 0xFFFFFFFF) for r in steps]
    assert cells[0] == start and cells[-1] == goal and [r.cost for r in steps] == [want[c] for c in cells]
    assert all(want[a] + costs[b[0]][b[1]] == want[b] and abs(a[0] - b[0]) + abs(a[1] - b[1]) == 1 for a, b in zip(cells, cells[1:]))


def test_directed_path_out_of_reach_or_trivial(spark):
    edges = graph.grid_edges(grid(spark, [".#.", ".#."]))
    assert graph.shortest_path(edges, 0, 2, _left((0, 2))).isEmpty()
    assert costs_of(graph.shortest_path(edges, 0, 0)) == {(0, 0): 0.0}


@pytest.mark.parametrize("factor", [1.5, -1.0])
def test_wrong_potentials_are_errors(spark, factor):
    edges = graph.grid_edges(grid(spark, ["....", "...."]))
    with pytest.raises(ValueError, match="potential"):
        graph.shortest_path(edges, 0, 3, _left((0, 3), factor=factor))


def _random_grid(seed, rows, cols, kept):
    rng = random.Random(seed)
    lines = ["".join("#" if rng.random() < 0.25 and (r, c) not in kept else "." for c in range(cols)) for r in range(rows)]
    return lines, [[rng.randint(0, 3) for _ in range(cols)] for _ in range(rows)]


@pytest.mark.parametrize("block", ["squares", "any", "one"])
def test_blocks_give_the_same_costs_and_hops(spark, monkeypatch, block):
    monkeypatch.setattr(graph, "BLOCK_SIDE", 5)
    rows, costs = _random_grid(3, 17, 19, {(0, 0)})
    edges = graph.grid_edges(grid(spark, rows, costs)).persist()
    blocks = {"squares": graph.grid_block, "any": lambda node: F.pmod(F.hash(node), F.lit(7)), "one": lambda node: F.lit(0)}
    found = graph.shortest_paths(edges, point(spark, (0, 0)), block=blocks[block])
    best, queue, ways = {}, [(0.0, 0, 0)], {}
    for e in edges.collect():
        ways.setdefault(e.src, []).append((e.dst, e.weight))
    while queue:
        cost, hops, node = heapq.heappop(queue)
        if node not in best:
            best[node] = (cost, hops)
            for other, weight in ways.get(node, ()):
                heapq.heappush(queue, (cost + weight, hops + 1, other))
    assert {r.node: (r.cost, r.hops) for r in found.collect()} == best and len(best) > 100


def test_blocks_take_a_round_for_each_crossing(spark, monkeypatch):
    monkeypatch.setattr(graph, "BLOCK_SIDE", 50)
    edges = graph.grid_edges(grid(spark, ["." * 400]))
    found = graph.shortest_paths(edges, point(spark, (0, 0)), block=graph.grid_block, max_rounds=8)
    assert {r.node: (r.cost, r.hops) for r in found.collect()} == {i: (float(i), i) for i in range(400)}
    with pytest.raises(RuntimeError):
        graph.shortest_paths(edges, point(spark, (0, 0)), block=graph.grid_block, max_rounds=7)


def test_blocks_with_loose_sources_broken_weights_and_parallel_ways(spark):
    rows = [(i, i + 1, 0.1) for i in range(12)] + [(3, 4, 0.05), (3, 4, 0.05), (5, 5, 0.0), (6, 5, 0.0), (None, 2, 0.0), (2, None, 0.0)]
    edges = spark.createDataFrame(rows, "src bigint, dst bigint, weight double")
    sources = spark.createDataFrame([(0,), (0,), (99,), (None,)], "node bigint")
    want, total = {0: (0.0, 0), 99: (0.0, 0)}, 0.0
    for i in range(12):
        total += 0.05 if i == 3 else 0.1
        want[i + 1] = (total, i + 1)
    for block in (lambda node: F.floor(node / 3), lambda node: node, lambda node: F.lit(1)):
        assert {r.node: (r.cost, r.hops) for r in graph.shortest_paths(edges, sources, block=block).collect()} == want


def test_directed_path_by_blocks(spark, monkeypatch):
    monkeypatch.setattr(graph, "BLOCK_SIDE", 4)
    start, goal = (5, 7), (5, 11)
    rows, costs = _random_grid(11, 13, 22, {start, goal})
    costs = [[cost + 1 for cost in line] for line in costs]
    edges = graph.grid_edges(grid(spark, rows, costs)).persist()
    first, last = start[0] << 32 | start[1], goal[0] << 32 | goal[1]
    want = dijkstra(rows, costs, start)
    for factor, left in ((1, _left(goal)), (0, None)):
        found = costs_of(graph.shortest_path(edges, first, last, left, block=graph.grid_block))
        assert found == {n: c for n, c in want.items() if c + factor * (abs(n[0] - goal[0]) + abs(n[1] - goal[1])) <= want[goal]}
    steps = graph.routes(edges, graph.shortest_path(edges, first, last, _left(goal), block=graph.grid_block), point(spark, goal)).orderBy("step").collect()
    assert [s.cost for s in steps] == [want[(s.node >> 32, s.node & 0xFFFFFFFF)] for s in steps] and steps[-1].node == last
    walled = graph.grid_edges(grid(spark, [".#.", ".#."]))
    assert graph.shortest_path(walled, 0, 2, _left((0, 2)), block=graph.grid_block).isEmpty()
    assert costs_of(graph.shortest_path(walled, 0, 0, block=graph.grid_block)) == {(0, 0): 0.0}


def test_dense_graphs_are_not_contracted(spark, monkeypatch):
    def refused(*_):
        raise AssertionError("no node has few ways")

    monkeypatch.setattr(graph, "contracted", refused)
    rng = random.Random(5)
    links = [(a, 100 + b, float(rng.randint(1, 50))) for a in range(30) for b in range(30)]
    rows = links + [(b, a, w) for a, b, w in links] + [(0, 100, 60.0), (7, 7, 0.0), (None, 3, 1.0)]
    best, queue = {}, [(0.0, 0, 0)]
    while queue:
        cost, hops, node = heapq.heappop(queue)
        if node not in best:
            best[node] = (cost, hops)
            for a, b, w in rows:
                if a == node:
                    heapq.heappush(queue, (cost + w, hops + 1, b))
    edges = spark.createDataFrame(rows, "src bigint, dst bigint, weight double")
    found = graph.shortest_paths(edges, spark.createDataFrame([(0,)], "node bigint"))
    assert {r.node: (r.cost, r.hops) for r in found.collect()} == best and len(best) == 60


def test_steps_do_not_sort_the_ways(spark):
    ways = spark.range(1000).select(F.col("id").alias("src"), F.lit(0).alias("part"), (F.col("id") + 1).alias("dst"), F.lit(1.0).alias("weight"), F.lit(1).alias("hop"))
    frontier = spark.range(10).select(F.col("id").alias("node"), F.lit(0.0).alias("cost"), F.lit(0).alias("hops"))
    plan = graph._passed_on(frontier, ways, 1)._jdf.queryExecution().toString()
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan
