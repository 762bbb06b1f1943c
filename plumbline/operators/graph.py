"""Grids as edge tables, and shortest paths over edge tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.numbers import as_column
from plumbline.operators.block_paths import paths_by_block
from plumbline.session import enable_checkpoints, scratch_table_path

# The four neighbours of a cell as (row, col) steps.
NEIGHBOURS = ((-1, 0), (1, 0), (0, -1), (0, 1))
# Rows, and columns, of the cells in one block of a grid.
BLOCK_SIDE = 256
# Ways of one source in one partition.
HUB_WAYS = 200_000
# Nodes with more ways, in and out, are not contracted.
MOST_WAYS = 24
# Share of the nodes that a round of contraction must be able to take away.
LEAST_SHARE = 0.15
# Chosen nodes up to which each executor gets them all.
BROADCAST_NODES = 200_000
# Nodes of a frontier up to which a round takes all its steps.
SMALL_FRONTIER = 20_000
# Whole numbers below this are exact as doubles.
EXACT = 2**53


class BlockedCell(ValueError):
    """A start or goal is a wall or no cell of the grid."""


def cell_id(row: Column | str, col: Column | str) -> Column:
    """One number per cell, whatever the size of the grid: row in the upper half, column in the lower."""
    return F.shiftleft(as_column(row).cast("bigint"), 32).bitwiseOR(as_column(col).cast("bigint"))


def cell_row(node: Column | str) -> Column:
    return F.shiftright(as_column(node), 32).cast("int")


def cell_col(node: Column | str) -> Column:
    return as_column(node).bitwiseAND(F.lit((1 << 32) - 1)).cast("int")


def grid_block(node: Column | str) -> Column:
    """The square of a grid that a cell lies in, for the ``block`` of the path searches."""
    return cell_id(F.floor(cell_row(node) / BLOCK_SIDE), F.floor(cell_col(node) / BLOCK_SIDE))


def grid_edges(cells: DataFrame) -> DataFrame:
    """Edges (src, dst, weight) between open neighbours of ``cells(row, col, wall, cost)``.

    A step costs what the entered cell costs, one where that is null. Each cell
    offers its cost to its four neighbours; one equi-join drops the offers that
    reach no open cell.
    """
    open_cells = cells.where(~F.col("wall"))
    steps = F.array(*[F.struct(F.lit(r).alias("r"), F.lit(c).alias("c")) for r, c in NEIGHBOURS])
    offers = open_cells.select(
        cell_id("row", "col").alias("dst"),
        F.coalesce(F.col("cost"), F.lit(1)).cast("double").alias("weight"),
        F.col("row"),
        F.col("col"),
        F.explode(steps).alias("step"),
    ).select(
        (F.col("row") + F.col("step.r")).alias("row"), (F.col("col") + F.col("step.c")).alias("col"), "dst", "weight"
    )
    offers = offers.where("row >= 0 AND col >= 0")
    sources = open_cells.select(cell_id("row", "col").alias("src"))
    return offers.withColumn("src", cell_id("row", "col")).join(sources, "src").select("src", "dst", "weight")


def require_open(cells: DataFrame, points: list[tuple[int, int]]) -> None:
    """Raise unless all given (row, col) points are open cells."""
    wanted = F.lit(False)
    for row, col in points:
        wanted = wanted | ((F.col("row") == row) & (F.col("col") == col))
    found = {(r.row, r.col) for r in cells.where(wanted & ~F.col("wall")).select("row", "col").distinct().collect()}
    for point in points:
        if tuple(point) not in found:
            raise BlockedCell(f"cell {point} is a wall or outside the grid")


def require_weights(edges: DataFrame) -> bool:
    """Raise if a weight is null, NaN or negative, with the number of such edges; else whether sums of weights are exact.

    They are for whole numbers with a total that a double holds exactly.
    """
    weight = F.col("weight").cast("double")
    counts = edges.agg(
        F.count_if(weight.isNull() | F.isnan(weight)).alias("missing"), F.count_if(weight < 0).alias("negative"),
        F.count_if(weight != F.floor(weight)).alias("broken"), F.sum(weight).alias("total"),
    ).first()
    if counts.missing or counts.negative:
        raise ValueError(f"{counts.missing} edges have no weight and {counts.negative} a negative one")
    return counts.broken == 0 and (counts.total or 0) < EXACT


def _settled(frame: DataFrame, name: str) -> DataFrame:
    path = scratch_table_path(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def _least(ways: DataFrame) -> DataFrame:
    """The cheapest way from each node to each other, with the fewest hops at that cost."""
    best = ways.where("src != dst").groupBy("src", "dst").agg(F.min(F.struct("weight", "hop")).alias("way"))
    return best.select("src", "dst", "way.weight", "way.hop")


def _simple(edges: DataFrame) -> DataFrame:
    """Ways of one hop, the cheapest from each node to each other."""
    best = edges.where("src != dst").groupBy("src", "dst").agg(F.min(F.col("weight").cast("double")).alias("weight"))
    return best.withColumn("hop", F.lit(1))


def _few_ways(ways: DataFrame) -> tuple[int, int]:
    """Nodes of few enough ways to be contracted, and all nodes."""
    degrees = ways.select(F.explode(F.array("src", "dst")).alias("node")).groupBy("node").agg(F.count(F.lit(1)).alias("degree"))
    found = degrees.agg(F.count_if(F.col("degree") <= MOST_WAYS).alias("few"), F.count(F.lit(1)).alias("nodes")).first()
    return found.few, found.nodes


def _independent(ways: DataFrame, kept: DataFrame, round: int) -> DataFrame:
    """Nodes of few ways, no two of them neighbours, none of ``kept``: those that come before all their neighbours."""
    ends = ways.select(F.col("src").alias("node"), F.col("dst").alias("other")).unionByName(ways.select(F.col("dst").alias("node"), F.col("src").alias("other")))
    degrees = ends.groupBy("node").agg(F.count(F.lit(1)).alias("degree"))
    first = lambda node: F.struct("degree", F.xxhash64(node, F.lit(round)).alias("mark"), F.col(node).alias("name"))
    nearby = ends.join(degrees.withColumnRenamed("node", "other"), "other").groupBy("node").agg(F.min(first("other")).alias("rival"))
    chosen = degrees.where(F.col("degree") <= MOST_WAYS).join(nearby, "node").where(first("node") < F.col("rival"))
    return chosen.select("node").join(kept, "node", "left_anti")


def contracted(ways: DataFrame, kept: DataFrame, least_share: float = LEAST_SHARE) -> tuple[DataFrame, list[DataFrame]]:
    """A smaller graph with the same least costs between the nodes that remain, and what leads back to the others.

    ``ways`` are (src, dst, weight, hop), ``kept(node)`` stay. A round takes away a set of
    nodes of few ways, no two of them neighbours, and joins what led into each with what led
    out. Nodes with more than :data:`MOST_WAYS` ways stay, so no node adds more than its
    square. Rounds end when one takes away less than ``least_share`` of the nodes. The list
    holds the ways into the nodes that each round took.
    """
    kept = kept.select("node").distinct()
    taken: list[DataFrame] = []
    ways = _settled(_least(ways), "ways")
    nodes = ways.select(F.explode(F.array("src", "dst")).alias("node")).distinct().count()
    while True:
        chosen = _settled(_independent(ways, kept, len(taken)), "chosen")
        size = chosen.count()
        if size == 0 or size < least_share * nodes:
            return ways, taken
        nodes -= size
        gone = F.broadcast(chosen) if size <= BROADCAST_NODES else chosen
        leaves, enters = F.col("src") == F.col("node"), F.col("dst") == F.col("node")
        into = ways.join(gone, enters, "left_semi")
        out = ways.join(gone, leaves, "left_semi").select(F.col("src").alias("via"), F.col("dst").alias("end"), F.col("weight").alias("w"), F.col("hop").alias("h"))
        through = into.join(out, F.col("dst") == F.col("via")).select("src", F.col("end").alias("dst"), (F.col("weight") + F.col("w")).alias("weight"), (F.col("hop") + F.col("h")).alias("hop"))
        rest = ways.join(gone, leaves, "left_anti").join(gone, enters, "left_anti")
        taken.append(into)
        ways = _settled(_least(rest.unionByName(through)), "ways")


def shortest_paths(
    edges: DataFrame, sources: DataFrame, steps_per_round: int = 8, max_rounds: int | None = None, contract: bool | None = None,
    block: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """Lowest cost from the nearest source to every node that can be reached.

    ``edges(src, dst, weight)`` with weights that are not negative, ``sources(node)``.
    Result: node, cost, hops, where hops is the least number of edges at that cost.
    Nodes out of reach are absent.

    Where sums of weights are exact, the graph is first contracted (:func:`contracted`):
    paths that would take hundreds of steps take a few dozen over what remains, and one
    join per round leads back to the nodes taken away. Elsewhere regrouped sums would
    differ in their last digits, and all nodes are reached step by step.

    ``max_rounds`` is a guard that raises when paths are longer than expected; it never
    shortens a result. As it is about paths over the edges themselves, nothing is contracted
    where it is given, unless ``contract`` is true: then it is about what remains.

    ``block`` maps a node to the number of the block it lies in, such as :func:`grid_block`.
    Any function of the node is right; it serves where few ways lead from block to block and a
    task can hold the ways of one. Blocks are then searched whole in tasks
    (:func:`plumbline.operators.block_paths.paths_by_block`), ``max_rounds`` is about the blocks
    that paths cross, and ``steps_per_round`` and ``contract`` do not matter.
    """
    exact = require_weights(edges)
    if block:
        return paths_by_block(edges, sources, block, max_rounds)
    contract = max_rounds is None if contract is None else contract
    ways = edges.select("src", "dst", F.col("weight").cast("double").alias("weight"), F.lit(1).alias("hop"))
    taken: list[DataFrame] = []
    if contract and exact:
        ways = _settled(_simple(edges), "simple")
        few, nodes = _few_ways(ways)
        # A round takes away none but nodes of few ways; where these are too few, it need not be tried.
        if few and few >= LEAST_SHARE * nodes:
            ways, taken = contracted(ways, sources)
    found = _relaxed(ways, sources, steps_per_round, max_rounds)
    spark = edges.sparkSession
    log = scratch_table_path(spark, "paths-back")
    read = spark.read.schema(found.schema)
    found.write.parquet(f"{log}/round=0")
    for k, into in enumerate(reversed(taken)):
        known = read.parquet(*[f"{log}/round={i}" for i in range(k + 1)])
        offers = into.join(known, F.col("src") == F.col("node")).select(
            F.col("dst").alias("node"), (F.col("cost") + F.col("weight")).alias("cost"), (F.col("hops") + F.col("hop")).alias("hops")
        )
        # Nodes taken in one round are no neighbours, so all that leads into them is known by now.
        _best(offers).write.parquet(f"{log}/round={k + 1}")
    return read.parquet(*[f"{log}/round={i}" for i in range(len(taken) + 1)])


def _relaxed(ways: DataFrame, sources: DataFrame, steps_per_round: int, max_rounds: int | None) -> DataFrame:
    """(node, cost, hops) of all nodes that can be reached, in rounds of steps from the nodes just improved.

    Ways are dealt once by source; where one has more than :data:`HUB_WAYS` of them, those
    of each source over several partitions, so that a hub is no single task. A round sends
    only the nodes improved by the last one over up to ``steps_per_round`` of their ways,
    fewer while there are many, keeps the best offer per target, and drops offers that a
    known cost beats. What remains is written to the scratch folder and is the next
    frontier: a round writes its improvements and never the whole state again, and a lost
    executor's part is read from there.
    """
    spark = ways.sparkSession
    most = ways.groupBy("src").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    parts = -(-most // HUB_WAYS) or 1
    ways = ways.select("src", F.pmod(F.hash("dst"), F.lit(parts)).alias("part"), "dst", "weight", "hop")
    key = ["src"] if parts == 1 else ["src", "part"]
    # A step to itself keeps a node's offer, so that several steps are one chain of joins.
    ends = ways.select(F.explode(F.array("src", "dst")).alias("src")).unionByName(sources.select(F.col("node").alias("src")))
    stays = ends.distinct().select("src", F.lit(0).alias("part"), F.col("src").alias("dst"), F.lit(0.0).alias("weight"), F.lit(0).alias("hop"))
    # As many partitions as shuffles have: a step's result then meets the ways where it was made.
    kept = ways.unionByName(stays).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), *key).persist()
    log = scratch_table_path(spark, "paths")
    start = sources.select("node", F.lit(0.0).alias("cost"), F.lit(0).alias("hops")).where("node IS NOT NULL").distinct()
    read = spark.read.schema(start.schema)
    start.write.parquet(f"{log}/round=0")
    rounds, frontier = 0, read.parquet(f"{log}/round=0")
    try:
        while waiting := frontier.count():
            if max_rounds is not None and rounds >= max_rounds:
                raise RuntimeError(f"no fixed point after {rounds} rounds")
            offers = frontier
            # Many steps save rounds while the frontier is small; a large one would pass on costs that soon improve.
            for _ in range(steps_per_round if waiting <= SMALL_FRONTIER else max(1, steps_per_round // 4)):
                offers = _best(_passed_on(offers, kept, parts))
            # Partitions of the log are rounds; its schema leaves their number out.
            known = read.parquet(*[f"{log}/round={i}" for i in range(rounds + 1)]).select(
                F.col("node").alias("n"), F.col("cost").alias("c"), F.col("hops").alias("h")
            )
            beaten = (F.col("node") == F.col("n")) & (F.struct("c", "h") <= F.struct("cost", "hops"))
            rounds += 1
            offers.join(known, beaten, "left_anti").write.parquet(f"{log}/round={rounds}")
            frontier = read.parquet(f"{log}/round={rounds}")
    finally:
        kept.unpersist()
    return _best(read.parquet(*[f"{log}/round={i}" for i in range(rounds + 1)]))


def require_potential(edges: DataFrame, potential: Callable[[Column], Column], target: int) -> None:
    """Raise unless ``potential`` falls along no edge by more than its weight, is never null or below zero, and is zero at ``target``."""
    near, far = potential(F.col("src")), potential(F.col("dst"))
    slack = F.lit(1e-9) * (F.lit(1.0) + F.abs(near))
    wrong = near.isNull() | far.isNull() | (near < 0) | (far < 0) | (near > F.col("weight") + far + slack)
    count = edges.agg(F.count_if(wrong | ((F.col("dst") == target) & (far > slack)))).first()[0]
    if count:
        raise ValueError(f"the potential is wrong at {count} edges: it must not exceed what is left to the target")


def shortest_path(
    edges: DataFrame, source: int, target: int, potential: Callable[[Column], Column] | None = None, steps_per_round: int = 4,
    block: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """Lowest costs from ``source`` to the nodes that can lie on a cheapest path to ``target``.

    Result as of :func:`shortest_paths`, for all nodes with cost plus potential up to the
    target's cost; empty if the target is out of reach. :func:`routes` gives the path.

    ``potential`` maps a node to a lower bound of what is left to the target, such as
    :func:`plumbline.functions.distance.grid_distance`; a bound that could be wrong raises.
    Without one all bounds are zero. A round takes steps only from nodes whose cost plus
    potential is below a limit, which rises while the target is not settled. Once the target
    has a cost, whatever cannot beat it is dropped. Waiting nodes and improvements are written
    to the scratch folder each round. With ``block``, as of :func:`shortest_paths`, a round searches
    whole blocks that have such a node.
    """
    require_weights(edges)
    bound = potential or (lambda node: F.lit(0.0))
    if potential:
        require_potential(edges, potential, target)
    spark = edges.sparkSession
    start = spark.createDataFrame([(source, 0.0, 0)], "node bigint, cost double, hops int")
    if block:
        reach = (edges.agg(F.avg("weight")).first()[0] or 1.0) * steps_per_round
        found = paths_by_block(edges, start, block, bound=bound, target=target, reach=reach)
        settled = F.col("cost") + bound(F.col("node"))
        best = found.where(F.col("node") == target).agg(F.min("cost")).first()[0]
        return start.limit(0) if best is None else found.where(settled <= best * (1 + 1e-9) + 1e-9)
    ways = edges.select("src", F.lit(0).alias("part"), "dst", F.col("weight").cast("double").alias("weight"), F.lit(1).alias("hop"))
    ways = ways.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "src").persist()
    reach = ways.agg(F.avg("weight")).first()[0] or 1.0
    log, waiting = scratch_table_path(spark, "path"), scratch_table_path(spark, "waiting")
    read = spark.read.schema(start.schema)
    start.write.parquet(f"{log}/round=0")
    start.write.parquet(f"{waiting}/round=0")
    total = F.col("cost") + bound(F.col("node"))
    rounds, best, limit = 0, None, float("-inf")
    try:
        while True:
            known = read.parquet(*[f"{log}/round={i}" for i in range(rounds + 1)])
            best = known.where(F.col("node") == target).agg(F.min("cost")).first()[0]
            most = F.lit(float("inf") if best is None else best * (1 + 1e-9) + 1e-9)
            left = read.parquet(f"{waiting}/round={rounds}").where(total <= most)
            least = left.agg(F.min(total)).first()[0]
            if least is None:
                break
            # The limit rises by a few steps' weight at least, twice as far each time, so rounds stay few.
            limit = max(limit, least + reach * steps_per_round)
            reach *= 2
            inside = total <= F.least(most, F.lit(limit))
            offers = left.where(inside)
            for _ in range(steps_per_round):
                # Nodes beyond the limit stay in the offers and take no step.
                offers = _best(offers.unionByName(_passed_on(offers.where(inside), ways, 1)).where(total <= most))
            beaten = (F.col("node") == F.col("n")) & (F.struct("c", "h") <= F.struct("cost", "hops"))
            held = known.select(F.col("node").alias("n"), F.col("cost").alias("c"), F.col("hops").alias("h"))
            rounds += 1
            offers.join(held, beaten, "left_anti").write.parquet(f"{log}/round={rounds}")
            fresh = read.parquet(f"{log}/round={rounds}")
            _best(fresh.unionByName(left.where(~inside))).write.parquet(f"{waiting}/round={rounds}")
    finally:
        ways.unpersist()
    if best is None:
        return start.limit(0)
    return _best(known).where(total <= most)


def _passed_on(frontier: DataFrame, ways: DataFrame, parts: int) -> DataFrame:
    """What the frontier's nodes offer to the ends of their ways and to themselves."""
    senders = frontier.select(F.col("node").alias("src"), "cost", "hops")
    if parts > 1:
        senders = senders.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    # The frontier is looked up, so that the far more ways are not sorted at every step.
    return senders.hint("shuffle_hash").join(ways if parts > 1 else ways.drop("part"), ["src", "part"] if parts > 1 else "src").select(
        F.col("dst").alias("node"), (F.col("cost") + F.col("weight")).alias("cost"), (F.col("hops") + F.col("hop")).alias("hops")
    )


def _best(offers: DataFrame) -> DataFrame:
    """The lowest cost per node with the fewest hops at that cost, combined before the shuffle."""
    best = offers.groupBy("node").agg(F.min(F.struct("cost", "hops")).alias("best"))
    return best.select("node", "best.cost", "best.hops")


def predecessors(edges: DataFrame, distances: DataFrame) -> DataFrame:
    """For each reached node the smallest predecessor on an optimal path: (node, parent).

    Hops fall along the predecessors, so they form a tree even where edges cost nothing.
    """
    near = distances.select(F.col("node").alias("src"), F.col("cost").alias("c0"), F.col("hops").alias("h0"))
    far = distances.select(F.col("node").alias("dst"), F.col("cost").alias("c1"), F.col("hops").alias("h1"))
    tight = edges.join(near, "src").join(far, "dst").where("c0 + weight = c1 AND h0 + 1 = h1")
    return tight.groupBy(F.col("dst").alias("node")).agg(F.min("src").alias("parent"))


def routes(edges: DataFrame, distances: DataFrame, targets: DataFrame) -> DataFrame:
    """One optimal path to each of ``targets(node)``, as rows (target, step, node, cost).

    Step 0 is the source. Paths are unrolled by doubling: jumps over 1, 2, 4, ...
    predecessors, so a path of L edges takes log2(L) joins. A target out of reach
    has no rows.
    """
    spark = edges.sparkSession
    enable_checkpoints(spark)
    jump = predecessors(edges, distances).select("node", F.col("parent").alias("up")).checkpoint()
    reached = targets.select(F.col("node").alias("target")).distinct().join(
        distances.select(F.col("node").alias("target"), F.col("hops").alias("length")), "target"
    )
    found = reached.select("target", "length", F.lit(0).alias("back"), F.col("target").alias("node")).checkpoint()
    longest = found.agg(F.max("length")).first()[0] or 0
    width = 1
    while width <= longest:
        further = found.join(jump, "node").select(
            "target", "length", (F.col("back") + width).alias("back"), F.col("up").alias("node")
        )
        found = found.unionByName(further).checkpoint()
        width *= 2
        if width <= longest:
            second = jump.select(F.col("node").alias("up"), F.col("up").alias("up2"))
            jump = jump.join(second, "up").select("node", F.col("up2").alias("up")).checkpoint()
    return found.join(distances.select("node", "cost"), "node").select(
        "target", (F.col("length") - F.col("back")).alias("step"), "node", "cost"
    )
