"""Terminals within a radius of each customer."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txlake.operators.skew import broadcast_if_small
from txlake.session import stage


CELL_PAIRS = 4_000_000
MAX_LEVEL = 24
# Pairs that one task makes, and points of one place that meet others in one piece.
TASK_PAIRS = 20_000_000
PIECE = 2_000


def pairs_within_radius(customers: DataFrame, terminals: DataFrame, r: float, cell_pairs: int = CELL_PAIRS, piece: int = PIECE) -> DataFrame:
    """(customer_id, terminal_id) of all pairs closer than ``r``.

    Distinct places are paired first, without their ids, so points at one place count once. Ids come
    last, so no row carries a list, however many ids a place has. Points without a place have no pair.
    Of two near places the ids meet in pieces of ``piece`` by ``piece``, dealt over tasks by the exact
    number of pairs; a point is copied once per near place and piece of it, few against its pairs.
    """
    near = stage(_near_places(_places(customers, "x", "y"), _places(terminals, "tx", "ty"), r, cell_pairs), "near-places")
    who = customers.select("customer_id", *_at("x_location", "y_location", "_x", "_y"))
    what = terminals.select("terminal_id", *_at("x_location", "y_location", "_tx", "_ty"))
    n_who = who.groupBy("_x", "_y").agg(F.count(F.lit(1)).alias("_n"))
    n_what = what.groupBy("_tx", "_ty").agg(F.count(F.lit(1)).alias("_m"))
    pieces = lambda n: F.ceil(F.col(n) / F.lit(piece)).cast("long")
    # Written before they are read twice, so a number names the same two places on both sides.
    met = stage(
        near.join(n_who, ["_x", "_y"]).join(n_what, ["_tx", "_ty"])
        .withColumns({"_i_all": pieces("_n"), "_j_all": pieces("_m"), "_met": F.monotonically_increasing_id()}),
        "met-places",
    )
    pairs = met.agg(F.sum(F.col("_n") * F.col("_m"))).first()[0] or 0

    def piece_of(key: str, n: str) -> Column:
        return F.pmod(F.xxhash64(key), F.col(n))

    def each(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))

    keys = ["_met", "_i", "_j"]
    left = who.join(met, ["_x", "_y"]).select("customer_id", "_met", piece_of("customer_id", "_i_all").alias("_i"), each("_j_all").alias("_j"))
    right = what.join(met, ["_tx", "_ty"]).select("terminal_id", "_met", each("_i_all").alias("_i"), piece_of("terminal_id", "_j_all").alias("_j"))
    return _dealt(left, pairs, keys).join(_dealt(right, pairs, keys), keys).select("customer_id", "terminal_id")


def _dealt(df: DataFrame, pairs: int, keys: list[str]) -> DataFrame:
    """``df`` by the keys of a join that makes ``pairs`` rows, over tasks by their number: adaptive execution
    counts only the bytes read, and a few megabytes of points make billions of pairs."""
    tasks = math.ceil(pairs / TASK_PAIRS)
    return df.repartition(tasks, *keys) if tasks > 1 else df


def _at(x: str, y: str, to_x: str, to_y: str):
    # Adding 0.0 turns -0.0 into 0.0, so equal places also hash alike.
    return [(F.col(x) + 0.0).alias(to_x), (F.col(y) + 0.0).alias(to_y)]


def _places(df: DataFrame, x: str, y: str) -> DataFrame:
    placed = df.select(*_at("x_location", "y_location", f"_{x}", f"_{y}"))
    return placed.where(F.col(f"_{x}").isNotNull() & F.col(f"_{y}").isNotNull()).distinct()


def _in_reach(side: float, r: float) -> Column:
    """Whether a terminal's place can be within ``r`` of some place of the cell; never wrongly no."""

    def gap(v: str, cell: str) -> Column:
        low = F.col(cell) * F.lit(side)
        return F.greatest(low - F.col(v), F.col(v) - (low + F.lit(side)), F.lit(0.0))

    dx, dy = gap("_tx", "_cellx"), gap("_ty", "_celly")
    # Rounding of the borders must not lose a place on them.
    return F.sqrt(dx * dx + dy * dy) <= F.lit(r + 1e-6 * side) + (F.abs("_tx") + F.abs("_ty")) * F.lit(1e-12)


def _cells(df: DataFrame, x: str, y: str, side: float) -> DataFrame:
    return df.withColumns({"_cellx": F.floor(F.col(x) / F.lit(side)), "_celly": F.floor(F.col(y) / F.lit(side))})


def _exploded(stops: DataFrame, base: Callable[[Column], Column], offsets: tuple[int, ...]) -> DataFrame:
    """Each stop once per cell at ``offsets`` from ``base`` of its cell's numbers."""
    steps = F.array(*[F.lit(d).cast("long") for d in offsets])
    around = lambda c: F.explode(F.transform(steps, lambda d: base(F.col(c)) + d))
    wide = stops.select("_tx", "_ty", "_celly", around("_cellx").alias("_cellx"))
    return wide.select("_tx", "_ty", "_cellx", around("_celly").alias("_celly"))


def _near_places(places: DataFrame, stops: DataFrame, r: float, cell_pairs: int = CELL_PAIRS) -> DataFrame:
    """Pairs (_x, _y, _tx, _ty) of distinct places closer than ``r``.

    Places lie in square cells of side ``r``; a terminal's place is sent to its own cell and those of the
    eight around it that it can reach, so the join is on the cell and only then on the distance. A cell
    whose places times terminals exceed ``cell_pairs``, by an exact count, is divided into four, and so on
    where most places are: a quadtree, deep only where it must be. A terminal goes on to those of the four
    that it can reach. So no key of a join holds more than ``cell_pairs``, and the copies of a terminal are
    few against its pairs: of a cell smaller than the radius, most places that it reaches are near.
    """
    r, cell = float(r), ["_cellx", "_celly"]
    side, found, tried = r, None, 0
    here = _cells(places.select("_x", "_y"), "_x", "_y", side)
    there = _exploded(_cells(stops.select("_tx", "_ty"), "_tx", "_ty", side), lambda c: c, (-1, 0, 1)).where(_in_reach(side, r))
    for level in range(MAX_LEVEL + 1):
        dense = None
        if level < MAX_LEVEL:
            here, there = stage(here, "radius-places"), stage(there, "radius-stops")
            n_here, n_there = here.groupBy(*cell).agg(F.count(F.lit(1)).alias("_n")), there.groupBy(*cell).agg(F.count(F.lit(1)).alias("_m"))
            sizes = stage(n_here.join(n_there, cell).select(*cell, "_n", (F.col("_n") * F.col("_m")).alias("_pairs")), "radius-sizes")
            divided = (F.col("_pairs") > cell_pairs) & (F.col("_n") > 1)
            tried = sizes.agg(F.sum(F.when(~divided, F.col("_pairs")))).first()[0] or 0
            dense = broadcast_if_small(sizes.where(divided).select(*cell))
            dense = dense if dense.take(1) else None
        light = (here, there) if dense is None else (here.join(dense, cell, "left_anti"), there.join(dense, cell, "left_anti"))
        dx, dy = F.col("_x") - F.col("_tx"), F.col("_y") - F.col("_ty")
        near = _dealt(light[0], tried, cell).join(_dealt(light[1], tried, cell), cell).where(F.sqrt(dx * dx + dy * dy) < F.lit(r)).select("_x", "_y", "_tx", "_ty")
        found = near if found is None else found.unionByName(near)
        if dense is None:
            return found
        side /= 2
        here = _cells(here.join(dense, cell, "left_semi").select("_x", "_y"), "_x", "_y", side)
        there = _exploded(there.join(dense, cell, "left_semi"), lambda c: c * 2, (0, 1)).where(_in_reach(side, r))


def within_radius(customers: DataFrame, terminals: DataFrame, r: float) -> DataFrame:
    """Customers with ``available_terminals`` (sorted ids closer than ``r``) and ``nb_terminals``.

    The list form of :func:`pairs_within_radius`: one row holds all ids in reach of its customer.
    Customers at one place share one answer. Customers without a terminal in reach keep an empty
    list.
    """
    near = _near_places(_places(customers, "x", "y"), _places(terminals, "tx", "ty"), r)
    what = terminals.select("terminal_id", *_at("x_location", "y_location", "_sx", "_sy"))
    near = (
        near.join(what, (F.col("_tx") == F.col("_sx")) & (F.col("_ty") == F.col("_sy")))
        .groupBy("_x", "_y")
        .agg(F.array_sort(F.collect_list("terminal_id")).alias("_found"))
    )
    joined = customers.join(
        near,
        (customers["x_location"] + 0.0 == near["_x"]) & (customers["y_location"] + 0.0 == near["_y"]),
        "left",
    )
    empty = F.array().cast("array<bigint>")
    found = F.coalesce(F.col("_found").cast("array<bigint>"), empty)
    return joined.select(
        *customers.columns, found.alias("available_terminals"), F.size(found).alias("nb_terminals")
    )
