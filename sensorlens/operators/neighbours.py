"""Exact nearest neighbours by pivots, and the classifier and regressor that vote with them.

Rows are dealt into cells by their nearest pivot, a cell into rings: it is cut at the mean of its widest
column, and so are its parts, until a part holds few rows. Every part knows the box of its rows.
A row asks in two steps. Among the rows of the ring of its own place, counts of distances up to a scale of thresholds
give a first bound on the distance of its k-th neighbour. Then it visits the cells that the bound cannot rule out (by the
cell's radius and by the plane between two pivots), and of these, from part to part, the rings whose box lies within the
bound. Both steps are equi-joins on cell and ring; no row meets rows outside the rings it has to see.

Equal points are kept once per neighbour they can give: of a point that a third of all rows share,
each task hands on the first k. Rows that ask with the same point ask once. What the driver
holds is a table of pivots, at most ``MOST_PIVOTS``, with k distances each. Boxes, a row for some hundred rows, are broadcast.

Rows without a value in one of the features, or with one beyond 1e150, are nobody's neighbour and
have none. Of equal distances the smaller key comes first. With fewer than k rows all are neighbours.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.ml import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sensorlens.functions.columns import all_of, quoted, require_columns
from sensorlens.functions.frames import materialise

MOST_PIVOTS = 64
ROWS_PER_CELL = 2_000
ROWS_PER_RING = 150
MOST_CUTS = 32  # one after the other, from a cell to its rings
CUTS_A_TABLE = 4  # joined in one plan before rows are written down with their part
CUTS_A_VISIT = 3  # passed over between two looks at boxes
QUERIES_A_TASK = 50_000
THRESHOLDS = 30  # of the first bound, three to a halving
LARGEST = 1e150  # squares of larger values overrun doubles
SLACK = 1e-9  # share of a distance that bounds are widened by, far above rounding
WEIGHTS = ("uniform", "distance")


@dataclass(frozen=True)
class NeighbourIndex:
    """Rows by cell and ring, with what the bounds need to know of cells, their parts and rings."""

    features: list[str]
    order: list[str]
    k: int
    pivots: list[list[float]]
    inner: list[list[float]]  # per cell, its k smallest distances to the pivot
    radius: list[float | None]  # per cell, the largest one; None without rows
    points: DataFrame
    rings: DataFrame
    parts: list[DataFrame]  # boxes after 0, 1, ... cuts, the last being the rings
    cuts: list[DataFrame]


def _points(df: DataFrame, features: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """Rows that have all features, as the doubles ``_f0``, ``_f1``, ... (without negative zeros)."""
    values = [quoted(c).cast("double") + F.lit(0.0) for c in features]
    usable = all_of([v.isNotNull() & (F.abs(v) < F.lit(LARGEST)) for v in values])
    return df.filter(usable).select(*[v.alias(f"_f{i}") for i, v in enumerate(values)], *[quoted(c) for c in keep])


def _names(n: int) -> list[str]:
    return [f"_f{i}" for i in range(n)]


def _length(along: Sequence[Column]) -> Column:
    return F.sqrt(reduce(lambda s, t: s + t, [x * x for x in along]))


def _apart(a: Sequence[Column], b: Sequence[Column]) -> Column:
    return _length([x - y for x, y in zip(a, b)])


def _to_pivots(pivots: Sequence[Sequence[float]]) -> Column:
    """The distances of a row's point to all pivots, in their order."""
    held = F.array(*[F.array(*[F.lit(float(x)) for x in p]) for p in pivots])
    own = [F.col(c) for c in _names(len(pivots[0]))]
    return F.transform(held, lambda p: _apart(own, [p[i] for i in range(len(own))]))


def build_index(
    rows: DataFrame,
    features: Sequence[str],
    k: int,
    order: Sequence[str],
    keep: Sequence[str] = (),
    rows_per_cell: int = ROWS_PER_CELL,
    rows_per_ring: int = ROWS_PER_RING,
) -> NeighbourIndex:
    """Index ``rows`` for up to ``k`` neighbours; ``order`` decides between equal distances."""
    features, order = list(features), list(order)
    require_columns(rows, [*features, *order, *keep], "neighbour")
    if not features or k < 1:
        raise ValueError("neighbours need a feature and a k of one or more")
    names, carried = _names(len(features)), [*order, *[c for c in keep if c not in order]]
    copies = W.partitionBy(*names).orderBy(*[quoted(c) for c in order])
    points = _points(rows, features, carried).withColumn("_copy", F.row_number().over(copies))
    points = materialise(points.filter(F.col("_copy") <= k))
    n = points.count()
    if not n:
        return NeighbourIndex(features, order, k, [], [], [], points, points, [], [])
    wanted = min(MOST_PIVOTS, math.ceil(n / rows_per_cell))
    different = points.filter("_copy = 1").select(*names)
    chosen = different.orderBy(F.xxhash64(*names), *names).limit(wanted).collect()
    pivots = [list(r) for r in chosen]
    near = F.array_min(F.transform(_to_pivots(pivots), lambda d, i: F.struct(d.alias("d"), i.alias("i"))))
    placed = points.drop("_copy").withColumn("_near", near).select(
        "*", F.col("_near.i").alias("_cell"), F.col("_near.d").alias("_away")
    )
    placed = materialise(placed.drop("_near"))
    inside = W.partitionBy("_cell").orderBy("_away")
    first = placed.select("_cell", "_away", F.row_number().over(inside).alias("_at")).filter(F.col("_at") <= k)
    inner: list[list[float]] = [[] for _ in pivots]
    for r in first.orderBy("_cell", "_at").collect():
        inner[r["_cell"]].append(r["_away"])
    parted = placed.drop("_away").withColumn("_ring", F.col("_cell").cast("long"))
    parts, cuts = [], []
    while True:
        boxes = materialise(_boxes(parted, names))
        parts.append(boxes)
        cut = boxes.filter((F.col("_n") > rows_per_ring) & F.col("_cut").isNotNull()).select("_ring", "_cut.*")
        if len(cuts) == MOST_CUTS or cut.isEmpty():
            break
        cuts.append(cut)
        parted = _cut(parted, cut, names)
        if len(cuts) % CUTS_A_TABLE == 0:
            parted = materialise(parted)
    radius: list[float | None] = [None] * len(pivots)
    for r in placed.groupBy("_cell").agg(F.max("_away").alias("_radius")).collect():
        radius[r["_cell"]] = r["_radius"]
    placed = materialise(parted.repartition("_cell", "_ring"))
    return NeighbourIndex(features, order, k, pivots, inner, radius, placed, parts[-1], parts, cuts)


def _boxes(parted: DataFrame, names: Sequence[str]) -> DataFrame:
    """Per part its rows, the ends of each column, and the mean of the widest one where that parts the rows."""
    ends = [f(c).alias(f"{c}{end}") for c in names for f, end in ((F.min, "_low"), (F.max, "_high"))]
    spread = F.array_max(F.array(*[F.struct(F.stddev_pop(c).alias("s"), F.lit(-i).alias("i"), F.avg(c).alias("at"),
                                            F.min(c).alias("low"), F.max(c).alias("high")) for i, c in enumerate(names)]))
    boxes = parted.groupBy("_cell", "_ring").agg(F.count("*").alias("_n"), *ends, spread.alias("_wide"))
    wide = F.col("_wide")
    cut = F.when((wide["at"] >= wide["low"]) & (wide["at"] < wide["high"]), F.struct((-wide["i"]).alias("_axis"), wide["at"].alias("_mean")))
    return boxes.withColumn("_cut", cut).drop("_wide")


def _cut(df: DataFrame, cut: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rows moved on from a part to its lower or upper half; a part that is not cut is all lower half."""
    upper = F.get(F.array(*names), F.col("_axis")) > F.col("_mean")
    ring = F.col("_ring") * 2 + F.when(upper, 1).otherwise(0)
    return df.join(F.broadcast(cut), "_ring", "left").withColumn("_ring", ring).drop("_axis", "_mean")


def nearest(index: NeighbourIndex, queries: DataFrame, k: int | None = None) -> DataFrame:
    """A row per different point of ``queries`` and neighbour: its features, rank, distance, the row kept.

    ``_f0``, ``_f1``, ... are the point that asks.
    """
    k = index.k if k is None else k
    if not 1 <= k <= index.k:
        raise ValueError(f"the index serves 1 to {index.k} neighbours, got {k}")
    names = _names(len(index.features))
    carried = [c for c in index.points.columns if not c.startswith("_")]
    asked = _points(queries, index.features, []).distinct().withColumn("_q", F.monotonically_increasing_id())
    if not index.pivots:
        empty = index.points.select(*[quoted(c) for c in carried]).limit(0)
        return asked.drop("_q").limit(0).crossJoin(empty).withColumns({"_rank": F.lit(1), "_distance": F.lit(0.0)})

    reach = F.array(*[F.lit(i[k - 1] if len(i) >= k else None).cast("double") for i in index.inner])
    home = F.array_min(F.transform("_to", lambda d, i: F.struct(d.alias("d"), i.alias("i"))))
    bound = F.array_min(F.zip_with("_to", reach, lambda d, r: (d + r) * F.lit(1 + SLACK)))
    asked = asked.withColumn("_to", _to_pivots(index.pivots)).withColumns(
        {"_home": home["i"], "_at": home["d"], "_bound": F.coalesce(bound, F.lit(float("inf")))}
    )
    asked = asked.drop("_to").withColumn("_ring", F.col("_home").cast("long"))
    for cut in index.cuts:
        asked = _cut(asked, cut, names)
    asked = materialise(asked)
    spark = queries.sparkSession
    # a small table of queries meets many rows: sizes in bytes would put it into one task
    tasks = max(4 * spark.sparkContext.defaultParallelism, -(-asked.count() // QUERIES_A_TASK))
    asked = asked.repartition(tasks)

    far = _length([F.greatest(F.col(c) - F.col(f"{c}_low"), F.col(f"{c}_high") - F.col(c)) for c in names])
    first = asked.join(F.broadcast(index.rings.drop("_cell", "_n", "_cut")), "_ring").withColumn("_far", far * F.lit(1 + SLACK))
    first = first.select("_q", *names, F.col("_home").alias("_cell"), "_ring", "_far").repartition(tasks, "_cell", "_ring")
    closer = _met(first, index, carried, ["_far"])
    steps = [F.lit(0.0), *[F.col("_far") * F.lit(2.0 ** (-i / 3)) for i in reversed(range(THRESHOLDS))]]
    within = [F.count_if(F.col("_distance") <= s).alias(f"_n{i}") for i, s in enumerate(steps)]
    counted = closer.groupBy("_q").agg(F.max("_far").alias("_far"), *within)
    known = F.coalesce(*[F.when(F.col(f"_n{i}") >= k, s) for i, s in enumerate(steps)])
    kth = counted.select("_q", (known * F.lit(1 + SLACK)).alias("_known"))
    bounded = asked.drop("_ring").join(kth, "_q", "left").withColumn("_bound", F.least("_bound", "_known")).drop("_known")
    bounded = bounded.withColumn("_to", _to_pivots(index.pivots))

    widest = F.array(*[F.lit(r).cast("double") for r in index.radius])
    between = [[math.dist(p, q) for q in index.pivots] for p in index.pivots]
    pairs = spark.createDataFrame(list(enumerate(between)), "_home int, _between array<double>")
    # a distance per pair of pivots: at most MOST_PIVOTS ** 2 numbers
    bounded = bounded.join(F.broadcast(pairs), "_home")
    visits = F.transform(
        F.arrays_zip("_to", widest.alias("_widest"), "_between"),
        lambda c, i: F.struct(
            i.alias("_cell"),
            (
                (c["_to"] - c["_widest"] <= F.col("_bound") + SLACK * c["_to"])
                & (
                    c["_to"] * c["_to"] - F.col("_at") * F.col("_at")
                    <= 2 * c["_between"] * F.col("_bound") + SLACK * c["_to"] * c["_to"]
                )
            ).alias("_open"),
        ),
    )
    cells = bounded.select("_q", *names, "_bound", F.inline(F.filter(visits, lambda v: v["_open"])))
    rings = cells.select("_q", *names, "_bound", F.col("_cell").cast("long").alias("_ring"))
    outside = _length([F.greatest(F.col(f"{c}_low") - F.col(c), F.col(c) - F.col(f"{c}_high"), F.lit(0.0)) for c in names])
    last = len(index.parts) - 1
    looks = sorted({*range(0, last, CUTS_A_VISIT), last})
    for at, before in zip(looks, [0, *looks]):
        boxes = index.parts[at].drop("_n", "_cut").withColumn("_of", F.shiftright("_ring", at - before))
        boxes = boxes.withColumnRenamed("_ring", "_next")
        rings = rings.join(F.broadcast(boxes), F.col("_ring") == F.col("_of")).filter(outside <= F.col("_bound") * F.lit(1 + SLACK))
        rings = rings.select("_q", *names, "_bound", "_cell", F.col("_next").alias("_ring")).drop(*(["_cell"] if at != last else []))
    rings = rings.repartition(tasks, "_cell", "_ring")
    met = _met(rings.select("_q", *names, "_bound", "_cell", "_ring"), index, carried, [*names, "_bound"])
    met = met.filter(F.col("_distance") <= F.col("_bound"))
    order = W.partitionBy("_q").orderBy("_distance", *[quoted(c) for c in index.order])
    placed = met.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= k)
    return placed.drop("_bound", "_q")


def _met(asking: DataFrame, index: NeighbourIndex, carried: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """Asking rows joined with the rows of the rings they visit, and the distance between them."""
    names = _names(len(index.features))
    stored = index.points.select(
        "_cell", "_ring", *[F.col(c).alias(f"{c}_of") for c in names], *[quoted(c) for c in carried]
    )
    joined = asking.join(stored, ["_cell", "_ring"])
    away = _apart([F.col(c) for c in names], [F.col(f"{c}_of") for c in names])
    return joined.select("_q", *keep, *[quoted(c) for c in carried], away.alias("_distance"))


def nearest_rows(
    queries: DataFrame,
    rows: DataFrame,
    features: Sequence[str],
    k: int,
    key: str = "id",
    query_key: str | None = None,
) -> DataFrame:
    """(query_<key>, rank, <key>, distance): the ``k`` rows nearest to every row of ``queries``."""
    query_key = query_key or key
    index = build_index(rows, features, k, [key])
    found = nearest(index, queries)
    asking = _points(queries, features, [query_key]).withColumnRenamed(query_key, f"query_{query_key}")
    return asking.join(found, _names(len(features))).select(
        quoted(f"query_{query_key}"), F.col("_rank").alias("rank"), quoted(key), F.col("_distance").alias("distance")
    )


class _NeighbourParams(Params):
    n_neighbors = Param(Params._dummy(), "n_neighbors", "neighbours that vote", TypeConverters.toInt)
    weights = Param(Params._dummy(), "weights", "uniform or distance", TypeConverters.toString)

    def __init__(self) -> None:
        super().__init__()
        self._setDefault(n_neighbors=5, weights="uniform")


class _NeighbourEstimator(Estimator, _NeighbourParams):
    """Keeps the training vectors in an index; ties in distance go to the smaller label."""

    mean: bool

    def __init__(self, n_neighbors: int = 5, weights: str = "uniform"):
        super().__init__()
        if weights not in WEIGHTS:
            raise ValueError(f"weights must be one of {WEIGHTS}, got {weights!r}")
        self._set(n_neighbors=n_neighbors, weights=weights)

    def _fit(self, dataset: DataFrame) -> NeighbourModel:
        first = dataset.select(F.size(vector_to_array("features"))).first()
        if first is None:
            raise ValueError("no rows to be neighbours of")
        spread = _spread(dataset.select("features", "label"), first[0])
        index = build_index(spread, _sources(first[0]), self.getOrDefault("n_neighbors"), ["label"])
        return NeighbourModel(index, self.getOrDefault("weights"), self.mean)


class NeighbourClassifier(_NeighbourEstimator):
    """The label with most votes among the nearest rows, the smaller one if several have as many."""

    mean = False


class NeighbourRegressor(_NeighbourEstimator):
    """The mean label of the nearest rows."""

    mean = True


def _sources(n: int) -> list[str]:
    return [f"_v{i}" for i in range(n)]


def _spread(df: DataFrame, n: int) -> DataFrame:
    values = vector_to_array("features")
    return df.withColumns({f"_v{i}": values[i] for i in range(n)})


class NeighbourModel(Model):
    """Predicts from an index. Rows whose features cannot be compared have no prediction."""

    def __init__(self, index: NeighbourIndex, weights: str, mean: bool):
        super().__init__()
        self.index, self.weights, self.mean = index, weights, mean

    def _transform(self, dataset: DataFrame) -> DataFrame:
        sources, names = self.index.features, _names(len(self.index.features))
        wide = _spread(dataset, len(sources))
        found = nearest(self.index, wide)
        voted = found.groupBy(*names).agg(
            F.array_sort(F.collect_list(F.struct("_rank", "_distance", "label"))).alias("_votes")
        )
        voted = voted.select(*[F.col(c).alias(f"{c}_of") for c in names], self._decided().alias("prediction"))
        same = all_of([F.col(s) + F.lit(0.0) == F.col(f"{c}_of") for s, c in zip(sources, names)])
        return wide.join(voted, same, "left").select(*[quoted(c) for c in dataset.columns], "prediction")

    def _decided(self) -> Column:
        """Votes in order of rank, so that sums do not depend on how rows were dealt."""
        if self.weights == "uniform":
            weighted = F.transform("_votes", lambda v: F.struct(v["label"].alias("l"), F.lit(1.0).alias("w")))
        else:
            nearest_first = F.get("_votes", F.lit(0))["_distance"]
            weighted = F.transform(
                F.filter("_votes", lambda v: (nearest_first > 0) | (v["_distance"] == 0)),
                lambda v: F.struct(v["label"].alias("l"), F.when(nearest_first > 0, 1 / v["_distance"]).otherwise(1.0).alias("w")),
            )
        if self.mean:
            total = F.aggregate(weighted, F.lit(0.0), lambda s, v: s + v["w"])
            return F.aggregate(weighted, F.lit(0.0), lambda s, v: s + v["w"] * v["l"]) / total

        def votes(label: Column) -> Column:
            return F.aggregate(weighted, F.lit(0.0), lambda s, v: s + F.when(v["l"] == label, v["w"]).otherwise(0.0))

        labels = F.array_distinct(F.transform(weighted, lambda v: v["l"]))
        return F.array_min(F.transform(labels, lambda x: F.struct((-votes(x)).alias("n"), x.alias("l"))))["l"]
