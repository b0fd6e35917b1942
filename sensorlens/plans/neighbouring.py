"""Queries of the nearest-neighbour operators, with brute force in SQL as twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from sensorlens.functions.frames import materialise
from sensorlens.operators import model, neighbours, prep, split
from sensorlens.plans.catalog import query
from sensorlens.plans.modelling import TEST, _predictions_of
from sensorlens.plans.tables import FEATURES, XY_SQL, joined_xy

_SCALED = ", ".join(f"(x.{c} - s.lo_{c}) / (s.hi_{c} - s.lo_{c}) as {c}" for c in FEATURES)
_RANGES = ", ".join(f"min({c})::double as lo_{c}, max({c})::double as hi_{c}" for c in FEATURES)
_AWAY = " + ".join(f"(q.{c} - r.{c}) * (q.{c} - r.{c})" for c in FEATURES)


def _pairs_sql(label: str, k: int, order: str) -> str:
    """The k nearest training rows of every test row, all pairs measured."""
    return f"""with xy as materialized (select *, {TEST} as held from {XY_SQL}),
 s as (select {_RANGES} from xy where not held),
 z as materialized (select x.id, x.{label}, x.held, {_SCALED} from xy x, s),
 near as materialized (select * from (select q.id as query_id, r.id as id, r.{label} as label, sqrt({_AWAY}) as distance,
   row_number() over (partition by q.id order by sqrt({_AWAY}), {order}) as rank from z q, z r where q.held and not r.held) where rank <= {k})"""


@query("b59_nearest_rows", _pairs_sql("faulty", 3, "r.id") + " select query_id, rank::int as rank, id, round(distance, 9) as distance from near")
def b59_rows(spark, sf_dir):
    train, test = split.split_holdout(materialise(joined_xy(spark, sf_dir)), None, split.BY_THRESHOLD)
    scaled = [prep.scale_columns(part, FEATURES, "minmax", train) for part in (test, train)]
    found = neighbours.nearest_rows(*scaled, FEATURES, 3)
    return found.withColumn("distance", F.round("distance", 9))


_VOTES = """ , near0 as (select *, min(distance) over (partition by query_id) as closest from near),
 votes as (select query_id, label, sum(case when closest > 0 then 1 / distance when distance = 0 then 1 else 0 end) as w from near0 group by 1, 2),
 best as (select query_id, label, row_number() over (partition by query_id order by round(w, 6) desc, label) as place from votes)
 select query_id as id, faulty, label::double as prediction from best join z on query_id = z.id where place = 1"""


@query("b59_knn_classifier", _pairs_sql("faulty", 11, "r.faulty") + _VOTES)
def b59_classes(spark, sf_dir):
    params = {"n_neighbors": 11, "weights": "distance"}
    return _predictions_of(spark, sf_dir, "knn_classifier", params, model.CLASSIFIERS, "faulty", "minmax")


@query("b59_knn_regressor", _pairs_sql("margin", 3, "r.margin") + """
 select query_id as id, z.margin, round(avg(label), 2) as prediction from near join z on query_id = z.id group by 1, 2""")
def b59_values(spark, sf_dir):
    params = {"n_neighbors": 3, "weights": "uniform"}
    scored = _predictions_of(spark, sf_dir, "knn_regressor", params, model.REGRESSORS, "margin", "minmax")
    return scored.withColumn("prediction", F.round("prediction", 2))
