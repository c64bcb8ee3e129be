"""Price model (ML-2 .. ML-12) on second-order boosted trees (``boosting``).

* ML-2 label encoding: codes are alphabetical like the source's encoder
  (``StringIndexer(stringOrderType="alphabetAsc")``). A request with a label the
  model has not seen is returned unscored, it does not fail the other requests.
* ML-3 split: hash of the listing id (partition independent, stable on retry).
* ML-4 boosted trees: depth, rate, L2 term, minimum child weight, row sample and
  columns a tree as in the source, 500 trees; cut values are the features'
  quantiles, so any number of areas can be learned.
* ML-7 artifacts: trees, labels and metrics as a snapshot table (``registry``).
* ML-9 attribution: exact Shapley values against background rows drawn by hash from
  the training set, from the trees' leaf paths; impacts add up to prediction minus
  the mean background prediction.

Everything scores whole request tables a column batch at a time; nothing loops
over rows on the driver. The only driver-side values are model-sized: trees,
label lists, metrics, and a fixed number of background rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline
from pyspark.ml.feature import StringIndexer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from staylens.functions.values import NIGHTS_PER_MONTH, PRICE_FLOOR
from staylens.operators import boosting
from staylens.operators.features import BOOL_FEATURES, FEATURE_COLS
from staylens.operators.joins import lookup_with_default, per_label_rows
from staylens.operators.sampling import hash_key, train_test_split
from staylens.sources import snapshots
from staylens.operators.windows import rank_within, top_n

#: PRJ-6: what a request that leaves a feature open is priced with.
REQUEST_DEFAULTS = {"accommodates": 2.0, "bedrooms": 1.0, "bathrooms": 1.0, "beds": 1.0, "amenity_count": 0.0}


GBTParams = boosting.BoostParams


def encoders(handle_invalid: str = "error") -> list[StringIndexer]:
    return [
        StringIndexer(inputCol="room_type", outputCol="room_type_enc", stringOrderType="alphabetAsc",
                      handleInvalid=handle_invalid),
        StringIndexer(inputCol="neighbourhood", outputCol="neighbourhood_enc", stringOrderType="alphabetAsc",
                      handleInvalid=handle_invalid),
    ]


@dataclass
class PriceModel:
    """Label lists and trees: what turns feature rows into prices."""

    room_types: list[str]
    boroughs: list[str]
    trees: boosting.BoostedTrees

    def encode(self, df: DataFrame) -> DataFrame:
        """Codes of room type and neighbourhood (null for labels that were not learned)."""
        out = df
        for column, labels in (("room_type", self.room_types), ("neighbourhood", self.boroughs)):
            codes = F.create_map(*[F.lit(x) for i, label in enumerate(labels) for x in (label, float(i))]) if labels else None
            out = out.withColumn(f"{column}_enc", F.try_element_at(codes, F.col(column)) if labels else F.lit(None).cast("double"))
        return out

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with its codes and ``prediction``."""
        return boosting.transform(self.trees, self.encode(df), FEATURE_COLS)


def fit_price_model(train: DataFrame, params: GBTParams, labels_of: DataFrame | None = None) -> PriceModel:
    """Labels of ``labels_of`` (by default of the training rows), then trees on the training rows."""
    prep = Pipeline(stages=encoders()).fit(train if labels_of is None else labels_of)
    room_types, boroughs = (list(s.labelsArray[0]) for s in prep.stages)
    model = PriceModel(room_types, boroughs, boosting.BoostedTrees.of_rows([(-1, [0], [0.0], [0.0])]))
    model.trees = boosting.fit(model.encode(train), FEATURE_COLS, "price", "listing_id", params)
    return model


def regression_metrics(pred: DataFrame, label: str = "price", prediction: str = "prediction") -> DataFrame:
    """ML-6: RMSE, MAE, R2 and n in one aggregation."""
    err = F.col(prediction) - F.col(label)
    one = pred.agg(
        F.count(F.lit(1)).cast("long").alias("n_test"),
        F.sqrt(F.avg(err * err)).alias("rmse"),
        F.avg(F.abs(err)).alias("mae"),
        F.sum(err * err).alias("__sse"),
        (F.var_pop(label) * F.count(F.lit(1))).alias("__sst"),
    )
    return one.withColumn("r2", 1 - F.try_divide(F.col("__sse"), F.col("__sst"))).drop("__sse", "__sst")


@dataclass
class TrainedModel:
    model: PriceModel
    metrics: dict

    @property
    def room_types(self) -> list[str]:
        return self.model.room_types

    @property
    def boroughs(self) -> list[str]:
        return self.model.boroughs

    @property
    def mae(self) -> float:
        return float(self.metrics["mae"])


def train_price_model(features: DataFrame, params: GBTParams | None = None, test_pct: int = 20) -> TrainedModel:
    """ML-3 + ML-4 + ML-6: hash split, fit, evaluate on the hold-out."""
    params = params or GBTParams()
    train, test = train_test_split(features, "listing_id", test_pct)
    model = fit_price_model(train, params, labels_of=features)  # encoders know the labels of all rows, as in the source
    return TrainedModel(model, regression_metrics(model.transform(test)).first().asDict())


def save_model(tm: TrainedModel, path: str, meta: dict | None = None) -> snapshots.Snapshot:
    """ML-7: the trees as a committed table, labels and metrics in its manifest."""
    trees = SparkSession.getActiveSession().createDataFrame(tm.model.trees.rows(), boosting.TREES).coalesce(1)
    return snapshots.write(trees, path, meta={**(meta or {}), "metrics": tm.metrics, "room_types": tm.room_types, "boroughs": tm.boroughs})


def load_model(path: str) -> TrainedModel:
    """The newest committed model at ``path``."""
    spark = SparkSession.getActiveSession()
    found = snapshots.current(spark, path)
    if found is None:
        raise FileNotFoundError(f"no model at {path}")
    trees = boosting.BoostedTrees.of_rows(snapshots.read(spark, path, found).collect())
    return TrainedModel(PriceModel(found.meta["room_types"], found.meta["boroughs"], trees), found.meta["metrics"])


def request_features(requests: DataFrame, borough_col: str = "borough") -> DataFrame:
    """Model input columns from a request table (PRJ-6 defaults, booleans as 0/1)."""
    out = requests.withColumn("neighbourhood", F.col(borough_col))
    out = out.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(v)) for c, v in REQUEST_DEFAULTS.items()})
    return out.withColumns({b: F.coalesce(F.col(b).cast("int"), F.lit(0)) for b in BOOL_FEATURES})


def known_labels(tm: TrainedModel, requests: DataFrame, borough: bool = True) -> Column:
    """Whether the model has seen a request's room type (and borough)."""
    seen = F.col("room_type").isin(tm.room_types)
    return F.coalesce(seen & F.col("borough").isin(tm.boroughs) if borough else seen, F.lit(False))


def price_band(pred: DataFrame, mae: Column | float) -> DataFrame:
    """ML-8 arithmetic: a +-MAE band around ``prediction``, the lower end floored at 10."""
    mae = mae if isinstance(mae, Column) else F.lit(mae)
    return pred.select(
        "request_id", "borough", "room_type", F.col("prediction").alias("predicted_price"),
        F.greatest(F.lit(float(PRICE_FLOOR)), F.col("prediction") - mae).alias("price_low"),
        (F.col("prediction") + mae).alias("price_high"),
    )


def _dealt(requests: DataFrame) -> DataFrame:
    """Requests dealt over all cores: scoring one costs far more than moving it."""
    spark = requests.sparkSession
    n = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return requests.repartition(n, "request_id")


def estimate(tm: TrainedModel, requests: DataFrame) -> DataFrame:
    """ML-8: prediction with its band; requests with an unseen label come back unscored (nulls)."""
    known = known_labels(tm, requests)
    scored = price_band(tm.model.transform(request_features(_dealt(requests.where(known)))), tm.mae)
    null = F.lit(None).cast("double")
    rest = requests.where(~known).select("request_id", "borough", "room_type", null.alias("predicted_price"), null.alias("price_low"), null.alias("price_high"))
    return scored.unionByName(rest)


def borough_comparison(tm: TrainedModel, requests: DataFrame, occupancy: DataFrame, default_occ: float = 0.45) -> DataFrame:
    """ML-12 (JOIN-6 -> ML-8 -> JOIN-7 -> WIN-4): the configuration scored in every
    borough the model knows, x that borough's occupancy x 30, ranked per request.
    Requests with a room type the model has not seen can't be scored and are left out."""
    expanded = per_label_rows(_dealt(requests.where(known_labels(tm, requests, borough=False))).withColumnRenamed("borough", "selected_borough"), tm.boroughs, "borough")
    return rank_boroughs(tm.model.transform(request_features(expanded)), occupancy, default_occ)


def rank_boroughs(scored: DataFrame, occupancy: DataFrame, default_occ: float = 0.45) -> DataFrame:
    """ML-12 arithmetic on (request_id, selected_borough, borough, prediction): the
    borough's occupancy, else the selected borough's, else the default (JOIN-7);
    revenue of a month; rank per request (WIN-4)."""
    selected = occupancy.select(F.col("borough").alias("selected_borough"), F.col("occupancy_rate").alias("__selected"))
    scored = scored.join(selected, "selected_borough", "left")
    scored = lookup_with_default(scored, occupancy, "borough", "occupancy_rate", F.col("__selected"), default_occ)
    occ_b = F.col("occupancy_rate")
    out = scored.select(
        "request_id", "borough", F.col("prediction").alias("predicted_price"), occ_b.alias("occupancy"),
        (F.col("prediction") * NIGHTS_PER_MONTH * occ_b).alias("monthly_revenue"),
        (F.col("borough") == F.col("selected_borough")).alias("selected"),
    )
    return rank_within(out, ["request_id"], [F.col("monthly_revenue").desc(), F.col("borough")])


def background_rows(encoded: DataFrame, n: int, seed: int = 7) -> list[list[float]]:
    """``n`` training rows chosen by hash (a bounded, model-sized reference sample); fewer rows repeat."""
    array = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in FEATURE_COLS])
    rows = encoded.orderBy(hash_key("listing_id", seed), "listing_id").limit(n).select(array.alias("a")).collect()
    if not rows:
        raise ValueError("no background rows")
    return [list(rows[i % len(rows)].a) for i in range(n)]


def attribution(tm: TrainedModel, requests: DataFrame, train_features: DataFrame, n_perm: int = 32,
                top_k: int = 12, seed: int = 11) -> DataFrame:
    """ML-9 + WIN-6: per-request feature impacts against ``n_perm`` background rows, top ``k`` by |impact|.

    For each background row the impacts are the exact Shapley values, summed leaf by
    leaf over the trees' paths; ``std_error`` is that of their mean over the
    background rows. A request is one row throughout, in the task that reads it.
    """
    background = background_rows(tm.model.encode(train_features), n_perm, seed)
    known = tm.model.encode(request_features(_dealt(requests.where(known_labels(tm, requests)))))
    return top_impacts(boosting.attribute(tm.model.trees, known, "request_id", FEATURE_COLS, background), top_k)


def top_impacts(impacts: DataFrame, k: int = 12) -> DataFrame:
    """WIN-6: the ``k`` largest impacts by size per request (ties by feature), with their direction."""
    top = top_n(impacts, ["request_id"], [F.abs(F.col("impact")).desc(), F.col("feature")], k)
    return top.withColumn("direction", F.when(F.col("impact") >= 0, F.lit("up")).otherwise(F.lit("down")))


def attribution_totals(tm: TrainedModel, requests: DataFrame, train_features: DataFrame, n_perm: int = 32,
                       seed: int = 11) -> DataFrame:
    """Additivity check: sum of all impacts vs prediction - mean background prediction."""
    import numpy as np

    full = attribution(tm, requests, train_features, n_perm, top_k=len(FEATURE_COLS), seed=seed)
    s = full.groupBy("request_id").agg(F.sum("impact").alias("impact_sum"))
    pred = tm.model.transform(request_features(requests)).select("request_id", "prediction")
    mean = float(tm.model.trees.predict(np.array(background_rows(tm.model.encode(train_features), n_perm, seed))).mean())
    return s.join(pred, "request_id").withColumn("expected", F.col("prediction") - F.lit(mean))
