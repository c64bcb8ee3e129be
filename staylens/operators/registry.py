"""Fitted models by version of their input (ML-7).

A model is a snapshot table under the registry's folder, named by a hash of input,
input version, parameters and code version; its manifest holds labels and
metrics. A fit commits once: if two sessions fit the same, the second one's
commit conflicts and it loads the first one's. Models are found again by any
session that shares the folder. The index of all models is one more snapshot table.
"""

from __future__ import annotations

import hashlib
import json
import threading
from collections.abc import Callable
from dataclasses import asdict

from pyspark.sql import DataFrame, SparkSession

from staylens.operators import model as ml
from staylens.operators.features import FEATURE_COLS
from staylens.session import ensure_checkpoint_dir
from staylens.sources import snapshots
from staylens.sources.tables import session_key

#: Raise it when the same input and parameters give other trees.
CODE_VERSION = 3
ENTRIES = ("model string, input string, input_version string, params string, path string, trees int, depth int, features int, room_types int, "
           "boroughs int, n_test long, rmse double, mae double, r2 double")

_loaded: dict[tuple, ml.TrainedModel] = {}
_lock = threading.RLock()


def root(spark: SparkSession) -> str:
    """The registry's folder: under the folder the cluster names, so that it outlives a session."""
    return f"{(spark.conf.get('spark.checkpoint.dir', None) or ensure_checkpoint_dir(spark)).rstrip('/')}/model-registry"


def _path(base: str, key: str) -> str:
    return f"{base}/models/{key}"


def model(base: str, input_id: str, input_version: str, params: ml.GBTParams, train: Callable[[], ml.TrainedModel]) -> ml.TrainedModel:
    """The committed model of this input, version and parameters; trained and committed if there is none."""
    spark = SparkSession.getActiveSession()
    settings = json.dumps(asdict(params), sort_keys=True)
    key = hashlib.sha256(json.dumps([input_id, input_version, settings, CODE_VERSION]).encode()).hexdigest()[:32]
    with _lock:  # one fit at a time in this process
        held = (*session_key(spark), base, key)
        if held not in _loaded:
            if snapshots.current(spark, _path(base, key)) is None:
                fitted = train()
                try:
                    ml.save_model(fitted, _path(base, key), {"input": input_id, "input_version": input_version, "params": settings})
                    _register(spark, base, key, input_id, input_version, settings, fitted)
                except snapshots.CommitConflict:
                    pass  # another session was first: its model is loaded
            _loaded[held] = ml.load_model(_path(base, key))
        return _loaded[held]


def _register(spark: SparkSession, base: str, key: str, input_id: str, input_version: str, settings: str, tm: ml.TrainedModel) -> None:
    m, trees = tm.metrics, tm.model.trees
    row = (key, input_id, input_version, settings, _path(base, key), len(trees.value), trees.depth, len(FEATURE_COLS), len(tm.room_types),
           len(tm.boroughs), m["n_test"], m["rmse"], m["mae"], m["r2"])
    entry = spark.createDataFrame([row], ENTRIES).coalesce(1)
    while True:
        try:
            snapshots.write(entry, f"{base}/index", append=True)
            return
        except snapshots.CommitConflict:  # another model was registered meanwhile
            continue


def entries(spark: SparkSession, base: str) -> DataFrame:
    """One row for every registered model."""
    if snapshots.current(spark, f"{base}/index") is None:
        return spark.createDataFrame([], ENTRIES)
    return snapshots.read(spark, f"{base}/index")
