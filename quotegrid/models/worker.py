"""Stored models as arrays, for scoring many symbols' live rows in one pass.

Each Python worker reads the models of the symbols it meets from the shared
folder and keeps them, so neither the driver nor a broadcast holds all models.
"""

from __future__ import annotations

import json
from collections import OrderedDict
from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import Column
from pyspark.sql import functions as F

from quotegrid.operators.quantiles import from_normal_array

# All features are at least -1 where present, and volatilities and ratios at least 0.
MISSING = -2.0
# Models one worker keeps; others are read again when they are met.
KEEP = 512
ROWS_AT_ONCE = 1024


def _read(path: str):
    if ":" in path:
        fs, path = pafs.FileSystem.from_uri(path if "://" in path else path.replace("file:", "file://", 1))
    else:
        fs = pafs.LocalFileSystem()
    return pq.read_table(path, filesystem=fs)


class TreeArrays:
    """The trees of one stored model side by side in flat arrays."""

    def __init__(self, path: str):
        nodes = _read(f"{path}/nodes").to_pandas().sort_values(["tree", "id"], kind="stable")
        meta = _read(f"{path}/meta").to_pylist()[0]
        if not meta["features"]:
            raise ValueError(f"{path} has no feature list")
        sizes = nodes.groupby("tree").size().to_numpy()
        self.roots = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        shift = np.repeat(self.roots, sizes)
        inner = nodes["left"].to_numpy() >= 0
        self.left = np.where(inner, nodes["left"].to_numpy() + shift, -1)
        self.right = np.where(inner, nodes["right"].to_numpy() + shift, -1)
        self.feature = np.where(inner, nodes["feature"].to_numpy(), 0)
        self.threshold = nodes["threshold"].to_numpy(dtype=float)
        self.value = nodes["value"].to_numpy(dtype=float)
        self.weights = np.asarray(meta["weights"], dtype=float)
        self.features: list[str] = list(meta["features"])
        self.quantiles = np.asarray(meta["quantiles"], dtype=float)

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Volatility per row of feature values, in the order of ``features``."""
        x = np.where(np.isnan(x), MISSING, x)
        parts = [self._trees(x[k : k + ROWS_AT_ONCE]) for k in range(0, len(x), ROWS_AT_ONCE)]
        return from_normal_array(np.concatenate(parts), self.quantiles)

    def _trees(self, x: np.ndarray) -> np.ndarray:
        at = np.tile(self.roots, (len(x), 1))
        row = np.arange(len(x))[:, None]
        while (inner := self.left[at] >= 0).any():
            goes_left = x[row, self.feature[at]] <= self.threshold[at]
            at = np.where(inner, np.where(goes_left, self.left[at], self.right[at]), at)
        return self.value[at] @ self.weights


class ModelCache:
    """Models by path. A path published again is read anew; at most ``KEEP`` are kept, others are read when they are met.

    What cannot be read is not kept in any form: whichever worker asks, the answer depends on the store alone.
    """

    def __init__(self):
        self.models: OrderedDict[str, tuple[str, TreeArrays]] = OrderedDict()

    def get(self, path: str, version: str) -> TreeArrays | None:
        known = self.models.get(path)
        if known is None or known[0] != version:
            self.models.pop(path, None)
            try:
                self.models[path] = known = (version, TreeArrays(path))
            except Exception:
                return None
        self.models.move_to_end(path)
        while len(self.models) > KEEP:
            self.models.popitem(last=False)
        return known[1]

    def first(self, asked: str, names: Sequence[str]) -> TreeArrays | None:
        """The first model of a JSON list of ``path`` and ``version`` that can be read and knows no other features."""
        for m in json.loads(asked):
            found = self.get(m["path"], m["version"])
            if found is not None and set(found.features) <= set(names):
                return found
        return None


_CACHE = ModelCache()


def model_list(*models: tuple[Column, Column]) -> Column:
    """Models (path, version) to be tried one after the other."""
    return F.array(*[F.struct(p.alias("path"), v.cast("string").alias("version")) for p, v in models])


def predicted_volatility(models: Column, names: Sequence[str]) -> Column:
    """Prediction of the first readable one of ``models`` (structs of path and version); null without one."""
    names = list(names)

    @F.pandas_udf("double")
    def score(asked: pd.Series, x: pd.DataFrame) -> pd.Series:
        out = pd.Series(np.nan, index=asked.index, dtype=float)
        given = asked.notna()
        for one, rows in x[given].groupby(asked[given]):
            if model := _CACHE.first(one, names):
                out.loc[rows.index] = model.predict(rows[model.features].to_numpy(dtype=float))
        return out  # NaN leaves pandas as null

    return score(F.to_json(models), F.struct(*names))
