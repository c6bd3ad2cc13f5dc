"""Feature lookups, on-demand feature functions, feature specs, training sets and batch scoring.

A lookup is a left join of the spine with a keyed feature table (or an as-of join when a
timestamp lookup key is given). A spec is an ordered list of lookups and functions folded
over the spine; scoring replays the same spec, so training and scoring see the same columns.
Join strategy is left to Catalyst/AQE: broadcast only when the runtime size is under the
session threshold, sort-merge otherwise, with AQE splitting skewed spine partitions.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .asof import asof_join


def _as_list(x) -> list[str]:
    if x is None:
        return []
    return [x] if isinstance(x, str) else list(x)


@dataclass(frozen=True)
class FeatureLookup:
    """Join spec. ``lookup_key`` names spine columns; ``table_keys`` the table's primary key(s)
    (defaults to the same names). ``feature_names`` None means every non-key column. A key that the table holds twice
    doubles spine rows; with ``unique_keys`` it stops the job instead (an aggregation by key, which shares the join's exchange)."""
    table: DataFrame
    lookup_key: str | Sequence[str]
    table_keys: str | Sequence[str] | None = None
    feature_names: Sequence[str] | None = None
    timestamp_key: str | None = None
    timestamp_lookup_key: str | None = None
    rename: dict[str, str] | None = None
    unique_keys: bool = False

    def output_names(self) -> list[str]:
        names = self._features()
        ren = self.rename or {}
        return [ren.get(n, n) for n in names]

    def _features(self) -> list[str]:
        tkeys = _as_list(self.table_keys) or _as_list(self.lookup_key)
        if self.feature_names is not None:
            return list(self.feature_names)
        return [c for c in self.table.columns if c not in tkeys and c != self.timestamp_key]

    def apply(self, spine: DataFrame) -> DataFrame:
        skeys = _as_list(self.lookup_key)
        tkeys = _as_list(self.table_keys) or skeys
        feats = self._features()
        ren = self.rename or {}
        if self.timestamp_lookup_key is not None:
            if self.timestamp_key is None:
                raise ValueError("timestamp_lookup_key needs the table's timestamp_key")
            table = self.table.select(*tkeys, self.timestamp_key,
                                      *[F.col(c).alias(ren.get(c, c)) for c in feats])
            return asof_join(spine, table, skeys, tkeys, self.timestamp_lookup_key,
                             self.timestamp_key, [ren.get(c, c) for c in feats])
        table = self.table.select(*[F.col(t).alias(s) for t, s in zip(tkeys, skeys)],
                                  *[F.col(c).alias(ren.get(c, c)) for c in feats])
        if self.unique_keys:
            held = table.groupBy(*skeys).agg(F.count(F.lit(1)).alias("__dw_n"), F.first(F.struct(*self.output_names())).alias("__dw_f"))
            key = F.concat_ws("|", *[F.col(k).cast("string") for k in skeys])
            twice = F.raise_error(F.concat(F.lit("feature table holds twice the key "), key)).cast(held.schema["__dw_f"].dataType)
            held = held.withColumn("__dw_f", F.when(F.col("__dw_n") > 1, twice).otherwise(F.col("__dw_f")))
            table = held.select(*skeys, "__dw_f.*")
        clash = set(self.output_names()) & set(spine.columns)
        if clash:
            raise ValueError(f"lookup would duplicate spine columns {sorted(clash)}")
        return spine.join(table, on=skeys, how="left")


@dataclass(frozen=True)
class FeatureFunction:
    """Computed column over looked-up and request columns; ``fn`` builds a native Column."""
    fn: Callable[..., Column]
    output_name: str
    input_bindings: dict[str, str]

    def apply(self, df: DataFrame) -> DataFrame:
        args = {p: F.col(c) for p, c in self.input_bindings.items()}
        return df.withColumn(self.output_name, self.fn(**args))


@dataclass
class FeatureSpec:
    """Ordered lookups and functions plus excluded columns; replayable at scoring time."""
    steps: list[FeatureLookup | FeatureFunction] = field(default_factory=list)
    exclude_columns: list[str] = field(default_factory=list)

    def apply(self, spine: DataFrame) -> DataFrame:
        df = spine
        for step in self.steps:
            df = step.apply(df)
        excl = [c for c in _as_list(self.exclude_columns) if c in df.columns]
        return df.drop(*excl) if excl else df


def create_training_set(spine: DataFrame, feature_lookups: Sequence[FeatureLookup | FeatureFunction],
                        label: str | None = None,
                        exclude_columns: str | Sequence[str] | None = None) -> tuple[DataFrame, FeatureSpec]:
    """Lazily joined training frame and the spec that produced it (label kept last)."""
    spec = FeatureSpec(list(feature_lookups), _as_list(exclude_columns))
    df = spec.apply(spine)
    if label is not None:
        if label not in df.columns:
            raise ValueError(f"label {label} not in spine")
        df = df.select(*[c for c in df.columns if c != label], label)
    return df, spec


def score_batch(model, spec: FeatureSpec, df: DataFrame, prediction_col: str = "prediction") -> DataFrame:
    """Replay the spec on a key-only frame, then append the model's prediction column.

    ``model`` is anything with ``score(df, output) -> DataFrame`` (our linear models) or an
    MLlib ``Transformer``.
    """
    enriched = spec.apply(df)
    if hasattr(model, "score"):
        return model.score(enriched, prediction_col)
    scored = model.transform(enriched)
    return scored if prediction_col == "prediction" else scored.withColumnRenamed("prediction", prediction_col)
