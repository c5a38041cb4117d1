"""Fitted cleaning and encoding as pipeline stages that can be saved.

``fit_cleaning`` and ``fit_encoding`` learn on a table and return transformers
whose fitted values are parameters, so a ``PipelineModel`` of them (with an
assembler and a model, if wanted) is written and loaded like any other, and a
batch, a stream or another session applies the same fit to raw records.  All
of them are projections; only a label encoding joins its vocabulary.
"""

from __future__ import annotations

import json

from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame

from parcelkit.operators import clean as C
from parcelkit.operators import encode as E
from parcelkit.operators.roles import column_roles


class _Fitted(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """A transformer whose fitted values are one JSON parameter."""

    state = Param(Params._dummy(), "state", "fitted values as JSON", TypeConverters.toString)

    @keyword_only
    def __init__(self, state: str = "{}"):
        super().__init__()
        self._set(**self._input_kwargs)

    def fitted(self) -> dict:
        return json.loads(self.getOrDefault(self.state))


class FittedCleaning(_Fitted):
    """Impute, clean numbers, addresses and categories, clip: the steps of the clean chain after its dedup."""

    def _transform(self, df: DataFrame) -> DataFrame:
        s = self.fitted()
        d = C.ImputeModel(s["values"]).apply(df)
        d = C.clean_numeric(d, [c for c in s["numeric"] if c in d.columns], keep=s["keep"])
        d = C.clean_address(d, s["address"])
        d = C.standardize_categorical(d, [c for c in s["categorical"] if c in d.columns])
        return C.ClipModel({c: tuple(b) for c, b in s["bounds"].items() if c in d.columns}).apply(d)


def fit_cleaning(df: DataFrame, key: list[str], target: str, passthrough: list[str] | None = None) -> FittedCleaning:
    """Learn roles, fill values and clip bounds on ``df`` (rows as they are to be fitted on: deduplicated, or a split)."""
    keep = [*key, *(passthrough or [])]
    roles = column_roles(df.select(*[c for c in df.columns if c not in keep]))
    numeric = [c for c in roles["numerical"] if c != target] + ([target] if target in roles["numerical"] else [])
    values = C.fit_impute(df, roles).values
    state = {"values": values, "numeric": numeric, "keep": keep, "address": roles["address"],
             "categorical": roles["categorical"], "bounds": {}}
    cleaned = FittedCleaning(state=json.dumps(state)).transform(df)
    state["bounds"] = C.fit_outliers(cleaned, roles["numerical"], skip_integers=True).bounds
    return FittedCleaning(state=json.dumps(state))


class FittedEncoding(_Fitted):
    """Ordinal, one-hot and label encodings; the vocabularies of label columns are tables, named by their folders."""

    def encoders(self, spark) -> dict[str, E.Encoder]:
        return {c: E.Encoder(c, e["kind"], e["categories"], spark.read.parquet(e["vocab"]) if e["vocab"] else None)
                for c, e in self.fitted().items()}

    def _transform(self, df: DataFrame) -> DataFrame:
        return E.apply_encoders(df, self.encoders(df.sparkSession))


def fit_encoding(df: DataFrame, columns: list[str], folder: str, max_categories: int = 10) -> FittedEncoding:
    """Learn the encoders of ``columns``; label vocabularies are written below ``folder``, which the saved stage reads."""
    state = {}
    for i, (c, e) in enumerate(E.fit_encoders(df, columns, max_categories).items()):
        vocab = None
        if e.vocab is not None:
            vocab = f"{folder}/vocabulary-{i}"
            e.vocab.write.mode("overwrite").parquet(vocab)
        state[c] = {"kind": e.kind, "categories": e.categories, "vocab": vocab}
    return FittedEncoding(state=json.dumps(state))
