"""Model-ready form: one-hot columns and scaled numbers."""

from __future__ import annotations

import logging

from pyspark.ml import Estimator, Model
from pyspark.sql import DataFrame

from tidyforge.functions.names import numeric_columns
from tidyforge.operators.encode import (ENCODINGS, OneHotEncoder, OneHotModel, SparseOneHotEncoder,
                                        SparseOneHotModel, VectorOneHotEncoder, VectorOneHotModel,
                                        encodable)
from tidyforge.operators.saved import Saved
from tidyforge.operators.scale import (METHODS, ScalerModel, _center_scale, fit_scaling,
                                       flag_stats)

log = logging.getLogger(__name__)

# Name prefixes never encoded and columns never scaled by default.
ENCODE_EXCLUSIONS = ("ID", "LNK_", "SITE")
SCALE_EXCLUSIONS = ("ID", "SEQNO")


class ModelFormatter(Saved, Estimator):
    """Encode text columns, then scale number columns.

    Key columns given in ``keys`` are neither encoded nor scaled.  Dummies are scaled
    only with ``scale_dummies``; their statistics follow from the category counts.
    ``encoding`` is "columns", one per category and refused beyond ``max_categories`` if
    that is given, or "sparse", one list of names for columns of any cardinality.
    """

    def _state(self) -> dict:
        return {"encode_categorical": self.encode_categorical,
                "exclude_encode_prefixes": self.exclude_encode_prefixes,
                "scale_method": self.scale_method,
                "exclude_scale_cols": sorted(self.protected), "default_scale_exclusions": [],
                "keys": self.keys, "scale_dummies": self.scale_dummies,
                "max_categories": self.max_categories, "encoding": self.encoding}

    def __init__(self, encode_categorical: bool = True,
                 exclude_encode_prefixes: tuple[str, ...] = ENCODE_EXCLUSIONS,
                 scale_method: str | None = "standard",
                 exclude_scale_cols: list[str] | None = None,
                 default_scale_exclusions: list[str] | None = None,
                 keys: list[str] = (), scale_dummies: bool = False,
                 max_categories: int | None = None, encoding: str = "columns"):
        super().__init__()
        if encoding not in ENCODINGS:
            raise ValueError(f"encoding must be one of {ENCODINGS}, not {encoding!r}")
        if encoding != "columns" and scale_dummies:
            raise ValueError(f"a {encoding} encoding has no dummy columns to scale")
        self.encoding = encoding
        self.encode_categorical = encode_categorical
        self.exclude_encode_prefixes = tuple(exclude_encode_prefixes)
        self.scale_method = scale_method
        defaults = SCALE_EXCLUSIONS if default_scale_exclusions is None else default_scale_exclusions
        self.protected = {*(exclude_scale_cols or []), *defaults, *keys}
        self.keys = list(keys)
        self.scale_dummies = scale_dummies
        self.max_categories = max_categories

    def _fit(self, dataset: DataFrame) -> "ModelFormatterModel":
        columns = (encodable(dataset, self.exclude_encode_prefixes, self.keys)
                   if self.encode_categorical else [])
        if self.encoding == "sparse" and columns:
            encoder = SparseOneHotEncoder(columns).fit(dataset)
        elif self.encoding == "vector" and columns:
            encoder = VectorOneHotEncoder(columns).fit(dataset)
        else:
            encoder = OneHotEncoder(columns, True, self.max_categories).fit(dataset)
        if not self.scale_method:
            return ModelFormatterModel(encoder, ScalerModel({}))
        if self.scale_method not in METHODS:
            log.warning("unknown scaling method %r, nothing scaled", self.scale_method)
            return ModelFormatterModel(encoder, ScalerModel({}))
        numbers = [c for c in numeric_columns(dataset) if c not in self.protected]
        parameters = fit_scaling(dataset, numbers, self.scale_method)
        if self.scale_dummies and encoder.dummies():
            rows = dataset.count()
            parameters |= {name: _center_scale(self.scale_method, flag_stats(ones, rows))
                           for _, _, name, ones in encoder.dummies() if name not in self.protected}
        return ModelFormatterModel(encoder, ScalerModel(parameters))


MODELS = {"columns": OneHotModel, "sparse": SparseOneHotModel, "vector": VectorOneHotModel}


class ModelFormatterModel(Saved, Model):
    """Fitted encoding and scaling."""

    def _state(self) -> dict:
        return {"encoding": next(k for k, v in MODELS.items() if type(self.encoder) is v),
                "encoder": self.encoder._state(), "scaler": self.scaler._state()}

    @classmethod
    def _restored(cls, state: dict) -> "ModelFormatterModel":
        return cls(MODELS[state["encoding"]](**state["encoder"]), ScalerModel(**state["scaler"]))

    def _tables(self) -> dict:
        return self.encoder._tables()

    @property
    def dictionary(self) -> DataFrame | None:
        """The table of a vector encoding."""
        return getattr(self.encoder, "dictionary", None)

    @dictionary.setter
    def dictionary(self, table: DataFrame) -> None:
        self.encoder.dictionary = table

    def __init__(self, encoder: OneHotModel | SparseOneHotModel | VectorOneHotModel, scaler: ScalerModel):
        super().__init__()
        self.encoder = encoder
        self.scaler = scaler

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return self.scaler.transform(self.encoder.transform(dataset))


def format_for_ml(df: DataFrame, encode_categorical: bool = True,
                  exclude_encode_prefixes: tuple[str, ...] = ENCODE_EXCLUSIONS,
                  scale_method: str | None = "standard",
                  exclude_scale_cols: list[str] | None = None,
                  default_scale_exclusions: list[str] | None = None, **more) -> DataFrame:
    """Learn and apply encoding and scaling on the same table."""
    formatter = ModelFormatter(encode_categorical, exclude_encode_prefixes, scale_method,
                               exclude_scale_cols, default_scale_exclusions, **more)
    return formatter.fit(df).transform(df)
