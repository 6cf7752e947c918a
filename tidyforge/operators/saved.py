"""Saving and loading of stages and fitted models, alone or inside a Spark ML pipeline."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

from pyspark.ml.util import (DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader,
                             MLWritable, MLWriter)


def _plain(value):
    """A learned or given value in JSON; tagged where JSON has no such type."""
    if value is None or isinstance(value, (bool, int, float, str)):
        return value
    if isinstance(value, datetime):
        return {"datetime": value.isoformat()}
    if isinstance(value, date):
        return {"date": value.isoformat()}
    if isinstance(value, Decimal):
        return {"decimal": str(value)}
    if isinstance(value, (bytes, bytearray)):
        return {"bytes": bytes(value).hex()}
    if isinstance(value, (list, tuple, set, frozenset)):
        return [_plain(v) for v in value]
    if isinstance(value, dict):                  # keys may be of any of these types
        return {"pairs": [[_plain(k), _plain(v)] for k, v in value.items()]}
    raise ValueError(f"a stage with {value!r} cannot be saved; functions have to be given anew")


_TAGS = {"datetime": datetime.fromisoformat, "date": date.fromisoformat, "decimal": Decimal,
         "bytes": bytes.fromhex,
         "pairs": lambda pairs: {_value(k): _value(v) for k, v in pairs}}


def _value(plain):
    if isinstance(plain, list):
        return [_value(v) for v in plain]
    if isinstance(plain, dict):
        (tag, inner), = plain.items()
        return _TAGS[tag](inner)
    return plain


class _Writer(MLWriter):
    def __init__(self, instance):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        state = {"state": _plain(self.instance._state())}
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession, state)
        for name, table in self.instance._tables().items():
            table.write.parquet(f"{path.rstrip('/')}/{name}")


class _Reader(MLReader):
    def __init__(self, kind):
        super().__init__()
        self.kind = kind

    def load(self, path: str):
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        found = self.kind._restored(_value(metadata["state"]))
        for name in found._tables():
            setattr(found, name, self.sparkSession.read.parquet(f"{path.rstrip('/')}/{name}"))
        return found


class Saved(MLReadable, MLWritable):
    """``save(path)`` and ``load(path)`` for a class that tells its state.

    ``_state`` returns a dict of plain values, ``_restored`` makes an instance from it; by
    default the dict holds the arguments of the constructor.  ``_tables`` names attributes that
    hold frames; they are written beside it.
    """

    def _tables(self) -> dict:
        return {}

    def _state(self) -> dict:
        return {name: getattr(self, name) for name in self.STATE}

    @classmethod
    def _restored(cls, state: dict):
        return cls(**state)

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader(cls)
