"""Language identification, routing and transcription with pluggable backends.

A backend is a factory: called once in a worker, it loads a model and returns a function from a list of sample arrays
to a list of predictions, as long as the input or shorter.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Backend = Callable[[], Callable[[list], Sequence]]

BATCH = 8
KEPT = ("es",)
DEFAULT = "en"


def _in_batches(samples: pd.Series, size: int, even: bool = False) -> Iterator[np.ndarray]:
    """Positions of at most `size` arrays at once: as they come, or (even) such of one length, the short ones first."""
    if not even:
        for i in range(0, len(samples), size):
            yield np.arange(i, min(i + size, len(samples)))
        return
    lengths = samples.map(len, na_action="ignore").fillna(-1).to_numpy(np.int64)
    order = np.argsort(lengths, kind="stable")
    for same in np.split(order, np.flatnonzero(np.diff(lengths[order])) + 1) if len(order) else ():
        for i in range(0, len(same), size):
            yield same[i : i + size]


def label_indexes(samples: Column, backend: Backend, batch: int = BATCH, even: bool = False) -> Column:
    """The backend's label index for each array; a batch that fails, and rows without a prediction, get index 0.

    even: the arrays that the backend gets at once have one length.
    """

    @F.pandas_udf("int")
    def identify(chunks: Iterator[pd.Series]) -> Iterator[pd.Series]:
        predict = backend()
        for chunk in chunks:
            out = np.zeros(len(chunk), np.int32)
            for at in _in_batches(chunk, batch, even):
                try:
                    found = [int(x) for x in predict(list(chunk.iloc[at]))]
                except Exception:  # noqa: BLE001  a batch that fails counts as label 0
                    found = []
                out[at] = (found + [0] * len(at))[: len(at)]
            yield pd.Series(out)

    return identify(samples)


def label_code(index: Column, labels: list[str], no_audio: Column, kept: Sequence[str] = KEPT, default: str = DEFAULT) -> Column:
    """Language code of an index: out of range, without sound, and all that isn't kept become the default."""
    code = F.coalesce(F.when(index >= 0, F.get(F.array(*map(F.lit, labels)), index)), F.lit(default))
    return collapse(F.when(F.coalesce(no_audio, F.lit(False)), F.lit(default)).otherwise(code), kept, default)


def collapse(code: Column, kept: Sequence[str] = KEPT, default: str = DEFAULT) -> Column:
    return F.when(code.isin(*kept), code).otherwise(F.lit(default))


def route(code: Column, all_english: bool = False, drop_others: bool = False) -> Column:
    """en, other, or corrupt: everything may be sent to en, or all else be marked corrupt."""
    if all_english:
        return F.lit("en")
    return F.when(code == "en", F.lit("en")).otherwise(F.lit("corrupt" if drop_others else "other"))


def normalised(prediction) -> str:
    """A prediction's text: the first of a list, the text of an object, a string as it is; empty for anything missing."""
    if isinstance(prediction, (list, tuple)):
        prediction = prediction[0] if prediction else ""
    if prediction is None:
        return ""
    found = prediction if isinstance(prediction, str) else getattr(prediction, "text", None)
    return "" if found is None else str(found)


def transcripts(samples: Column, backend: Backend, batch: int = BATCH) -> Column:
    """The backend's text for each array; the i-th prediction belongs to the i-th array, and missing ones are empty."""

    @F.pandas_udf("string")
    def transcribe(chunks: Iterator[pd.Series]) -> Iterator[pd.Series]:
        predict = backend()
        for chunk in chunks:
            out = np.full(len(chunk), "", object)
            for at in _in_batches(chunk, batch):
                found = [normalised(x) for x in predict(list(chunk.iloc[at]))]
                out[at] = (found + [""] * len(at))[: len(at)]
            yield pd.Series(out, dtype="object")

    return transcribe(samples)


def routed_transcripts(samples: Column, route: Column, backends: dict[str, Backend], batch: int = BATCH, even: bool = False) -> Column:
    """Like transcripts(), each array by the backend of its route; null where no backend is given for the route. even: as for label_indexes()."""

    @F.pandas_udf("string")
    def transcribe(chunks: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        loaded: dict[str, Callable[[list], Sequence]] = {}
        for arrays, routes in chunks:
            out = np.full(len(arrays), None, object)
            for name, backend in backends.items():
                own = (routes == name).to_numpy().nonzero()[0]
                if not len(own):
                    continue
                if name not in loaded:
                    loaded[name] = backend()
                for some in _in_batches(arrays.iloc[own], batch, even):
                    at = own[some]
                    found = [normalised(x) for x in loaded[name](list(arrays.iloc[at]))]
                    out[at] = (found + [""] * len(at))[: len(at)]
            yield pd.Series(out, dtype="object")

    return transcribe(samples, route)


def transcribe_routes(rows: DataFrame, backends: dict[str, Backend], samples: str = "samples", batch: int = BATCH, even: bool = False) -> DataFrame:
    """All rows with transcript from their route's backend (null: none is given for it), without their samples, in one pass."""
    return rows.withColumn("transcript", routed_transcripts(F.col(samples), F.col("route"), backends, batch, even)).drop(samples)
