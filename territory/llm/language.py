"""Language identification: averaged hashed subword embeddings, linear softmax, calibrated rejection."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from territory.llm import subword
from territory.llm.blocks import text_batches

FEATURES = subword.Features(grams=(2, 3, 4), words=True, lower=True, bits=16)
#: Labelled rows that training takes at most (about).
SAMPLE_ROWS = 6000
#: Share of held-back rows that must be right among those not rejected.
PRECISION = 0.995
UNKNOWN = "und"

NEW = StructType().add("lang_pred", "string").add("score", "double").add("rejected", "boolean")


def fit(
    docs: DataFrame,
    known: Column,
    text_col: str = "text",
    lang_col: str = "lang",
    id_col: str = "doc_id",
    sample_rows: int = SAMPLE_ROWS,
    precision: float = PRECISION,
) -> subword.Model:
    """A model of the languages in the rows of ``docs`` where ``known`` holds.

    Learns from about ``sample_rows`` rows with a language and text, chosen by
    a hash of the id; classes are the languages among them.
    """
    rows = docs.filter(known)
    bags = subword.labelled_bags(rows, F.col(lang_col), F.col(id_col), text_col, FEATURES, sample_rows)
    model = subword.train(bags, FEATURES, sorted({b[0] for b in bags}))
    model.floor = subword.rejection_floor(model, precision)
    return model


def predict(docs: DataFrame, model: subword.Model, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` and ``rejected`` (which replace such columns).

    ``score`` is the calibrated probability of ``lang_pred``; ``rejected``
    says that it lies under the model's floor. A text that is null or has no
    letter is ``und`` with score 0 and rejected, and so is every text if the
    model has learned no language. One row for each row.
    """
    docs = docs.drop(*NEW.names)
    shared = text_batches(docs.sparkSession).sparkContext.broadcast(model)
    fields = docs.schema.fields

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            made: list[tuple] = []
            for text in batch.column(text_col):
                text = text.as_py()
                if not model.classes or not text or not any(map(str.isalpha, text)):
                    made.append((UNKNOWN, 0.0, True))
                else:
                    p = model.probabilities(text)
                    best = int(p.argmax())
                    made.append((model.classes[best], float(p[best]), bool(p[best] < model.floor)))
            frame = pd.DataFrame(made, columns=NEW.names)
            new = [pa.array(frame[n], t) for n, t in zip(NEW.names, (pa.string(), pa.float64(), pa.bool_()), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], [*(f.name for f in fields), *NEW.names])

    return docs.mapInArrow(run, StructType([*fields, *NEW.fields]))
