"""Own scorers and taggers, run on Arrow batches next to the built-in ones."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame

SCORES = "post_id string, compound double, positive double, negative double, neutral double, label string"
ENTITIES = "post_id string, entity_text string, entity_type string, mention_count long"


def custom_batches(
    texts: DataFrame, load: Callable[[], Callable[[pd.DataFrame], pd.DataFrame]], schema: str
) -> DataFrame:
    """Applies a loaded model to Arrow batches of ``texts``.

    ``load`` runs once per task and returns the function from a batch to rows of ``schema``
    (``SCORES`` or ``ENTITIES``).
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = load()
        for batch in batches:
            yield model(batch)

    return texts.mapInPandas(run, schema)
