"""Connection table: labelled scan, merge per connection, quota sample, random order."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from ..operators.sampling import sample_stratified, shuffle_order
from ..operators.segments import IDENTITY, LABEL, merge_segments
from ..session import cut_lineage


def build_flow_dataset(segments: DataFrame, quotas: Mapping[str, int], cls: str = LABEL,
                       key: Sequence[str] = ("Flow ID",), source: str | None = None,
                       order: Sequence[str] = ("Timestamp",), identity: Sequence[str] = tuple(IDENTITY),
                       seed: int = 42) -> DataFrame:
    """Merge segments per (source, class, connection), take up to a quota per class, add a random position.

    The class is part of the merge key: it comes from the file, so all segments of a file share it. The
    merged table is written once, as the sample reads it several times.
    """
    keys = [*([source] if source else []), cls, *key]
    merged = cut_lineage(merge_segments(segments, keys, order, identity, label=None))
    sampled = sample_stratified(merged, keys, cls, quotas, seed)
    return shuffle_order(sampled, keys, seed)
