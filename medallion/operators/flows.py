"""Fan-in of several flows into one target."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


def append_flows(*flows: DataFrame) -> DataFrame:
    """UNION ALL by column name; duplicates across flows are kept.

    All flows must have the same columns. For streams this yields one query with
    one checkpoint, which is what keeps a back-fill from being read twice. A flow
    added later needs a new target and checkpoint, as the old checkpoint knows
    its sources by position.
    """
    if not flows:
        raise ValueError("append_flows needs at least one flow")
    expected = set(flows[0].columns)
    for i, flow in enumerate(flows[1:], start=2):
        if set(flow.columns) != expected:
            odd = sorted(expected.symmetric_difference(flow.columns))
            raise ValueError(f"flow {i} differs from the first in columns {odd}")
    return reduce(DataFrame.unionByName, flows)
