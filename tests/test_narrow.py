"""only what a query gives is written and joined by its segments."""

from __future__ import annotations

import pytest

from crystalflow.operators import segments as seg
from crystalflow.queries import Tables, framing, selecting

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize(
    "query, unused",
    [
        (selecting.rank_tasks, {"energy", "calc_type", "l_partkey", "_order_0"}),
        (framing.cumulative_steps, {"label", "input_id", "output_id", "discount", "energy_pa"}),
    ],
)
def test_unused_columns_are_not_written(spark, monkeypatch, query, unused):
    written = []
    kept = seg.materialise
    monkeypatch.setattr(seg, "ROWS_PER_SEGMENT", 500)
    monkeypatch.setattr(seg, "materialise", lambda df: written.append(set(df.columns)) or kept(df))
    query(Tables(spark, SMALL))
    assert written and not unused & set().union(*written)
