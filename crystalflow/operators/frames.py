"""Trajectory frames: numbering, running step counts, filters, corrections."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from crystalflow import schema as S
from crystalflow.operators import segments as seg
from crystalflow.operators.skew import join_per_key


def _key(names: Sequence[str | Column]) -> Column:
    """One comparable value: a lone column stays plain, which aggregates faster."""
    columns = [F.col(n) if isinstance(n, str) else n for n in names]
    if len(columns) == 1:
        return columns[0]
    return F.struct(*[c.alias(f"o{i}") for i, c in enumerate(columns)])


def number_frames(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    name: str = "relaxation_step",
    valid: Column | None = None,
    segments: int | None = None,
) -> DataFrame:
    """Number the frames of a trajectory from 0; invalid frames go first."""
    kept = df if valid is None else df.where(valid)
    return seg.position(kept, keys, order, name, segments)


def cumulative_steps(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    steps: str = "nsteps",
    name: str = "output_step",
    segments: int | None = None,
) -> DataFrame:
    """Steps taken up to and including each calculation."""
    return seg.running_sum(df, keys, order, {name: F.col(steps).cast("bigint")}, segments)


def last_value(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    value: str,
    name: str,
    bounded: bool = False,
) -> DataFrame:
    """Add the value of the group's last row to all its rows."""
    if bounded:
        return df.withColumn(name, F.max_by(value, _key(order)).over(Window.partitionBy(*keys)))
    last = df.groupBy(*keys).agg(F.max_by(value, _key(order)).alias(name))
    return join_per_key(df, last, keys)


def convergence_filter(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    energy: str = "energy",
    nsites: str = "nsites",
    forces: str | None = "forces",
    max_above_last: float | None = S.MAX_FRAME_ENERGY_ABOVE_LAST,
    keep_final: bool = False,
    bounded: bool = False,
) -> DataFrame:
    """Frames at most ``max_above_last`` eV/atom above the trajectory's last one.

    Frames without energy or forces are ignored altogether. The last frame
    itself is the yardstick and, unless ``keep_final``, not part of the result.

    The last frame is found by a partial aggregate and joined back. ``bounded``
    says that a trajectory fits a task (it came from one document); a window
    then saves the join.
    """
    usable = F.col(energy).isNotNull()
    if forces is not None:
        usable = usable & F.col(forces).isNotNull()
    frames = df.where(usable)
    key = _key(order)
    per_site = F.col(energy) / F.col(nsites)
    last_of = {"_last_energy": F.max_by(per_site, key), "_last_key": F.max(key)}
    if bounded:
        whole = Window.partitionBy(*keys)
        joined = frames.withColumns({name: agg.over(whole) for name, agg in last_of.items()})
    else:
        last = frames.groupBy(*keys).agg(*[agg.alias(name) for name, agg in last_of.items()])
        joined = join_per_key(frames, last, keys)
    kept = F.lit(True) if keep_final else key < F.col("_last_key")
    if max_above_last is not None:
        kept = kept & (per_site - F.col("_last_energy") <= max_above_last)
    return joined.where(kept).drop("_last_energy", "_last_key")


def close_to_primary(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    number: str = "trajectory_number",
    energy: str = "energy",
    nsites: str = "nsites",
    tolerance: float = S.PRIMARY_ENERGY_TOLERANCE,
) -> DataFrame:
    """Keep trajectory 0 of a group, and those that end at about its energy.

    A trajectory ending more than ``tolerance`` eV/atom away, or compared with
    a missing or energy-less end, is dropped.
    """
    ends = df.groupBy(*keys, number).agg(
        F.max_by(F.col(energy) / F.col(nsites), _key(order)).alias("_end")
    )
    # picked by an aggregate, not a filter, so both uses of ``ends`` are one plan
    is_primary = F.col(number) == 0
    primary = ends.groupBy(*keys).agg(F.max(F.when(is_primary, F.col("_end"))).alias("_primary"))
    close = (
        ends.join(primary, list(keys))
        .where(is_primary | (F.abs(F.col("_end") - F.col("_primary")) <= tolerance))
        .select(*keys, number)
    )
    return join_per_key(df, close, [*keys, number], "left_semi")


def carry_correction(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    energy: str = "energy",
    corrected: str = "energy_corrected",
    takes_part: Column | None = None,
    segments: int | None = None,
) -> DataFrame:
    """Reuse a trajectory's first known energy correction for later frames.

    ``corrected`` holds what each frame would get on its own. A frame without
    energy has no corrected energy and makes the next frame start afresh.
    Frames outside ``takes_part`` neither supply nor use the carried value.
    """
    active = F.lit(True) if takes_part is None else takes_part
    own = F.when(active, F.col(corrected) - F.col(energy))
    reset = active & F.col(energy).isNull()
    carried = seg.carried_first(df, keys, order, own, reset, "_carried", segments)
    value = F.when(active, F.coalesce(F.col(energy) + F.col("_carried"), F.col(corrected))).otherwise(
        F.col(corrected)
    )
    return carried.withColumn(corrected, F.when(F.col(energy).isNotNull(), value)).drop("_carried")


def input_and_output_frames(
    df: DataFrame,
    is_first: Column,
    input_frame: Column,
    output_frame: Column,
    name: str = "frame",
) -> DataFrame:
    """The output frame of every calculation, and the input frame of the first."""
    both = F.array(F.when(is_first, input_frame), output_frame)
    return df.withColumn(name, F.explode(F.array_compact(both)))


def explode_relaxations(
    df: DataFrame, relaxations: Column, steps: str, payload: Sequence[str] = ()
) -> DataFrame:
    """Flatten calculations x steps, keeping both positions.

    Gives ``relaxation_number`` (calculation) and ``step_pos`` (step within it)
    next to the ``calc`` and ``step`` structs.
    """
    calcs = df.select("*", F.posexplode(relaxations).alias("relaxation_number", "calc"))
    return calcs.select("*", F.posexplode(F.col(f"calc.{steps}")).alias("step_pos", "step")).drop(*payload)
