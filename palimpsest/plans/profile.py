"""How many rows pass each step of a chain, measured in the run itself.

Each step's result is observed while the one action at the end of the chain runs; no step is counted
on its own, cached or run twice.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from palimpsest.operators.normalise import active_versions, explode_versions
from palimpsest.operators.ordered import order_rows

Step = tuple[str, Callable[[DataFrame], DataFrame]]
ROWS, PROFILE = "rows", "step string, place int, rows long, null_keys long"


def observed(source: DataFrame, steps: Sequence[Step], key: str) -> tuple[DataFrame, list[tuple[str, Observation]]]:
    """The chain's result, and an observation of each step that is filled by the first action on it.
    A name stands once."""
    if len({name for name, _ in steps}) < len(steps):
        raise ValueError("steps need names of their own")
    seen, frame = [], source
    for name, step in steps:
        watch = Observation(name)
        frame = step(frame).observe(watch, F.count(F.lit(1)).alias(ROWS), F.count_if(F.col(key).isNull()).alias("null_keys"))
        seen.append((name, watch))
    return frame, seen


def profile(source: DataFrame, steps: Sequence[Step], key: str, write: Callable[[DataFrame], None] | None = None) -> DataFrame:
    """Run the chain once, into ``write`` or nowhere, and give one row a step."""
    frame, seen = observed(source, steps, key)
    if write is None:
        frame.write.format("noop").mode("overwrite").save()
    else:
        write(frame)
    rows = [(name, place, watch.get[ROWS], watch.get["null_keys"]) for place, (name, watch) in enumerate(seen, 1)]
    return source.sparkSession.createDataFrame(rows, PROFILE)


def version_steps(order: Sequence[str], keys_of: DataFrame) -> list[Step]:
    """From version documents to ranked active versions. Hot keys are looked for in ``keys_of``, for a
    search in the chain itself would be an action of its own."""
    return [("documents", lambda documents: documents),
            ("versions", explode_versions),
            ("actives", active_versions),
            ("classees", lambda active: order_rows(active, ["event_id"], [F.col(name) for name in order],
                                                   rank="version_rank", keys_of=keys_of))]
