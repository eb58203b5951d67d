"""Where Python workers find this package."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import SparkSession

ROOT = str(Path(__file__).resolve().parents[2])


#: Workers live on from stage to stage, so what one stage has freed must go back to the machine: large
#: arrays are mapped on their own, free ends are cut off, and Arrow uses the same allocator.
MEMORY = {
    "ARROW_DEFAULT_MEMORY_POOL": "system",
    "MALLOC_ARENA_MAX": "1",
    "MALLOC_MMAP_THRESHOLD_": str(8 << 20),
    "MALLOC_TRIM_THRESHOLD_": str(48 << 20),
}


def find_package(spark: SparkSession) -> None:
    """Put the folder of this package on the path of workers that start from now on.

    It must stand at the same place on every machine; otherwise ship it with ``--py-files``. Settings
    of the allocator that the user has made stay.
    """
    environment = spark.sparkContext.environment
    for name, value in MEMORY.items():
        environment.setdefault(name, value)
    places = [p for p in environment.get("PYTHONPATH", "").split(":") if p]
    if ROOT not in places:
        environment["PYTHONPATH"] = ":".join([*places, ROOT])


#: What drops the memories of operators that ran in this worker, and the operator that runs now.
_drops: dict[str, Callable[[], None]] = {}
_running: str | None = None


def remembers(operator: str, drop: Callable[[], None]) -> None:
    """``operator`` keeps something from task to task; ``drop`` lets go of it."""
    _drops[operator] = drop


def enter(operator: str) -> None:
    """Called by tasks: what other operators still hold in this worker goes back to the machine.

    A worker outlives its stage, and another operator's memories would lie beside the next one's.
    """
    global _running
    if _running == operator:
        return
    before, _running = _running, operator
    if before is None:
        return
    for name, drop in _drops.items():
        if name != operator:
            drop()
    gc.collect()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU library alone
    if trim:
        trim(0)
