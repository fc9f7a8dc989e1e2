"""Things that a Python worker sets up once and keeps for all its tasks."""

from __future__ import annotations

import sys
import types

import pyarrow as pa

_MODULE = "_mediacurate_worker"


def worker_table(label: str) -> dict:
    """The worker's table of that label, empty at first.

    The package's functions travel by value, each task with globals of its own, so what is to outlive a task is kept
    under a module name of its own in the worker process.
    """
    module = sys.modules.setdefault(_MODULE, types.ModuleType(_MODULE))
    return module.__dict__.setdefault(label, {})


def forget_tables() -> None:
    """Drop what earlier stages left in this worker, for a stage that needs the room more than they may need it again."""
    kept = sys.modules.get(_MODULE)
    for table in list(vars(kept).values()) if kept else ():
        if isinstance(table, dict):
            table.clear()
    pa.default_memory_pool().release_unused()
