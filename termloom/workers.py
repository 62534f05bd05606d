"""Values that a Python worker keeps from task to task: models, encoders, tokenizers."""

from __future__ import annotations

import hashlib
import sys
import types
from collections import OrderedDict
from collections.abc import Callable
from typing import TypeVar

from pyspark import cloudpickle

Kept = TypeVar("Kept")

# Models are large: a worker keeps the ones used last.
KEPT_VALUES = 2


def per_worker(load: Callable[[], Kept]) -> Callable[[], Kept]:
    """A function that gives ``load()``, called once per worker process however many tasks it runs.

    Tasks get their own copy of a function, so values are found by the content of ``load``, taken
    once on the driver. The store is a module of the worker, as the package's own modules may be
    sent anew with every task. A lost worker loads again.
    """
    key = hashlib.sha256(cloudpickle.dumps(load)).hexdigest()

    def get() -> Kept:
        module = sys.modules.setdefault("_kept_values", types.ModuleType("_kept_values"))
        held = module.__dict__.setdefault("held", OrderedDict())
        if key not in held:
            while len(held) >= KEPT_VALUES:
                held.popitem(last=False)
            held[key] = load()
        held.move_to_end(key)
        return held[key]

    return get
