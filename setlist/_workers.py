"""Ship worker-side code with the task instead of importing it there.

Functions that run inside Python workers (Arrow batch kernels) are pickled
by value, so executors need no installed copy of this package — the job
runs the same under ``spark-submit`` without ``--py-files`` as from a
notebook.
"""

from __future__ import annotations

import sys


def ship_by_value(module_name: str) -> None:
    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(sys.modules[module_name])
