"""rivulet - user-behaviour stream analytics as Spark DataFrame operators.

One function per operator; each takes a DataFrame (batch or streaming) and
returns a DataFrame, so Catalyst plans the whole chain.
"""

import sys

__version__ = "0.1.0"

# Python code that runs inside tasks (the login fold, stateful processors) is
# shipped by value, so executors need no installed copy of this package.
try:
    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(sys.modules[__name__])
except Exception:  # noqa: BLE001 - pyspark without cloudpickle: fall back to import by name
    pass
