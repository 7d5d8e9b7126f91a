"""Host-name keys.  Two rules that differ on a name without a dot:

* ``first_label``: text before the first dot, the whole name when there is
  no dot (``split_part(name, '.', 1)``);
* ``dotted_prefix``: text before the first dot, NULL when there is no dot,
  ``''`` for a leading dot.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def first_label(name: Column) -> Column:
    return F.split_part(name, F.lit("."), F.lit(1))


def dotted_prefix(name: Column) -> Column:
    pos = F.instr(name, ".")
    return F.when(pos > 0, F.substring(name, F.lit(1), pos - 1))
