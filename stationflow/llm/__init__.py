"""Training-data operators: near-duplicates, licences, toxicity, quality, mixing,
decontamination, token files, nearest neighbours, token counts, WARC archives, ranked
search, page texts and token alignment.

Nothing outside this subpackage imports it; ``__spark_entry__.py`` adds its
queries only where it can be imported.
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle


def ship(module: str) -> None:
    """Send the functions of ``module`` to Python workers by value: executors needn't have this package."""
    cloudpickle.register_pickle_by_value(sys.modules[module])
