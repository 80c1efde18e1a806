"""Incremental landing of raw text files into the typed layer.

The analytics are batch; the only incremental piece is keeping the typed
layer current as raw extracts arrive. It reuses the batch transform.
"""

from cohortcraft.streaming.landing import land_raw_files

__all__ = ["land_raw_files"]
