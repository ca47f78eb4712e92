"""Input and output: snapshot files, batch-versioned tables and publishing to other systems."""

from lakehist.sources.batches import BatchTable, superset
from lakehist.sources.files import read_snapshot, scratch_dir
from lakehist.sources.sinks import SinkSpec, publish

__all__ = ["BatchTable", "SinkSpec", "publish", "read_snapshot", "scratch_dir", "superset"]
