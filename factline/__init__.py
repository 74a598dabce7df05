"""factline: incremental wide-fact building on Spark DataFrames.

The names below are the usual entry points; every operator lives in its module
(see README.md and COVERAGE.md).
"""

from .operators.gate import dep_gate, pipelines_from, position_report, readiness, source_positions  # noqa: F401
from .operators.lookup import build_fact, dim_lookup, kv_join, latest, new_rows  # noqa: F401
from .operators.positions import (Block, Position, block_filter, kth_position, next_block,  # noqa: F401
                                  next_block_uniq, plan_blocks, rank_rows)
from .plans.load import (LoadResult, PositionStore, Target, compact_blocks, drain, drain_planned,  # noqa: F401
                         drain_ranges,
                         load_incremental, load_range, load_reload, load_step, read_fact, read_published,
                         sql_transform)
from .session import get_session, work_dir  # noqa: F401
from .streaming.stream import stream_dedup, stream_load, with_gate  # noqa: F401

__version__ = "0.1.0"
