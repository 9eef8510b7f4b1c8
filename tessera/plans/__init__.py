"""Plan-shaping helpers: size-checked broadcast, lineage cuts, distributed
row numbering and running sums, and plan inspection for tests."""
from .joins import broadcast_if_small, broadcast_pinned
from .lineage import cut_lineage, written
from .indexing import dense_index, running_sums
from .inspect import physical_plan, assert_no_cartesian, assert_no_python_udf

__all__ = ["broadcast_if_small", "cut_lineage", "dense_index",
           "running_sums", "broadcast_pinned", "written", "physical_plan", "assert_no_cartesian", "assert_no_python_udf"]
