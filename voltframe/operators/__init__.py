"""DataFrame -> DataFrame building blocks of the analytical views."""

from voltframe.operators.latest import latest
from voltframe.operators.change import change_from_previous
from voltframe.operators.share import share_of_group
from voltframe.operators.unions import union_all, zero_padded_union
from voltframe.operators.joins import left_join_chain, full_outer_coalesced, with_scalar
from voltframe.operators.ordering import pg_order

__all__ = [
    "latest", "change_from_previous", "share_of_group", "union_all",
    "zero_padded_union", "left_join_chain", "full_outer_coalesced", "with_scalar",
    "pg_order",
]
