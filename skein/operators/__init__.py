from skein.operators.unpivot import (
    concat_by_position,
    concat_by_rank,
    pair_groups,
    pivot_back,
    pivot_back_discovered,
    qcol,
    rank_within,
    unpivot_paired,
    unpivot_wide,
)

__all__ = [
    "concat_by_position",
    "concat_by_rank",
    "pair_groups",
    "pivot_back",
    "pivot_back_discovered",
    "qcol",
    "rank_within",
    "unpivot_paired",
    "unpivot_wide",
]
