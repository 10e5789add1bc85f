"""Plan fragments that keep the reports free of hot tasks."""

from salesdq.plans import distinct
from salesdq.plans.facts import (
    album_artists,
    all_albums,
    artist_totals,
    line_sales,
    lines_per_invoice,
    period_sales,
    sales_per_track,
    totals_by_attributes,
)
from salesdq.plans.joins import (
    broadcast_if_small,
    dealt_by_size,
    estimated_bytes,
    fits_broadcast,
    join_many_to_one,
    null_safe_lookup,
)
from salesdq.plans.ranking import running_total, top_k, top_ties
from salesdq.plans.report import report

__all__ = [
    "album_artists",
    "all_albums",
    "artist_totals",
    "broadcast_if_small",
    "dealt_by_size",
    "distinct",
    "estimated_bytes",
    "fits_broadcast",
    "join_many_to_one",
    "line_sales",
    "lines_per_invoice",
    "null_safe_lookup",
    "period_sales",
    "report",
    "running_total",
    "sales_per_track",
    "top_k",
    "top_ties",
    "totals_by_attributes",
]
