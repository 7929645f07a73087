from reviewlens.sources.readers import (
    read_image_listing,
    read_reports,
    read_reviews_csv,
    read_table,
)
from reviewlens.sources.scratch import materialise, scratch_path
from reviewlens.sources.writers import write_reports, write_scan, write_splits, write_table

__all__ = [
    "materialise",
    "read_image_listing",
    "read_reports",
    "read_reviews_csv",
    "read_table",
    "scratch_path",
    "write_reports",
    "write_scan",
    "write_splits",
    "write_table",
]
