"""Customer segments to their table and their profile to CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemark import settings as s
from tidemark.operators import kpi
from tidemark.sources import files, tables


def write_segments(
    assignments: DataFrame,
    features: DataFrame,
    run_id: str,
    profile_path: str | None = None,
    folder: str | None = None,
    table: str = tables.TABLES["segments"],
    manifest: str = tables.MANIFEST,
    columns: s.AccountColumns = s.ACCOUNTS,
) -> int:
    """Id, segment and name of every customer as one run of the segment table.

    The profile, one row per segment, is made of the rows as they were written.
    """
    kept = assignments.select(columns.id, "segment_id", "segment_name")
    rows = tables.write_run(kept, table, run_id, folder, manifest)
    if profile_path:
        written = tables.read_run(kept.sparkSession, table, run_id, manifest)
        files.export_csv(kpi.segment_profile(features, written, columns), profile_path, single_file=True)
    return rows
