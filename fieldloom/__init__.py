"""People, contact and delivery jobs written as Spark DataFrame plans."""

from fieldloom.session import build_session, shared_dir, stage_table

__all__ = ["build_session", "shared_dir", "stage_table"]
