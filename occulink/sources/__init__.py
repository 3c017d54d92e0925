"""Inputs and outputs: catalog/file readers, table and text sinks, fixtures."""

from occulink.sources.sinks import drop_stage_tables, replace_table, write_table, write_text
from occulink.sources.tables import read_dir_table, read_table, use_database

__all__ = [name for name in dir() if not name.startswith("_")]
