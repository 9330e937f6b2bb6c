"""Readers for landed harvest pages, feeds, tables, artifacts and task lists."""
