from parcelkit.sources.tables import TABLES, read_table, table_path  # noqa: F401
