from letrado.sources.tables import DRIVER_TABLES, read_table  # noqa: F401
