from .tables import (SchemaError, publish_by_key, read_published, require_columns, scan_table, scan_table_set,
                     write_csv, write_partitioned)

__all__ = ["SchemaError", "publish_by_key", "read_published", "require_columns", "scan_table", "scan_table_set",
           "write_csv", "write_partitioned"]
