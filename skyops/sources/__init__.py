"""Sources and sinks: landed pages, tables, logs."""
