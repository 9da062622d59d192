"""User-level operators: functions over DataFrames (or stored tables)."""
