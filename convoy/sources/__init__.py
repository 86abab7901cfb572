"""Reading operational tables, and the date-partitioned lake."""
