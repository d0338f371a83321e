"""Writers: batch logs, keyed tables, topics, database tables, exports."""
