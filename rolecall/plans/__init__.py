"""End-to-end plans, the inputs they take from the given tables, and the registered queries."""
