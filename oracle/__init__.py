"""Independent SQL for the registered queries, for checking results."""
