"""Where rows come from: change records, mart tables, the metric catalog."""
