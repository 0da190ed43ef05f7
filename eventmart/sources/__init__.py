"""Where rows come from: topics, landed tables, warehouse tables, sample data."""
