"""Where rows come from and go to: tables, streams, the given star schema, result tables."""
