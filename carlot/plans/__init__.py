"""Query catalogue, SQL oracles and composite jobs."""
