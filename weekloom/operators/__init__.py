"""DataFrame operators: rollups, rankings, uplift, reports and exploration."""
