"""Column-level building blocks: money arithmetic, forecast calendar."""
