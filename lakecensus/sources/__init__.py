"""Sources: the landing table of captured attempts, the fixture builder, and the sink."""
