"""DataFrame -> DataFrame operators. Transforms are lazy; the only eager steps are the chain-cut
summary of a capture (written once to the shared checkpoint folder, its size measured before it
is broadcast) and the staging of shared entity tables by ``plans.pipeline.Inventory``."""
