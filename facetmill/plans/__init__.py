"""The tables of the warehouse, layer by layer."""
