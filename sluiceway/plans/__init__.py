"""The transforms of each layer and the runs that chain them."""
