"""Checks of the engine against an independent SQL engine on the driver's tables."""
