"""Part of loomlog."""
