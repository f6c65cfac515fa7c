"""Reports over the layers, and the daily rebuild of the layers."""
