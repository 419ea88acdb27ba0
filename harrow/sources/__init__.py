"""Reading and writing run logs, environments, layers and pixel tables."""
