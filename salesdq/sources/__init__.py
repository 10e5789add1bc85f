"""Reading the store's tables and writing result tables."""
