"""Sessions, working directories, and whole jobs put together from the operators."""
