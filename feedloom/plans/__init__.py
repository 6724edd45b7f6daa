"""Whole jobs put together from the operators: clean a feed, build the star, load it, query it."""
