"""Relational building blocks that hold when one key owns a large share of the rows."""
