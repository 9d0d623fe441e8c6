"""The operators as runnable queries over the star-schema tables, with reference SQL."""
