"""The five stages, each a function from frames to named frames."""
