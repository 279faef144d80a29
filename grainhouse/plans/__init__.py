"""The warehouse layers and everything computed on top of them."""
