"""Readers, writers and the bindings that give the star-schema tables the feeds' shape."""
