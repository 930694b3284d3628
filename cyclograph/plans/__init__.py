"""The layered model, as lazily composed DataFrame functions."""
