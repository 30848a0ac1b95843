"""The row-local amendment rules over a stream of landing files."""
