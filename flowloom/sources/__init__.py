"""Readers, decoders and output shapes."""
