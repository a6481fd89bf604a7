"""Landed pages as a stream."""
