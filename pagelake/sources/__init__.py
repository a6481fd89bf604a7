"""Landed pages and the catalogue of API resources."""
