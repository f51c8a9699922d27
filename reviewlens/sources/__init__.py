"""Readers and writers. Every path is a parameter, so object stores work unchanged."""
