"""Readers: tables, the station registry, landed responses, arrived files."""
