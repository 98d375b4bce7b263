"""Listing pages in, snapshot table in/out, report out."""
