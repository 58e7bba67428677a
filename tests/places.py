"""Folders of the given tables that tests read."""

SMALL = "/root/testdata/sf0.001"
