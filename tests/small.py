"""The smallest driver tables."""

SMALL = "/root/testdata/sf0.001"
