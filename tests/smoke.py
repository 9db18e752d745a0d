"""The smallest tables."""

SMOKE = "/root/testdata/sf0.001"
