"""Where the tables for tests are."""

SMALL = "/root/testdata/sf0.001"
