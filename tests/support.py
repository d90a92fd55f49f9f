"""Constants of the tests of the similarity library."""

SF_SMALL = "/root/testdata/sf0.001"
