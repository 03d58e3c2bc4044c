"""Training-data operators: tokenising, archives, search, sharding, duplicate removal,
filtering and packing.  Nothing else in the library imports this subpackage."""
