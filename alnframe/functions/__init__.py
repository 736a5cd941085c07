"""Column functions over alignment records (flags, CIGAR, bins, bases, tags)."""
