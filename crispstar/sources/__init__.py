"""Reading landing files and keeping versioned tables."""
