"""Table writes, versioned tables and ordered exports."""
