"""Reports and tables written from results."""
