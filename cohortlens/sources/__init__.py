"""Reading the claims tables, staging shared intermediates and writing results."""
