"""Reading listings and tables, writing results."""
