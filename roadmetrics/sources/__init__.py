"""Reading recordings and writing reports."""
