"""Reading raw tables, writing products, and the storage hop."""
