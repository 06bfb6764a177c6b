"""The products, layer by layer, and their full refresh."""
